"""Secrets in texts: candidates by form, false positives out by a random forest.

A candidate is a run of at least 16 key characters with a digit or a change of case inside
it, or any value that is assigned to a secret's name (``NAME=value`` in one word, or over
up to three words, quoted or not); ``=`` belongs to a candidate only at its end. Assigned
values without both a letter and a digit have no label by form unless they are long and have
a digit: the forest is not taught them and judges them like the rest.

The forest sees a candidate's length, the kinds of characters and the changes between them,
how much of it common words cover, path marks, and the words next to it. It is trained on all
different findings with a label, both labels weighing the same however rare one is. Without
findings of both labels there is no forest, and every candidate takes the one label there is,
or none.

Null and empty texts have no candidates. Repeated rows are scanned each on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sequon.llm.common import GAP, crc32_text, kept, let

#: Words that name a secret when it is assigned.
NAMES = (
    "token", "key", "secret", "password", "passwd", "pwd", "auth", "credential", "apikey", "api_key", "access_key"
)
#: Words that speak of secrets without assigning one.
_SPEAKS = "|".join((*NAMES, "bearer", "private"))
LONG = 16
_KEY = "A-Za-z0-9_+/-"
#: A whole run of key characters, not a name that is assigned to, with its padding.
CANDIDATE = rf"(?<![{_KEY}])[{_KEY}]{{{LONG},}}+(?!=+[{_KEY}])={{0,2}}"
#: Up to the value: words here are parted by one blank.
_ASSIGNED = rf"(?i:{'|'.join(NAMES)})[_0-9]{{0,4}}[\"'`\]]{{0,2}}[ \n]?[=:]{{1,2}}"
#: A value just after a secret's name, of any length; other signs may be inside it.
_VALUE = rf"(?<={_ASSIGNED}[ \n]?[\"'`]{{0,2}})[@!#$%^*~.{_KEY}]*[{_KEY}]={{0,2}}"
#: Findings to train on in one partition.
PART_ROWS = 20_000
#: Common words, of three letters or more, that make up the dictionary.
DICTIONARY = 200
MASK = "[SECRET]"
_PLAIN = ["length", "digits", "upper", "marks", "slashes", "changes", "distinct", "dictionary"]


def listed(text: str | Column) -> Column:
    """What may be a candidate, with the words around it; empty or null for most texts."""
    text = F.col(text) if isinstance(text, str) else text
    # The two words before stand ahead of a word's own line, where no match may begin.
    each_match = rf"(?s)(?:\G(?!^)|^[^\n]*\n)(.*?)({CANDIDATE}|{_VALUE})"

    def in_words(words: Column) -> Column:
        def word(i: Column) -> Column:
            return F.coalesce(F.get(words, i), F.lit(""))

        def around(x: Column, i: Column) -> Column:
            line = F.concat(word(i - 2), F.lit(" "), word(i - 1), F.lit("\n"), x)
            return F.struct(
                F.arrays_zip(
                    F.regexp_extract_all(line, F.lit(each_match), 2).alias("candidate"),
                    F.regexp_extract_all(line, F.lit(each_match), 1).alias("lead"),
                ).alias("own"),
                F.get(words, i - 1).alias("before"),
                F.get(words, i - 2).alias("before2"),
                F.get(words, i + 1).alias("after"),
            )

        def may_have(x: Column, i: Column) -> Column:
            # A sign of assignment in the word or at the end of the one before.
            signs = x.rlike("[=:].") | word(i - 1).rlike("[=:][\"'`]{0,2}$")
            return (F.length(x) >= LONG) | signs

        every = F.transform(words, lambda x, i: F.when(may_have(x, i), around(x, i)))
        return F.filter(every, lambda f: F.size(f["own"]) > 0)

    some = text.rlike(rf"[{_KEY}]{{{LONG}}}|[=:]")
    return F.when(some, let(F.split(text, GAP), in_words))


def candidates(docs: DataFrame, at: str = "at", text: str = "text") -> DataFrame:
    """(at, candidate, before, before2, after): every candidate with the words around it."""
    return _placed(docs.select(F.col(at).alias("at"), listed(text).alias("listed")))


def _placed(rows: DataFrame) -> DataFrame:
    """One row per candidate of ``listed``, with the other columns."""
    rest = [c for c in rows.columns if c != "listed"]
    found = rows.select(*rest, F.explode("listed").alias("f"))
    each = found.select(*rest, F.explode("f.own").alias("one"), "f.*").select(
        *rest, "one.candidate", "one.lead", "before", "before2", "after"
    )

    def plain(word: Column) -> Column:
        return F.lower(F.regexp_replace(F.coalesce(word, F.lit("")), r"[^A-Za-z_=:]", ""))

    lead = plain(F.col("lead"))
    placed = each.select(
        *rest,
        "candidate",
        F.when(lead != "", lead).otherwise(plain(F.col("before"))).alias("before"),
        F.when(lead != "", plain(F.col("before"))).otherwise(plain(F.col("before2"))).alias("before2"),
        plain(F.col("after")).alias("after"),
    )
    own = F.col("candidate")
    mixed = own.rlike("[0-9]") | own.rlike("[a-z][A-Z]+[a-z]")
    return placed.where(
        (mixed & (F.length(own) >= LONG)) | (named() & own.rlike("[A-Za-z0-9]"))
    )


def named() -> Column:
    """Whether a finding is assigned to a secret's name."""
    names = F.concat(F.col("before2"), F.col("before"))
    return names.rlike("(" + "|".join(NAMES) + ")_*[=:]+$")


def dictionary(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The commonest words of a corpus; all rows count."""
    word = F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^a-z]+")).alias("word")
    common = docs.select(word).where(F.length("word") >= 3).groupBy("word").count()
    return [r.word for r in common.orderBy(F.desc("count"), "word").limit(size).collect()]


def features(found: DataFrame, common: list[str]) -> DataFrame:
    own, size = F.col("candidate"), F.length("candidate")

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(own, pattern, "")) / size

    kinds = own
    for pattern, kind in (("[a-z]", "a"), ("[A-Z]", "A"), ("[0-9]", "0"), ("[^aA0]", "_")):
        kinds = F.regexp_replace(kinds, pattern, kind)
    runs = F.regexp_replace(kinds, r"(.)\1+", "$1")
    covered = F.lit(0.0)
    if common:
        rest = F.regexp_replace(F.lower(own), "|".join(common), "")
        covered = 1 - F.length(rest) / size
    near = [
        F.when(F.col(c).isin(*NAMES, "=", ":", "=:", ""), F.col(c))
        .when(F.col(c).rlike("(" + "|".join(NAMES) + ")_*[=:]*$"), F.lit("named"))
        .otherwise(F.lit("word"))
        .alias(f"{c}_word")
        for c in ("before", "before2", "after")
    ]
    return found.select(
        "*",
        size.cast("double").alias("length"),
        share("[^0-9]").alias("digits"),
        share("[^A-Z]").alias("upper"),
        share("[A-Za-z0-9]").alias("marks"),
        share("[^/]").alias("slashes"),
        ((F.length(runs) - 1) / size).alias("changes"),
        (F.size(F.array_distinct(F.split(own, ""))) / size).alias("distinct"),
        covered.alias("dictionary"),
        *near,
    )


def assigned(found: DataFrame) -> Column:
    """A label by form: issued prefixes, or a mixed value assigned to a secret's name.

    Null where form says nothing: for an assigned value that is not mixed, and for one that
    stands by a word that speaks of secrets (``Bearer 04db..``, the lines of a private key).
    """
    own = F.col("candidate")
    issued = own.rlike("^(AKIA[0-9A-Z]{16}|gh[pousr]_|xox[bp]-|sk_live_)")
    mixed = own.rlike("[0-9]") & (own.rlike("[A-Za-z]") | (F.length(own) >= LONG))
    spoken = F.concat(F.col("before2"), F.lit(" "), F.col("before")).rlike(f"({_SPEAKS})")
    return F.when(issued | (named() & mixed), 1).when(~named() & ~spoken, 0)


class Scanner:
    """A forest over findings; built by :func:`train`."""

    def __init__(self, model: PipelineModel | None, always: float, common: list[str]):
        self.model, self.always, self.common = model, always, common

    def score(self, found: DataFrame) -> DataFrame:
        """``found`` and ``score``, the share of trees' votes for a secret."""
        if self.model is None:
            return found.withColumn("score", F.lit(self.always))
        scored = self.model.transform(features(found, self.common))
        return scored.select(*found.columns, vector_to_array("probability")[1].alias("score"))


def train(labelled: DataFrame, common: list[str]) -> Scanner:
    """From findings with ``label`` 0 or 1; those without are left out."""
    own = ["candidate", "before", "before2", "after", "label"]
    # Equal findings say one thing once, so a group of copies does not weigh more.
    known = kept(labelled.where("label in (0, 1)").select(*own).distinct())
    rows = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if len(rows) < 2:
        return Scanner(None, float(max(rows, default=0)), common)
    total = sum(rows.values())
    weight = F.when(F.col("label") == 1, total / (2 * rows[1])).otherwise(total / (2 * rows[0]))
    # Trees draw rows by place, so places follow from the rows alone.
    placed = known.repartition(-(-total // PART_ROWS), *own).sortWithinPartitions(
        crc32_text("candidate"), *own
    )
    words = ["before_word", "before2_word", "after_word"]
    forest = RandomForestClassifier(
        numTrees=20, maxDepth=6, seed=7, labelCol="label", weightCol="weight"
    )
    stages = Pipeline(
        stages=[
            FeatureHasher(inputCols=words, outputCol="near", numFeatures=64),
            VectorAssembler(inputCols=[*_PLAIN, "near"], outputCol="features"),
            forest,
        ]
    )
    taught = features(placed, common).withColumn("weight", weight)
    return Scanner(stages.fit(taught), 0.0, common)


def scan(
    docs: DataFrame, labels=assigned, threshold: float = 0.5, columns: Sequence[str] | None = None
) -> DataFrame:
    """(``row``, ``secrets``, ``n_candidates``, ``max_score``): each row and its secrets.

    ``row`` has all columns, or those named in ``columns``. ``labels`` gives the label of a
    finding; the forest learns from all rows but those whose crc32(doc_id) is divisible by 5,
    and judges every row. Only rows that may have candidates, and no more of them than
    ``row``, are shuffled to meet their findings.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    base = kept(
        docs.select(
            row.alias("row"),
            F.monotonically_increasing_id().alias("at"),
            listed("text").alias("listed"),
        )
    )
    learn = F.coalesce(crc32_text("row.doc_id") % 5 != 0, F.lit(True))
    some = F.coalesce(F.size("listed") > 0, F.lit(False))
    found = kept(_placed(base.where(some).select("at", learn.alias("learn"), "listed")))
    taught = found.where("learn").drop("learn")
    common = dictionary(base.select(F.col("row.text").alias("text")))
    scanner = train(taught.withColumn("label", labels(taught)), common)
    per_row = kept(
        scanner.score(found)
        .groupBy("at")
        .agg(
            F.array_sort(
                F.collect_set(F.when(F.col("score") >= threshold, F.col("candidate")))
            ).alias("secrets"),
            F.count("*").alias("n_candidates"),
            F.max("score").alias("max_score"),
        )
    )
    named_columns = docs.columns if columns is None else columns
    own = F.struct(*(F.col(f"row.`{c}`") for c in named_columns)).alias("row")
    none = {
        "secrets": F.array().cast("array<string>"),
        "n_candidates": F.lit(0).cast("long"),
        "max_score": F.lit(0.0),
    }
    met = base.where(some).select("at", own).join(per_row, "at", "left").select(
        "row", *(F.coalesce(c, v).alias(c) for c, v in none.items())
    )
    rest = base.where(~some).select(own, *(v.alias(c) for c, v in none.items()))
    return met.unionByName(rest).withColumn("max_score", F.round("max_score", 6))


def masked(text: Column, secrets: Column) -> Column:
    """The text with every secret replaced, longest first; a short one only as a whole word."""
    longest = F.reverse(
        F.array_sort(F.transform(secrets, lambda s: F.struct(F.length(s).alias("n"), s.alias("s"))))
    )

    def without(t: Column, s: Column) -> Column:
        alone = F.concat(
            F.lit(r"(?<![A-Za-z0-9])\Q"), s["s"], F.lit(r"\E(?![A-Za-z0-9])")
        )
        return F.when(s["n"] >= LONG, F.replace(t, s["s"], F.lit(MASK))).otherwise(
            F.regexp_replace(t, alone, F.lit(MASK))
        )

    return F.when(F.size(secrets) > 0, F.aggregate(longest, text, without)).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """Every row, with its columns; secrets in ``text`` are masked, ``n_chars`` follows."""
    found = scan(docs)
    text = masked(F.col("row.text"), F.col("secrets"))
    columns = {
        "text": text,
        "n_chars": F.when(F.size("secrets") > 0, F.char_length(text).cast("long")).otherwise(
            F.col("row.n_chars")
        )
        if "n_chars" in docs.columns
        else None,
    }
    return found.select(
        *(
            columns[c].alias(c) if columns.get(c) is not None else F.col(f"row.`{c}`")
            for c in docs.columns
        )
    )
