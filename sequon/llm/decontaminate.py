"""Benchmark passages in training texts, by a positional inverted index.

The index holds (term, text, position) of those terms that are the rarest of some benchmark
window; rarity is counted over all training texts. A posting less the term's place in its
window is where the window would begin. Only there are the other words of the text looked at,
and compared with all windows at once, by an equi-join. So a place is tried at most once for
each place and length of windows with its term, however often the text or the benchmark
repeats itself. A window with a term that no training text has cannot occur and is left out.

Texts without words, null ones included, have no hits; an empty benchmark finds nothing.
Equal windows are one window, and equal items count once. A null ``item_id`` is a name of its
own and written as empty. Repeated rows of documents are judged each on its own. Very long
texts are taken whole, in one row. Other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sequon.llm.common import kept, let, lower_ascii, small

WINDOW = 13
#: Between words: all ASCII but digits and letters.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of benchmark terms that may be broadcast, and rows of windows, about 100 bytes each.
BROADCAST_ROWS, BROADCAST_WINDOWS = 500_000, 200_000
#: The term of the posting that stands behind the last word of each text.
_END = ""


def words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _GAP), lambda x: x != "")


def _base(docs: DataFrame) -> DataFrame:
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return kept(docs.select(row.alias("row"), F.monotonically_increasing_id().alias("at")))


def _windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(item, phrase): the windows of each item, as words joined by spaces."""
    terms = words(F.col("text"))

    def phrases(own: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(own) - size, F.lit(0)))
        return F.transform(starts, lambda i: F.array_join(F.slice(own, i + 1, F.lit(size)), " "))

    named = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.explode(let(terms, phrases)).alias("phrase"),
    )
    return kept(named.where("phrase <> ''").distinct())


def _pivots(windows: DataFrame, base: DataFrame) -> DataFrame:
    """(phrase, term, place, long, absent): the rarest term of each window that some text has,
    by its count in all texts, and whether the window has terms that none has."""
    placed = windows.select("phrase").distinct().select(
        "phrase", F.posexplode(F.split("phrase", " ")).alias("place", "term")
    )
    terms = kept(placed.select("term").distinct())
    count = kept(
        base.select(F.explode(words(F.col("row.text"))).alias("term"))
        .join(small(terms, BROADCAST_ROWS), "term", "left_semi")
        .groupBy("term")
        .agg(F.count("*").alias("n"))
    )
    rarest = (
        placed.join(small(count, BROADCAST_ROWS), "term", "left")
        .groupBy("phrase")
        .agg(
            F.min(F.when(F.col("n").isNotNull(), F.struct("n", "term", "place"))).alias("first"),
            F.count("*").cast("int").alias("long"),
            (F.count_if(F.col("n").isNull()) > 0).alias("absent"),
        )
    )
    return kept(
        rarest.where(F.col("first").isNotNull()).select(
            "phrase", "first.term", "first.place", "long", "absent"
        )
    )


def _postings(base: DataFrame, pivots: DataFrame) -> DataFrame:
    """(at, pos, term) of the pivots, and the end of every text: its number of words."""
    terms = pivots.select("term").union(base.sparkSession.range(1).select(F.lit(_END))).distinct()
    ended = F.concat(words(F.col("row.text")), F.array(F.lit(_END)))
    index = base.select("at", F.posexplode(ended).alias("pos", "term"))
    return kept(index.join(small(kept(terms), BROADCAST_ROWS), "term", "left_semi"))


def _phrases(
    base: DataFrame, postings: DataFrame, pivots: DataFrame, placed: bool = False
) -> DataFrame:
    """(at, begins, long, phrase): the words of texts where a window may be; where ``placed``,
    also the ``term`` and its ``place``."""
    more = ["term", "place"] if placed else []
    shapes = kept(pivots.select("term", "place", "long").distinct())
    spots = (
        postings.where(F.col("term") != _END)
        .join(small(shapes, BROADCAST_ROWS), "term")
        .select("at", (F.col("pos") - F.col("place")).alias("begins"), "long", *more)
        .where("begins >= 0")
        .groupBy("at")
        .agg(F.collect_set(F.struct("begins", "long", *more)).alias("spots"))
    )

    def cut(own: Column) -> Column:
        whole = F.filter("spots", lambda s: s["begins"] + s["long"] <= F.size(own))
        return F.transform(
            whole,
            lambda s: F.struct(
                *(s[c].alias(c) for c in ("begins", "long", *more)),
                F.array_join(F.slice(own, s["begins"] + 1, s["long"]), " ").alias("phrase"),
            ),
        )

    return base.join(spots, "at").select("at", F.inline(let(words(F.col("row.text")), cut)))


def _digests(base: DataFrame, benchmark: DataFrame, size: int) -> DataFrame:
    """(at, n_words, n_hit, items) of every text."""
    windows = _windows(benchmark, size)
    pivots = kept(_pivots(windows, base).where("not absent"))
    postings = _postings(base, pivots)
    sought = kept(pivots.select("phrase"))
    hits = kept(
        _phrases(base, postings, pivots).join(
            small(sought, BROADCAST_WINDOWS), "phrase", "left_semi"
        )
    )
    # Words not covered by a hit that begins earlier.
    end = F.col("begins") + F.col("long")
    before = W.partitionBy("at").orderBy("begins", "long").rowsBetween(W.unboundedPreceding, -1)
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    new = F.greatest(end - F.greatest(reached, F.col("begins")), F.lit(0))
    covered = (
        hits.withColumn("new", new).groupBy("at").agg(F.sum("new").cast("long").alias("n_hit"))
    )
    items = _items(hits, windows)
    ends = postings.where(F.col("term") == _END).select("at", F.col("pos").cast("long").alias("n_words"))
    return ends.join(covered.join(items, "at"), "at", "left").select(
        "at",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _items(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """(at, items): the names of the items whose windows were met, sorted."""
    met = hits.select("at", "phrase").distinct()
    return (
        met.join(small(windows, BROADCAST_WINDOWS), "phrase")
        .groupBy("at")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def search(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, columns: list[str] | None = None
) -> DataFrame:
    """(``row``, ``found``): ``columns`` of each row of ``docs``, all by default, as a struct,
    and what it shares: n_words, n_hit and ``items`` (those with windows that occur)."""
    base = _base(docs)
    row = F.struct(*(F.col("row")[c].alias(c) for c in columns or docs.columns))
    found = F.struct("n_words", "n_hit", "items").alias("found")
    digests = _digests(base, benchmark, size)
    return base.select(row.alias("row"), "at").join(digests, "at").select("row", found)


def near(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, off: int = 3
) -> DataFrame:
    """(``row``, ``near``) of the rows of ``docs`` that come near the benchmark: names of items
    of which a window has all but ``off`` words, at most, at their places in the text.

    The rarest word of the window that any text has must be among those in place. Here every
    window with that word is compared with the place, so repetition costs more.
    """
    base = _base(docs)
    windows = _windows(benchmark, size)
    pivots = _pivots(windows, base)
    given = _phrases(base, _postings(base, pivots), pivots, placed=True)
    given = given.withColumnRenamed("phrase", "own")
    differ = F.zip_with(F.split("own", " "), F.split("phrase", " "), lambda a, b: a != b)
    hits = given.join(small(pivots, BROADCAST_WINDOWS), ["term", "place", "long"]).where(
        F.size(F.filter(differ, lambda x: x)) <= off
    )
    items = _items(hits, windows).withColumnRenamed("items", "near")
    return base.join(items, "at").select("row", "near")


def contaminated(found: Column) -> Column:
    return (found["n_hit"] > 0) & (20 * found["n_hit"] >= found["n_words"])


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows that are not contaminated, with all their columns."""
    base = _base(docs)
    found = _digests(base, benchmark, size)
    bad = kept(found.where(contaminated(F.struct("n_hit", "n_words"))).select("at"))
    return base.join(small(bad, BROADCAST_ROWS), "at", "left_anti").select("row.*")
