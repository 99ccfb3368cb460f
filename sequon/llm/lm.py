"""Cross-entropy difference of a target and a background model.

Both are character 4-gram models of one make: the same characters (the shared vocabulary),
the same smoothing towards single characters. The background counts every row, the target
the rows marked as such. A text's score is the mean over its tokens, which are characters
here, of background loss less target loss: higher is nearer to the target.

Counts are exact, one row per pair of context and token in a written table, which grows with
the corpus. The commonest n-grams are broadcast; what else a text has is added up per text
and joined to the table, so no key of that join is hot.

A null or empty text scores 0, as does every text where nothing is marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sequon.llm.common import kept, small

ORDER = 4
#: Weight of the single-character model in a context.
PRIOR = 5.0
#: Tokens worked on at a time.
PIECE = 1 << 20
#: N-grams that may be broadcast: 24 bytes each.
BROADCAST_GRAMS = 500_000
BROADCAST_ONES = 500_000
_OTHER = (1 << 16) - 1
_PARTIAL = (
    "struct<target:double,background:double,rest:array<struct<context:long,token:int,n:long>>>"
)


def _joined(parts: list[str], rows: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")
    sizes = np.array([len(p) - ORDER + 1 for p in parts])
    begins = np.arange(sizes.sum()) + np.repeat((ORDER - 1) * np.arange(len(parts)), sizes)
    return codes, begins, np.repeat(np.array(rows), sizes)


def _pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Code points, where in them the 4-gram of each token begins, and the token's row."""
    parts, rows, total = [], [], 0
    for row, text in enumerate(texts):
        padded = "\n" * (ORDER - 1) + (text.as_py() or "")
        for at in range(0, len(padded) - ORDER + 1, PIECE):
            parts.append(padded[at : at + PIECE + ORDER - 1])
            rows.append(row)
            total += len(parts[-1]) - ORDER + 1
            if total >= PIECE:
                yield _joined(parts, rows)
                parts, rows, total = [], [], 0
    if parts:
        yield _joined(parts, rows)


def _pairs(codes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context (three code points of 21 bits) and token of each 4-gram."""
    wide = codes.astype(np.int64)
    context = (wide[begins] << 42) | (wide[begins + 1] << 21) | wide[begins + 2]
    return context, codes[begins + ORDER - 1].astype(np.int32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marked = np.array(batch["target"].to_pylist(), np.int64)
        for codes, begins, row in _pieces(batch["text"]):
            context, token = _pairs(codes, begins)
            table = pa.table({"context": context, "token": token, "target": marked[row]})
            summed = table.group_by(["context", "token"], use_threads=False).aggregate(
                [("target", "count"), ("target", "sum")]
            )
            names = ["context", "token", "target_count", "target_sum"]
            out = summed.select(names).rename_columns(["context", "token", "n", "target"])
            yield from out.combine_chunks().to_batches()


def _loss(n, context, one, total, log):
    """Of a token seen ``n`` times in its context, ``one`` times among ``total`` tokens."""
    return -log((n + PRIOR * (one + 1) / total) / (context + PRIOR))


class Known:
    """Losses of n-grams, to be looked up exactly."""

    def __init__(self, rows: pa.Table):
        context, token = rows["context"].to_numpy(), rows["token"].to_numpy()
        codes = [context >> 42, (context >> 21) & 0x1FFFFF, context & 0x1FFFFF, token]
        chars, uses = np.unique(np.concatenate(codes), return_counts=True)
        # 16 bits a character: n-grams of still rarer characters are left to the table.
        self.chars = chars[np.argsort(-uses, kind="stable")[:_OTHER]]
        ids = self._ids()
        codes = [ids[c] for c in codes]
        here = np.all([c != _OTHER for c in codes], axis=0)
        self.keys = self._key(codes)[here]
        self.losses = np.stack([rows["target_loss"], rows["background_loss"]])[:, here]
        self.index = None

    def _ids(self) -> np.ndarray:
        ids = np.full(0x110000, _OTHER, np.uint64)
        ids[self.chars] = np.arange(len(self.chars), dtype=np.uint64)
        return ids

    def _key(self, codes: list[np.ndarray]) -> np.ndarray:
        key = codes[0]
        for code in codes[1:]:
            key = (key << np.uint64(16)) | code
        return key.view(np.int64)

    def places(self, codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Columns of ``losses``, -1 for an n-gram that is not here."""
        if self.index is None:
            self.index, self.ids = pd.Index(self.keys), self._ids()
        ids = self.ids[codes]
        return self.index.get_indexer(self._key([ids[begins + i] for i in range(ORDER)]))


class Model:
    """Losses of all n-grams (``losses``), and counts for those never seen."""

    def __init__(self, grams: DataFrame, ones: DataFrame, sums):
        contexts = grams.groupBy("context").agg(
            F.sum("n").alias("context_n"), F.sum("target").alias("context_target")
        )
        self.contexts, self.ones = kept(contexts), ones
        # One place more, for characters never seen.
        self.total_n, self.total_target = (float(t + sums.v + 1) for t in (sums.n, sums.target))
        self.losses = kept(self.with_losses(grams))
        self.n_grams = self.losses.count()

    def with_losses(self, grams: DataFrame) -> DataFrame:
        """``grams`` (context, token, n, target; null for none) with their losses."""
        rows = grams.join(self.contexts, "context", "left").join(
            small(self.ones, BROADCAST_ONES), "token", "left"
        )
        count = lambda c: F.coalesce(c, F.lit(0))
        losses = [
            _loss(count(n), count(f"context_{n}"), count(f"one_{n}"), F.lit(total), F.log)
            for n, total in (("target", self.total_target), ("n", self.total_n))
        ]
        return rows.select(
            *grams.columns,
            losses[0].alias("target_loss"),
            losses[1].alias("background_loss"),
        )

    def common(self) -> Known:
        """The commonest n-grams, as many as may be broadcast; all if they are few."""
        rows = self.losses
        if self.n_grams > BROADCAST_GRAMS:
            share = 1 - BROADCAST_GRAMS / self.n_grams
            least = rows.agg(F.percentile_approx("n", share, 100_000)).first()[0]
            rows = rows.where(F.col("n") > least)
        return Known(rows.select("context", "token", "target_loss", "background_loss").toArrow())


def learn(texts: DataFrame) -> Model | None:
    """From (``target`` boolean, ``text``), all rows."""
    marked = texts.select(F.coalesce("target", F.lit(False)).alias("target"), "text")
    counted = marked.mapInArrow(_count, "context long, token int, n long, target long")
    grams = kept(
        counted.groupBy("context", "token").agg(
            F.sum("n").alias("n"), F.sum("target").alias("target")
        )
    )
    ones = kept(
        grams.groupBy("token").agg(
            F.sum("n").alias("one_n"), F.sum("target").alias("one_target")
        )
    )
    sums = ones.agg(
        F.count("*").alias("v"), F.sum("one_n").alias("n"), F.sum("one_target").alias("target")
    ).first()
    return Model(grams, ones, sums) if sums.target else None


def _mean(n: Column, target: Column, background: Column) -> Column:
    target, background = (x / F.greatest(n, F.lit(1)) for x in (target, background))
    return F.struct(
        n.alias("n_tokens"),
        target.alias("target_loss"),
        background.alias("background_loss"),
        (background - target).alias("score"),
    )


def _tokens(text: Column) -> Column:
    return F.char_length(F.coalesce(text, F.lit(""))).cast("long")


def _partial(texts: pa.Array, known: Known) -> pa.Array:
    """Summed losses of each text's known n-grams; the others counted, in ``rest``."""
    sums = np.zeros((2, len(texts)))
    keys = {"row": pa.int64(), "context": pa.int64(), "token": pa.int32()}
    missed = [pa.schema(list(keys.items())).empty_table()]
    for codes, begins, row in _pieces(texts):
        place = known.places(codes, begins)
        seen = place >= 0
        for i in range(2):
            sums[i] += np.bincount(row[seen], known.losses[i][place[seen]], len(texts))
        context, token = _pairs(codes, begins[~seen])
        missed.append(pa.table({"row": row[~seen], "context": context, "token": token}))
    grouped = pa.concat_tables(missed).group_by(list(keys), use_threads=False)
    rest = grouped.aggregate([("token", "count")]).sort_by("row")
    offsets = np.searchsorted(rest["row"].to_numpy(), np.arange(len(texts) + 1))
    parts = [pa.array(rest[c].to_numpy()) for c in ("context", "token", "token_count")]
    items = pa.StructArray.from_arrays(parts, names=["context", "token", "n"])
    listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)
    return pa.StructArray.from_arrays(
        [pa.array(sums[0]), pa.array(sums[1]), listed], names=["target", "background", "rest"]
    )


def scored(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, and ``s``: a struct of ``n_tokens``, ``target_loss``,
    ``background_loss`` (means) and ``score``. For a model of any size."""
    zero = F.lit(0.0)
    own = [F.col(f"`{c}`") for c in docs.columns if c != text]
    if model is None:
        return docs.select(*own, _mean(_tokens(F.col(text)), zero, zero).alias("s"))
    sent = docs.sparkSession.sparkContext.broadcast(model.common())

    @F.arrow_udf(_PARTIAL)
    def run(texts: pa.Array) -> pa.Array:
        return _partial(texts, sent.value)

    base = kept(
        docs.select(
            F.struct(*own).alias("row"),
            _tokens(F.col(text)).alias("n_tokens"),
            F.monotonically_increasing_id().alias("at"),
            run(F.col(text)).alias("p"),
        )
    )
    rest = base.select("at", F.inline("p.rest")).withColumnRenamed("n", "times")
    joined = kept(rest.join(model.losses, ["context", "token"], "left"))
    losses = ["target_loss", "background_loss"]
    unseen = joined.where(F.col("n").isNull())
    found = joined.where(F.col("n").isNotNull()).select("at", "times", *losses)
    if unseen.limit(1).count():
        pairs = unseen.select("context", "token", "n", "target").distinct()
        of_pair = model.with_losses(pairs).select("context", "token", *losses)
        again = unseen.select("at", "times", "context", "token")
        again = again.join(of_pair, ["context", "token"]).select("at", "times", *losses)
        found = found.union(again)
    sums = found.groupBy("at").agg(*(F.sum(F.col("times") * F.col(c)).alias(c) for c in losses))
    both = [
        F.col(f"p.{name}") + F.coalesce(c, zero)
        for name, c in zip(("target", "background"), losses)
    ]
    return base.join(sums, "at", "left").select(
        "row.*", _mean(F.col("n_tokens"), *both).alias("s")
    )


def score(spark: SparkSession, text: str | Column, model: Model | None) -> Column:
    """The struct of :func:`scored` as a column; for models that can be broadcast whole."""
    text, zero = F.col(text) if isinstance(text, str) else text, F.lit(0.0)
    if model is None:
        return _mean(_tokens(text), zero, zero)
    if model.n_grams > BROADCAST_GRAMS:
        raise ValueError(f"{model.n_grams} n-grams are too many for a column: use scored()")
    frames = (model.contexts, model.ones)
    counted = [f.toArrow().to_pandas().set_index(f.columns[0]) for f in frames]
    totals = {"target": model.total_target, "n": model.total_n}
    sent = spark.sparkContext.broadcast((model.common(), *counted, model.losses.toArrow()))

    @F.arrow_udf("struct<target:double,background:double>")
    def run(texts: pa.Array) -> pa.Array:
        known, contexts, ones, grams = sent.value
        out = _partial(texts, known)
        sums = [out.field(i).to_numpy().copy() for i in range(2)]
        rest = out.field("rest")
        row = np.repeat(np.arange(len(texts)), rest.value_lengths().to_numpy())
        own = rest.values.flatten()
        pairs = pd.DataFrame(dict(zip(("context", "token", "times"), own)), copy=True)
        seen = pairs.merge(grams.to_pandas(), "left", ["context", "token"]).fillna(0)
        for i, (n, total) in enumerate(totals.items()):
            context = contexts[f"context_{n}"].reindex(pairs["context"]).fillna(0).to_numpy()
            one = ones[f"one_{n}"].reindex(pairs["token"]).fillna(0).to_numpy()
            loss = _loss(seen[n].to_numpy(), context, one, total, np.log)
            sums[i] += np.bincount(row, loss * pairs["times"].to_numpy(), len(texts))
        return pa.StructArray.from_arrays([pa.array(x) for x in sums], names=["target", "background"])

    return F.transform(
        F.array(run(text)), lambda p: _mean(_tokens(text), p["target"], p["background"])
    )[0]
