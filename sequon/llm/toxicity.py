"""Toxicity by a linear classifier over character n-grams.

A feature is the presence of a 5-gram of letters in a text, times the log ratio of its
smoothed shares of toxic and of other texts. Shares come from all labelled rows; n-grams
whose shares differ by less than ``LEAST_Z`` standard errors are left out, so that the many
that say nothing do not add up in long texts. The weights are fitted by logistic regression
on at most ``TRAIN_PER_LABEL`` different texts of either label, chosen by hash.

Null and empty texts have no features and score by the bias alone. Without rows of both
labels every text scores the share of toxic rows, 0 if there are none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sequon.llm.common import kept
from sequon.llm.ngrams import buckets, counts, letters

ORDER, BITS = 5, 18
TRAIN_PER_LABEL = 2_000
#: Added to each count before the ratio.
SMOOTH = 1.0
LEAST_Z = 3.0
RIDGE, ROUNDS, STEP = 1e-3, 200, 0.02


def present(text: str | None) -> np.ndarray:
    found = [np.unique(b) for b in buckets(letters(text), ORDER, BITS)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


class Classifier:
    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight, bias

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weight[present(text)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _ratios(counted: dict[str, np.ndarray], rows: dict[str, int]) -> np.ndarray:
    """Log ratio of each n-gram's shares; 0 where they do not differ enough."""
    (n1, n0), (all1, all0) = (counted["1"], counted["0"]), (rows["1"], rows["0"])
    ratio = np.log((n1 + SMOOTH) / (all1 + 2 * SMOOTH)) - np.log((n0 + SMOOTH) / (all0 + 2 * SMOOTH))
    pooled = (n1 + n0 + SMOOTH) / (all1 + all0 + 2 * SMOOTH)
    error = np.sqrt(pooled * (1 - pooled) * (1 / all1 + 1 / all0))
    return np.where(np.abs(n1 / all1 - n0 / all0) >= LEAST_Z * error, ratio, 0.0)


def _fit(ratio: np.ndarray, grams: list[np.ndarray], label: np.ndarray) -> tuple[np.ndarray, float]:
    """Full-batch Adam over the scaled features, both labels weighing the same."""
    row = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    at = np.concatenate(grams).astype(np.int64)
    value = ratio[at]
    share = np.where(label == 1, 0.5 / label.sum(), 0.5 / (len(label) - label.sum()))
    weight, bias = np.zeros(len(ratio)), 0.0
    m, v = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    for t in range(1, ROUNDS + 1):
        z = np.bincount(row, value * weight[at], minlength=len(grams)) + bias
        error = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label)
        slope = np.bincount(at, value * error[row], minlength=len(ratio)) + RIDGE * weight
        slope = np.append(slope, error.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        move = STEP * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        weight, bias = weight - move[:-1], bias - move[-1]
    return weight * ratio, bias


def learn(labelled: DataFrame, per_label: int = TRAIN_PER_LABEL) -> Classifier:
    """From (``label`` 0 or 1, ``text``); rows without a label are left out."""
    size = 1 << BITS
    known = kept(labelled.where("label in (0, 1)").select("label", "text"))
    rows = {str(r.label): r["count"] for r in known.groupBy("label").count().collect()}
    if set(rows) != {"0", "1"}:
        return Classifier(np.zeros(size), 30.0 if "1" in rows else -30.0)
    counted = counts(
        known.select(F.col("label").alias("group"), "text"), lambda t: iter([present(t)]), size
    )
    none = np.zeros(size, np.int64)
    ratio = _ratios({k: counted.get(k, none) for k in rows}, rows)
    sample = _sampled(known, ratio != 0, per_label)
    return Classifier(*_fit(ratio, list(sample["grams"]), sample["label"].to_numpy()))


def _sampled(known: DataFrame, telling: np.ndarray, per_label: int) -> pd.DataFrame:
    """The n-grams that say something in the texts to fit on, by label and hash.

    Texts are chosen by hashes alone; only the chosen ones are taken apart, once a task.
    """
    hashed = known.withColumn("h", F.xxhash64("text"))
    # Equal texts say one thing once, so a group of copies does not take all places.
    texts = hashed.select("label", "h").distinct()
    picked = [texts.where(F.col("label") == x).orderBy("h").limit(per_label) for x in (0, 1)]
    chosen = hashed.join(F.broadcast(kept(picked[0].union(picked[1]))), ["label", "h"])
    sent = known.sparkSession.sparkContext.broadcast(telling)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            own = []
            for label, h, text in zip(batch["label"], batch["h"], batch["text"]):
                label, h = label.as_py(), h.as_py()
                if (label, h) not in seen:
                    seen.add((label, h))
                    grams = present(text.as_py())
                    own.append((label, h, grams[sent.value[grams]].astype(np.int32)))
            if own:
                kinds = (pa.int32(), pa.int64(), pa.list_(pa.int32()))
                columns = [pa.array(c, k) for c, k in zip(zip(*own), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "h", "grams"])

    found = chosen.select("label", "h", "text").mapInArrow(run, "label int, h long, grams array<int>")
    once = found.groupBy("label", "h").agg(F.min("grams").alias("grams"))
    return once.toPandas().sort_values(["label", "h"])


def score(spark: SparkSession, text: str | Column, classifier: Classifier) -> Column:
    sent = spark.sparkContext.broadcast(classifier)

    @F.pandas_udf("double")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([sent.value.score(v) for v in values], dtype=float)

    return run(text)
