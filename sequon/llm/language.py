"""Languages of a text as a mixture, by expectation-maximisation.

Each language has a distribution over character trigrams, counted over all rows to learn
from. A text's trigrams are drawn from a mixture of languages; its shares come from
expectation-maximisation, and languages join the set one by one while the log-likelihood
rises by more than the penalty (half the log of the text's trigrams, for each language).

A null text or one without a letter is ``und`` with score 0; so is every text if nothing
can be learned. Long texts count whole. Repeated rows are judged alike.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sequon.llm.ngrams import buckets, counts, letters

ORDER, BITS = 3, 16
ROUNDS = 30


def _grams(text: str | None):
    return buckets(letters(text), ORDER, BITS)


class Languages:
    """Trigram distributions of languages, smoothed by a half."""

    def __init__(self, counted: dict[str, np.ndarray]):
        self.names = sorted(counted)
        rows = [counted[n] + 0.5 for n in self.names]
        self.p = np.stack([r / r.sum() for r in rows]) if rows else np.zeros((0, 1 << BITS))

    def _mixture(self, p: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
        share = np.full(len(p), 1 / len(p))
        for _ in range(ROUNDS if len(p) > 1 else 1):
            joint = share[:, None] * p
            total = joint.sum(0)
            share = (joint / total * n).sum(1) / n.sum()
        return float((np.log((share[:, None] * p).sum(0)) * n).sum()), share

    def shares(self, text: str | None) -> dict[str, float]:
        """The chosen languages and their shares; empty for a text without letters."""
        own = np.zeros(1 << BITS, np.int64)
        for found in _grams(text):
            own += np.bincount(found, minlength=len(own))
        at = np.flatnonzero(own)
        if not len(at) or not self.names:
            return {}
        n, p = own[at], self.p[:, at]
        penalty = 0.5 * math.log(max(n.sum(), 2))
        alone = np.log(p) @ n
        chosen = [int(np.argmax(alone))]
        best, share = float(alone[chosen[0]]), np.ones(1)
        while len(chosen) < len(self.names):
            # The log-likelihood is concave in the shares, so its slope towards a language
            # bounds what that language can add; most need no expectation-maximisation.
            most = (p / (share @ p[chosen])) @ n - n.sum()
            rest = [i for i in range(len(p)) if i not in chosen and most[i] > penalty]
            tried = {i: self._mixture(p[[*chosen, i]], n) for i in rest}
            i = max(rest, key=lambda r: tried[r][0], default=None)
            if i is None or tried[i][0] - best <= penalty:
                break
            best, share = tried[i]
            chosen.append(i)
        return {self.names[i]: float(s) for i, s in zip(chosen, share)}


def learn(texts: DataFrame) -> Languages:
    """From (``group``: language, ``text``); nulls in either are left out."""
    known = texts.where("`group` is not null and text is not null")
    return Languages(counts(known, _grams, 1 << BITS))


def predict(spark: SparkSession, text: str | Column, languages: Languages) -> Column:
    """Struct of ``lang`` and ``score``, the share of the chief language."""
    sent = spark.sparkContext.broadcast(languages)

    @F.pandas_udf("lang string, score double")
    def run(values: pd.Series) -> pd.DataFrame:
        rows = []
        for value in values:
            shares = sent.value.shares(value)
            chief = max(shares, key=shares.get, default="und")
            rows.append((chief, round(min(shares.get(chief, 0.0), 1.0), 6)))
        return pd.DataFrame(rows, columns=["lang", "score"])

    return run(text)
