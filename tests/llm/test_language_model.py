"""The language model against counts in plain Python."""

import math
import random
from collections import Counter

import pytest

from sequon.llm import lm

OWN = random.Random(6)
LETTERS = [chr(c) for c in [*range(0x4E00, 0x4E40), *range(97, 123), 0x1F600, 10, 32]]
TEXTS = ["".join(OWN.choices(LETTERS, k=OWN.randint(1, 300))) for _ in range(30)] + [None, "", "a"]


def _brute(text, learned):
    def grams(t):
        padded = "\n\n\n" + (t or "")
        return [(padded[i : i + 3], padded[i + 3]) for i in range(len(t or ""))]

    vocabulary = {c for _, t in learned for c in t or ""}
    losses = []
    for rows in ([t for x, t in learned if x], [t for _, t in learned]):
        pairs = Counter(g for t in rows for g in grams(t))
        contexts, ones = Counter(), Counter()
        for (context, token), n in pairs.items():
            contexts[context] += n
            ones[token] += n
        total = sum(pairs.values()) + len(vocabulary) + 1
        loss = 0.0
        for context, token in grams(text):
            prior = lm.PRIOR * (ones[token] + 1) / total
            own = pairs[context, token] + prior
            loss -= math.log(own / (contexts[context] + lm.PRIOR))
        losses.append(loss / max(len(text or ""), 1))
    return losses


@pytest.mark.parametrize("broadcast", [500_000, 40])
def test_losses_are_exact(spark, monkeypatch, broadcast):
    monkeypatch.setattr(lm, "BROADCAST_GRAMS", broadcast)
    monkeypatch.setattr(lm, "PIECE", 100)
    learned = [(i % 3 == 0, t) for i, t in enumerate(TEXTS)]
    model = lm.learn(spark.createDataFrame(learned, "target boolean, text string"))
    texts = TEXTS + ["never seen before: éЖ", *TEXTS[:2]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    frames = [lm.scored(docs, model)]
    if broadcast > model.n_grams:
        frames.append(docs.select("doc_id", lm.score(spark, "text", model).alias("s")))
    for frame in frames:
        rows = frame.collect()
        assert len(rows) == len(texts)
        for r in rows:
            target, background = _brute(texts[r.doc_id], learned)
            assert r.s.n_tokens == len(texts[r.doc_id] or "")
            assert r.s.target_loss == pytest.approx(target, abs=1e-9)
            assert r.s.background_loss == pytest.approx(background, abs=1e-9)
            assert r.s.score == pytest.approx(background - target, abs=1e-9)
