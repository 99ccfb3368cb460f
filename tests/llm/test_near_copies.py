"""Near copies: fingerprints, links within dense cells, one row of each group."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from sequon.llm import simhash


def prose(seed, n=60):
    own = random.Random(seed)
    return " ".join("".join(own.choices("abcdefgh", k=own.randint(2, 7))) for _ in range(n))


def test_null_and_equal_ids_join_nothing(spark):
    texts = [prose(i) for i in range(9)]
    ids = [None, None, None, 7, 7, 7, 1, None, 1]
    rows = list(zip(ids, texts)) + [(None, texts[0]), (9, texts[3]), (None, texts[6]), (3, texts[7])]
    left = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in left) == sorted(texts)
    # The least id stays; a null one only where there is no other.
    by_text = {r.text: r.doc_id for r in left}
    assert [by_text[t] for t in texts] == [None, None, None, 7, 7, 7, 1, 3, 1]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_a_dense_cell_goes_to_many_tasks(spark, monkeypatch, broadcast):
    """All nodes in one cell, cut into tiles: links equal brute force, no task has most pairs."""
    monkeypatch.setattr(simhash, "TILE", 32)
    monkeypatch.setattr(simhash, "TASK_PAIRS", 20)
    own = random.Random(5)
    fps = set()
    while len(fps) < 600:
        # Three bits in each quarter, not the sign.
        fps.add(sum(1 << (16 * q + b) for q in range(4) for b in own.sample(range(15), 3)))
    fps = sorted(fps)
    near = [fps[i] ^ (1 << 0) ^ (1 << 1) for i in range(0, 600, 7) if fps[i] & 3 in (1, 2)]
    fps = sorted({*fps, *near})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        links = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2)
        found = links.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    top = {f: f for f in fps}

    def root(f):
        while top[f] != f:
            f = top[f]
        return f

    for a, b, _ in found:
        assert (a ^ b).bit_count() <= 2
        top[root(a)] = root(b)
    close = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 2]
    assert len(close) > 20 and all(root(a) == root(b) for a, b in close)
    assert len({r.task for r in found}) > 3


def test_fingerprint_equals_its_definition():
    """Bit by bit, in plain numbers."""
    texts = ["", " \t", "One", "one two", "A b c d", "x y x y x y x y", prose(3, 500), "Ä ö ü ß É"]
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
        hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        bits = [2 * sum(h >> b & 1 for h in hashes) > len(hashes) for b in range(64)]
        assert simhash.simhash(text) == sum(1 << b for b in range(64) if bits[b])
    assert simhash.simhash(None) == 0
