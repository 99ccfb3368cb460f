"""Benchmark passages against plain Python, repetition and near matches included."""

import random
from collections import Counter

import duckdb
import pytest

from sequon.llm import decontaminate, queries

FOLDER = "/root/testdata/sf0.01"


def tables(spark, texts, items):
    return (
        spark.createDataFrame(
            [(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, at string"
        ),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def windows(terms, size):
    if terms:
        yield from (tuple(terms[i : i + size]) for i in range(max(1, len(terms) - size + 1)))


def by_trial(texts, items, size):
    out = []
    for text in texts:
        own, hit, met = (text or "").split(), set(), set()
        for name, item in items:
            for window in set(windows((item or "").split(), size)):
                for i in range(len(own) - len(window) + 1):
                    if tuple(own[i : i + len(window)]) == window:
                        hit |= set(range(i, i + len(window)))
                        met.add("" if name is None else str(name))
        out.append((len(own), len(hit), sorted(met)))
    return out


def near_by_trial(texts, items, size, off):
    count = Counter(w for t in texts for w in (t or "").split())
    out = {}
    for at, text in enumerate(texts):
        own, met = (text or "").split(), set()
        for name, item in items:
            for window in windows((item or "").split(), size):
                known = [(count[w], w, i) for i, w in enumerate(window) if count[w]]
                place = min(known)[2] if known else None
                for i in range(len(own) - len(window) + 1 if known else 0):
                    here = own[i : i + len(window)]
                    if here[place] == window[place] and sum(a != b for a, b in zip(here, window)) <= off:
                        met.add("" if name is None else str(name))
        if met:
            out[at] = sorted(met)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_repetitive_texts(spark, seed):
    rng = random.Random(seed)
    some = lambda n, of: " ".join(rng.choices(of, k=n))
    texts = [some(rng.randint(0, 60), "ab" if i % 2 else "abcdef") for i in range(40)]
    texts += [None, "", "a", "a " * 50, texts[0], texts[0]]
    items = [(i, some(rng.randint(0, 12), "ab" if i % 2 else "abcdx")) for i in range(14)]
    items += [(None, "a b"), (3, items[3][1]), (90, "a " * 20), (91, None), (92, "q")]
    docs, benchmark = tables(spark, texts, items)
    found = {r.row.doc_id: r for r in decontaminate.search(docs, benchmark, 4).collect()}
    expected = by_trial(texts, items, 4)
    assert len(found) == len(texts)
    for i, r in found.items():
        assert (r.found.n_words, r.found.n_hit, r.found["items"]) == expected[i]
        assert r.row.at == "clash"
    clean = {r.doc_id for r in decontaminate.clean(docs, benchmark, 4).collect()}
    assert clean == {i for i, (n, hit, _) in enumerate(expected) if not hit or 20 * hit < n}
    close = {r.row.doc_id: r.near for r in decontaminate.near(docs, benchmark, 6, 2).collect()}
    assert close == near_by_trial(texts, items, 6, 2) and len(close) > 5


def test_long_texts_of_few_words(spark):
    """20,000 equal words, and 20,000 of two kinds, against items of 5,000."""
    rng = random.Random(1)
    mixed = " ".join(rng.choices("bc", k=20_000))
    items = [(1, "a " * 5_000), (2, mixed[:10_000]), (3, "b c d")]
    docs, benchmark = tables(spark, ["a " * 20_000, mixed, "d b c"], items)
    found = {r.row.doc_id: r.found for r in decontaminate.search(docs, benchmark).collect()}
    assert (found[0].n_hit, found[0]["items"]) == (20_000, ["1"])
    assert found[1].n_hit >= 5_000 and found[1]["items"] == ["2"]
    assert found[2].n_hit == 0


def test_same_as_sql(spark):
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    expected = duck.execute(queries.ORACLE_SQL["op8_decontaminate"]).df()
    found = queries.op8_decontaminate(spark, FOLDER).toPandas()[list(expected.columns)]
    names = list(expected.columns)
    assert sorted(map(tuple, found.values)) == sorted(map(tuple, expected[names].values))
    assert found["contaminated"].any() and not found["contaminated"].all()


def test_no_python_on_the_way(spark):
    docs, benchmark = tables(spark, ["a b c"], [(1, "a b")])
    plan = decontaminate.search(docs, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
