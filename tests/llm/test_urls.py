"""Mined url rules against a miner that tries every combination."""

import random
from itertools import combinations
from math import ceil

import pytest
from pyspark.sql import functions as F

from sequon.llm import urls


def by_trial(rows, support, confidence):
    least, rules = ceil(support * len(rows)), {}
    every = sorted({t for tokens, _ in rows for t in tokens})
    for size in range(1, len(every) + 1):
        for items in combinations(every, size):
            verdicts = [v for tokens, v in rows if set(items) <= set(tokens)]
            for verdict in set(verdicts):
                n = verdicts.count(verdict)
                if n >= least and n / len(verdicts) >= confidence:
                    rules[items, verdict] = n / len(verdicts)
    return {
        (items, verdict): c
        for (items, verdict), c in rules.items()
        if not any(
            v == verdict and set(part) < set(items) and d >= c
            for (part, v), d in rules.items()
        )
    }


def table(spark, rows):
    return spark.createDataFrame(rows, "tokens array<string>, verdict string")


@pytest.mark.parametrize("seed", range(3))
def test_rules_are_those_of_every_combination(spark, seed):
    rng, rows = random.Random(seed), []
    for _ in range(60):
        tokens = [t for t in "abcde" if rng.random() < 0.5]
        # Tokens that always come together, and one of a single verdict.
        tokens += ["x", "y", "z"] if rng.random() < 0.4 else []
        bad = rng.random() < (0.85 if {"a", "x"} <= set(tokens) else 0.3)
        tokens += ["only"] if bad and rng.random() < 0.3 else []
        rows.append((tokens, "block" if bad else "allow"))
    found = urls.mine(table(spark, rows), 0.1, 0.6).collect()
    expected = by_trial(rows, 0.1, 0.6)
    assert {(tuple(r["items"]), r.verdict): pytest.approx(r.confidence) for r in found} == expected
    assert len(found) == len(expected) > 5


def test_deep_paths(spark):
    """Twenty parts that a third of the urls share, of one verdict and of both."""
    deep = [f"p:{i}" for i in range(20)]
    rows = [([f"h:{i}", *deep], "block") for i in range(30)]
    rows += [([f"h:{i}", "p:x"], "allow") for i in range(60)]
    sure = urls.mine(table(spark, rows)).where(F.array_contains("items", "p:7")).collect()
    assert [(r["items"], r.verdict, r.confidence) for r in sure] == [(["p:7"], "block", 1.0)]
    rows += [(deep, "allow")]
    mixed = urls.mine(table(spark, rows)).where(F.array_contains("items", "p:7")).collect()
    assert (["p:7"], "block") in [(r["items"], r.verdict) for r in mixed]
    assert all(len(set(deep) & set(r["items"])) == 1 for r in mixed)


def test_written_and_joined_rules_judge_alike(spark):
    rng = random.Random(5)
    rows = [(sorted(rng.sample("abcdef", 3)), rng.choice(["block", "block", "allow"])) for _ in range(40)]
    labelled = table(spark, rows)
    counted = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    rules = urls.mine(labelled, 0.05, 0.6)
    urls_ = [[t for t in "abcdefg" if rng.random() < 0.6] for _ in range(50)] + [[]]
    given = spark.createDataFrame(list(enumerate(urls_)), "at long, tokens array<string>")
    written, joined = (
        {r.at: r.mined for r in urls.matched(given, rules, counted, most).collect()}
        for most in (10**6, 0)
    )
    assert written == joined and len(written) == 51 and written[50] is None
    known = [(r.confidence, r.support, r.verdict, set(r["items"])) for r in rules.collect()]
    for at, tokens in enumerate(urls_):
        held = [k[:3] for k in known if k[3] <= set(tokens)]
        assert written[at] == (max(held)[2] if held else None)


def test_odd_tables(spark):
    """Repeated rows, columns named as results, a very long url, one verdict only, no rows."""
    long = "http://a.org/fr/" + "x/" * 50_000
    given = [(1, "H", "http://b.net/q"), (1, "H", "http://b.net/q"), (2, None, long), (None, "", None)]
    pages = spark.createDataFrame(given, "page_id long, host string, url string")
    found = urls.judge(pages, ["page_id", "host"])
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    rows = sorted(found.collect(), key=lambda r: r.page_id or 0)
    assert [r.host for r in rows] == ["", "b.net", "b.net", "a.org"]
    assert rows[1] == rows[2] and len(rows[3].path) == 100_004
    assert urls.judge(pages.limit(0), ["page_id"]).count() == 0
    one = urls.judge(pages.where("page_id = 1"), ["page_id"]).collect()
    assert [r.verdict for r in one] == ["block", "block"]
