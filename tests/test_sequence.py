"""Two-step sequences: each convention, and random input against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sequon.operators.sequence import Pattern, Step, match

SCHEMA = "key string, at timestamp, tie int, kind string"
START = datetime(2024, 1, 1)
MINUTES = 15


def pattern(inclusive=False):
    kind = F.col("kind")
    return Pattern(
        Step("create", kind == "create"),
        Step("pay", kind == "pay"),
        timedelta(minutes=MINUTES),
        inclusive,
    )


def run(spark, rows, inclusive=False, **options):
    """Rows are (key, seconds, tie, kind); results (key, create tie, pay tie, status)."""
    table = spark.createDataFrame(
        [(k, START + timedelta(seconds=s), t, kind) for k, s, t, kind in rows], SCHEMA
    )
    found = match(table, pattern(inclusive), ["key"], "at", "tie", ["tie"], **options)
    return sorted(
        (r.key, r.create.tie, r.pay.tie if r.pay else None, r.status) for r in found.collect()
    )


def test_pay_at_the_bound_is_too_late(spark):
    rows = [("a", 600, 1, "create"), ("a", 1500, 2, "pay")]
    assert run(spark, rows) == [("a", 1, None, "timeout")]
    assert run(spark, rows, inclusive=True) == [("a", 1, 2, "payed")]


def test_two_creates_share_a_pay(spark):
    rows = [("a", 600, 1, "create"), ("a", 601, 2, "create"), ("a", 660, 3, "pay")]
    assert run(spark, rows) == [("a", 1, 3, "payed"), ("a", 2, 3, "payed")]


def test_first_of_two_pays(spark):
    rows = [("a", 0, 1, "create"), ("a", 60, 2, "pay"), ("a", 70, 3, "pay")]
    assert run(spark, rows) == [("a", 1, 2, "payed")]


@pytest.mark.parametrize("pay, status", [(2, "payed"), (0, "timeout")])
def test_tie_orders_equal_times(spark, pay, status):
    rows = [("a", 5, 1, "create"), ("a", 5, pay, "pay")]
    assert run(spark, rows)[0][3] == status


def test_pay_alone_gives_nothing(spark):
    assert run(spark, [("a", 5, 1, "pay")]) == []


def test_null_kind_is_skipped(spark):
    rows = [("a", 0, 1, "create"), ("a", 10, 2, None), ("a", 20, 3, "pay")]
    assert run(spark, rows) == [("a", 1, 3, "payed")]


def test_null_key_is_refused(spark):
    assert run(spark, [(None, 0, 1, "create"), ("a", 0, 1, "create")]) == [("a", 1, None, "timeout")]


def test_as_of(spark):
    rows = [("a", 0, 1, "create"), ("a", 600, 2, "create"), ("a", 1000, 3, "pay")]
    at = START + timedelta(seconds=900)
    assert run(spark, rows, as_of=at) == [("a", 1, None, "timeout"), ("a", 2, None, "pending")]
    assert run(spark, rows) == [("a", 1, None, "timeout"), ("a", 2, 3, "payed")]


def test_row_that_is_both_steps(spark):
    """Such a row ends the match before it and starts the next, not its own."""
    rows = [("a", 0, 1, "x"), ("a", 10, 2, "x")]
    table = spark.createDataFrame(
        [(k, START + timedelta(seconds=s), t, kind) for k, s, t, kind in rows], SCHEMA
    )
    both = Pattern(
        Step("one", F.col("kind") == "x"), Step("two", F.col("kind") == "x"), timedelta(minutes=1)
    )
    found = match(table, both, ["key"], "at", "tie", ["tie"]).collect()
    assert sorted((r.one.tie, r.two.tie if r.two else None) for r in found) == [(1, 2), (2, None)]


def test_bad_patterns():
    yes = F.lit(True)
    with pytest.raises(ValueError):
        Pattern(Step("a", yes), Step("a", yes), timedelta(1))
    with pytest.raises(ValueError):
        Pattern(Step("a", yes), Step("b", yes), timedelta(0))


def brute_force(rows, inclusive):
    out = []
    for key, s, t, kind in rows:
        if kind != "create" or key is None:
            continue
        later = [(s2, t2) for k2, s2, t2, kind2 in rows if k2 == key and kind2 == "pay" and (s2, t2) > (s, t)]
        pay = min(later, default=None)
        bound = MINUTES * 60
        good = pay and (pay[0] - s <= bound if inclusive else pay[0] - s < bound)
        out.append((key, t, pay[1] if good else None, "payed" if good else "timeout"))
    return sorted(out)


@pytest.mark.parametrize("seed, segment_rows", [(1, 2_000_000), (1, 20), (2, 5), (3, 1)])
def test_random(spark, seed, segment_rows):
    dice = random.Random(seed)
    # One key holds a third of the rows.
    rows = [
        (
            dice.choice(["hot", "hot", "a", "b", "c", "d", None]),
            dice.randrange(0, 40) * 100,
            tie,
            dice.choice(["create", "pay", "modify", None]),
        )
        for tie in range(400)
    ]
    inclusive = seed % 2 == 0
    assert run(spark, rows, inclusive, segment_rows=segment_rows) == brute_force(rows, inclusive)
