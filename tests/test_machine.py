"""Runs and machines against a plain interpreter."""

import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sequon.operators.machine import (
    Machine,
    Rule,
    machine_alerts,
    run_alert_machine,
    run_machine,
    states_before,
)
from sequon.operators.runs import run_alerts, run_lengths
from sequon.streaming.machine import reduced
from sequon.streaming.stretches import stretch_starts

SCHEMA = "key string, place int, kind string"
ALERT = run_alert_machine("fail", "success")
TURNSTILE = Machine(
    "Shut",
    (
        Rule("Shut", "coin", "Open"),
        Rule("Open", "push", "Matched"),
        Rule("Open", "coin", "Jam"),
        Rule("Open", "coin", "Shut"),
        Rule("Jam", "coin", "Jam"),
        Rule("Jam", "push", "Jam"),
        Rule("Jam", "kick", "Open"),
        Rule("Open", "kick", "Terminal"),
    ),
)


def interpret(machine, kinds):
    """State after and alert flag of each event."""
    state, out = machine.initial, []
    for kind in kinds:
        target = next(
            (r.target for r in machine.rules if r.state == state and r.event == kind),
            machine.initial,
        )
        if target != machine.matched:
            state = machine.initial if target == machine.ended else target
        out.append((state, target == machine.matched))
    return out


def table(spark, trace):
    return spark.createDataFrame([("k", i, kind) for i, kind in enumerate(trace)], SCHEMA)


def traced(spark, machine, trace, **options):
    found = run_machine(table(spark, trace), machine, ["key"], ["place"], F.col("kind"), **options)
    return [(r.state, r.matched) for r in found.orderBy("place").collect()]


TRACE = ["fail"] * 4 + ["x"] + ["fail"] * 2 + ["success", "fail", None] + ["fail"] * 3


@pytest.mark.parametrize("segment_rows", [2_000_000, 4, 1])
def test_alert_trace(spark, segment_rows):
    found = traced(spark, ALERT, TRACE, segment_rows=segment_rows)
    assert [i + 1 for i, (_, alert) in enumerate(found) if alert] == [3, 4, 13]
    assert found[-1][0] == "S2"
    assert found == interpret(ALERT, TRACE)


@pytest.mark.parametrize(
    "trace, alerts",
    [
        (["fail"] * 4, [2, 3]),
        (["fail", "fail", "x", "fail"], []),
        (["fail", "fail", None, "fail"], []),
    ],
)
def test_runs_edges(spark, trace, alerts):
    found = run_alerts(table(spark, trace), ["key"], ["place"], F.col("kind") == "fail")
    assert sorted(r.place for r in found.collect()) == alerts


def test_first_rule_wins_and_unknown_events_reset(spark):
    trace = ["coin", "coin", "kick", "push", "push", "zap", "push", "coin", "kick", "push"]
    assert traced(spark, TURNSTILE, trace) == interpret(TURNSTILE, trace)
    alerts = machine_alerts(table(spark, trace), TURNSTILE, ["key"], ["place"], F.col("kind"))
    assert sorted(r.place for r in alerts.collect()) == [3, 4]


@pytest.fixture(params=[10_000, 3])
def batch_rows(spark, request):
    """Arrow batches that hold all rows, or end within groups."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("segment_rows", [2_000_000, 7])
def test_several_and_odd_keys(spark, segment_rows, batch_rows):
    """Keys that are not numbers or are zero with a sign, and more key columns than one."""
    odd = [float("nan"), 0.0, -0.0, 1.5]
    rows = [(odd[i % 4], "ab"[i // 20 % 2], i, "fail" if i % 7 else "x") for i in range(80)]
    data = spark.createDataFrame(rows, "n double, k string, place int, kind string")
    found = run_machine(
        data, ALERT, ["n", "k"], ["place"], F.col("kind"), segment_rows=segment_rows
    )
    by_key = {}
    for n, k, place, kind in rows:
        by_key.setdefault((str(n + 0.0), k), []).append((place, kind))
    expected = {
        place: result
        for events in by_key.values()
        for (place, _), result in zip(events, interpret(ALERT, [e[1] for e in events]))
    }
    assert {r.place: (r.state, r.matched) for r in found.collect()} == expected


@pytest.mark.parametrize("segment_rows", [2_000_000, 100])
def test_three_hundred_states(spark, segment_rows):
    n = 300
    rules = [Rule(f"S{i}", "on", f"S{(i + 1) % n}") for i in range(n)]
    ring = Machine("S0", (*rules, *(Rule(f"S{i}", "ask", "Matched") for i in range(250, n))))
    trace = (["on"] * 280 + ["ask", "on"]) * 3
    found = traced(spark, ring, trace, segment_rows=segment_rows)
    assert found == interpret(ring, trace)
    assert any(alert for _, alert in found)


def test_nested_keys_are_refused(spark):
    data = spark.createDataFrame([([1], 1, "fail")], "key array<int>, place int, kind string")
    with pytest.raises(TypeError):
        run_machine(data, ALERT, ["key"], ["place"], F.col("kind"))


def test_machine_without_rules(spark):
    assert traced(spark, Machine("Only", ()), ["a", None]) == [("Only", False)] * 2


@pytest.mark.parametrize("parts", [(None, "a", "b"), ("a", None, "b"), ("a", "b", None)])
def test_rule_parts_are_required(parts):
    with pytest.raises(ValueError):
        Rule(*parts)


def test_end_states_have_no_rules():
    with pytest.raises(ValueError):
        Machine("A", (Rule("Matched", "x", "A"),))
    with pytest.raises(ValueError):
        Machine("Terminal", ())


@pytest.mark.parametrize("seed, segment_rows", [(1, 2_000_000), (2, 40), (3, 9), (4, 2), (5, 1)])
@pytest.mark.parametrize("machine", [ALERT, TURNSTILE])
def test_random_keys(spark, machine, seed, segment_rows):
    dice = random.Random(seed)
    kinds = [*machine.events, "other", None]
    keys = ["hot", "hot", "hot", *"abcdef"]
    rows = [(dice.choice(keys), i, dice.choice(kinds)) for i in range(500)]
    by_key = {}
    for key, i, kind in rows:
        by_key.setdefault(key, []).append((i, kind))
    expected = {
        i: result
        for events in by_key.values()
        for (i, _), result in zip(events, interpret(machine, [k for _, k in events]))
    }
    dice.shuffle(rows)
    data = spark.createDataFrame(rows, SCHEMA)
    options = {"segment_rows": segment_rows}
    found = run_machine(data, machine, ["key"], ["place"], F.col("kind"), **options)
    assert {r.place: (r.state, r.matched) for r in found.collect()} == expected

    hit = machine.events[0]
    lengths, expected = {}, {}
    for events in by_key.values():
        run = 0
        for i, kind in events:
            run = run + 1 if kind == hit else 0
            expected[i] = run
    found = run_lengths(data, ["key"], ["place"], F.col("kind") == hit, **options)
    lengths = {r.place: r.run_length for r in found.collect()}
    assert lengths == expected


steps = st.lists(st.lists(st.integers(0, 2), min_size=3, max_size=3), min_size=1, max_size=60)


@settings(max_examples=200, deadline=None)
@given(steps, st.lists(st.booleans(), min_size=60, max_size=60), st.integers(1, 60), st.integers(0, 2))
def test_prefixes(functions, flags, size, entry):
    """Any functions, any groups, any batch size: one step at a time gives the same."""
    step = np.array(functions, dtype=np.int8)
    starts = np.array(flags[: len(step)])
    starts[0] = True
    for known in (None, entry):
        last, parts = np.arange(3, dtype=np.int8), []
        for at in range(0, len(step), size):
            before, last = states_before(step[at : at + size], starts[at : at + size], last, known)
            parts.append(before)
        found = np.concatenate(parts)
        state = None
        for i, function in enumerate(step):
            if starts[i]:
                state = np.arange(3) if known is None else np.array([known])
            assert found[i].tolist() == state.tolist()
            state = function[state]


def test_reduced_stretches():
    """Stretches, applied one after the other, report what the interpreter reports."""
    import pyarrow as pa

    dice = random.Random(7)
    moves, reports = TURNSTILE.table()
    kinds = [*TURNSTILE.events, None]
    trace = {key: [dice.choice(kinds) for _ in range(80)] for key in "ab"}
    state = dict.fromkeys(trace, 0)
    alerts = {key: [] for key in trace}
    for begin in range(0, 80, 16):
        rows = [
            (key, i, TURNSTILE.events.index(kind) if kind else TURNSTILE.other)
            for key, events in trace.items()
            for i, kind in enumerate(events)
            if begin <= i < begin + 16
        ]
        batch = pa.table(
            {
                "key0": [r[0] for r in rows],
                "order0": [r[1] for r in rows],
                "kept0": [r[1] for r in rows],
                "symbol": pa.array([r[2] for r in rows], pa.int32()),
            }
        )
        for out in reduced(
            batch, stretch_starts(batch, ["key0"]), moves, reports, ["key0"], ["order0"], ["kept0"]
        ):
            for piece in out.to_pylist():
                key = piece["key0"]
                assert piece["order0"] == begin
                if piece["moves"] is None:
                    if piece["when"][state[key]]:
                        alerts[key].append(piece["kept0"])
                else:
                    state[key] = piece["moves"][state[key]]
    for key, events in trace.items():
        expected = [i for i, (_, alert) in enumerate(interpret(TURNSTILE, events)) if alert]
        assert alerts[key] == expected


MINUTE = timedelta(minutes=1)


def timed_table(spark, seed, size=120):
    """Events at most twenty minutes apart, several at one time, some gaps exactly ten."""
    rng, at, rows = random.Random(seed), datetime(2024, 1, 1, tzinfo=timezone.utc), []
    for i in range(size):
        at += rng.choice([0, 1, 2, 10, 20]) * MINUTE
        rows.append((rng.choice("kkkab"), at, i, rng.choice(["coin", "push", "kick", "fail", "fail", None])))
    return rows, spark.createDataFrame(rows, "key string, at timestamp, place int, kind string")


@pytest.mark.parametrize("segment_rows", [2_000_000, 8, 1])
@pytest.mark.parametrize("machine", [ALERT, TURNSTILE])
def test_expiry(spark, machine, segment_rows):
    """State ends where a row comes ten minutes or more after the one before it."""
    rows, events = timed_table(spark, segment_rows)
    expected = {}
    for key in "kab":
        stretch, last = [], None
        for row in [r for r in rows if r[0] == key]:
            if last is not None and row[1] - last >= 10 * MINUTE:
                stretch = []
            stretch.append(row[3])
            last = row[1]
            expected[row[2]] = interpret(machine, stretch)[-1]
    untimed = events.limit(5).withColumn("at", F.lit(None).cast("timestamp")).withColumn("place", F.lit(-1))
    found = run_machine(
        events.union(untimed), machine, ["key"], ["at", "place"], F.col("kind"),
        segment_rows=segment_rows, expire=10 * MINUTE,
    )
    assert {r.place: (r.state, r.matched) for r in found.collect()} == expected


def test_expiry_shares_the_exchange(spark):
    events = timed_table(spark, 3)[1]
    found = run_machine(
        events, ALERT, ["key"], ["at", "place"], F.col("kind"), expire=10 * MINUTE
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
