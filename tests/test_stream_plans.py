"""Streams started anew with other plans, ended inputs, tables replayed, level work."""

import random

import pytest
from pyspark.sql import functions as F

from sequon.operators.sequence import match
from sequon.plans.segments import plan_segments
from sequon.sources.ending import mark_end, replay, run_to_end, with_end
from sequon.sources.sinks import write_outputs
from sequon.sources.tables import arriving
from sequon.streaming.routes import has_routes, plan_routes
from sequon.streaming.sequence import match_stream
from test_streams import SCHEMA, add_files, disorder, finish, in_table, outcomes, paying, stream

DELAY = "5001 milliseconds"


def plan(spark, tmp_path, rows):
    """None, or a plan by segments of so many rows."""
    if rows is None:
        return None
    past = spark.read.schema(SCHEMA).parquet(str(tmp_path / "in"))
    return plan_segments(past, ["key"], ["at", "tie"], segment_rows=rows)


def run(spark, tmp_path, segment_rows, ends=False):
    """One start of the stream, on all files at hand, with a plan of its own."""
    pattern, progress = paying(), str(tmp_path / "progress")
    routes = plan_routes(
        spark, progress, ["key"], plan(spark, tmp_path, segment_rows), DELAY, pattern.within
    )
    source = stream(spark, tmp_path / "in")
    if ends:
        source = with_end(source, str(tmp_path / "marks"))
    found = match_stream(source, pattern, ["key"], "at", "tie", ["tie", "at"], DELAY, routes=routes)
    finish(write_outputs(found, str(tmp_path / "out"), progress))
    return routes


def parts(routes):
    rows = routes.where("key = 'hot'").collect() if has_routes(routes) else []
    return [v["parts"] for v in rows[0]["__routes"]] if rows else []


@pytest.mark.parametrize("plans, most", [((None, 20, 120), 8), ((10, None, 60), 3)])
def test_plans_that_change(spark, tmp_path, plans, most):
    """More parts, fewer and none: as if there had been no plan at all."""
    batches = disorder(7)
    rows = [r for batch in batches[:-1] for r in batch]
    size = -(-len(rows) // len(plans))
    versions = []
    for i, segment_rows in enumerate(plans):
        # Each run ends amid disorder, so that steps of both plans wait in the state.
        add_files(tmp_path / "in", [rows[i * size : (i + 1) * size]], begin=i)
        versions.append(parts(run(spark, tmp_path, segment_rows)))
    add_files(tmp_path / "in", batches[-1:], begin=len(plans))
    run(spark, tmp_path, plans[-1])
    expected = in_table(spark, tmp_path)
    assert outcomes(spark.read.parquet(str(tmp_path / "out"))) == expected
    assert {r[-1] for r in expected} == {"payed", "timeout"}
    assert len(versions[-1]) >= 2, versions
    assert max(max(v, default=1) for v in versions) > most, versions


def test_a_plan_that_stays_adds_no_version(spark, tmp_path):
    rows = [r for batch in disorder(8)[:-1] for r in batch]
    add_files(tmp_path / "in", [rows[:300]])
    first = run(spark, tmp_path, 60)
    assert parts(run(spark, tmp_path, 60)) == parts(first)


@pytest.mark.parametrize("buffered", [True, False])
def test_the_end_of_an_input(spark, tmp_path, buffered):
    """All that is open is reported once the end is marked."""
    rows = sorted((r for batch in disorder(4)[:-1] for r in batch), key=lambda r: (r[1], r[2]))
    add_files(tmp_path / "in", [rows[i : i + 90] for i in range(0, len(rows), 90)])
    marks, out, progress = (str(tmp_path / n) for n in ("marks", "out", "progress"))
    source = with_end(stream(spark, tmp_path / "in"), marks)
    found = match_stream(
        source, paying(), ["key"], "at", "tie", ["tie", "at"], buffered=buffered
    )
    counts = []

    def start():
        query = write_outputs(found, out, progress)
        query.awaitTermination()
        counts.append(spark.read.parquet(out).count())
        return query

    run_to_end(start, lambda: mark_end(spark, marks, source.schema, "at"))
    expected = in_table(spark, tmp_path)
    assert outcomes(spark.read.parquet(out)) == expected
    assert counts[0] < counts[1] == len(expected)


def test_no_end_before_it_is_marked(spark, tmp_path):
    add_files(tmp_path / "in", [[("a", 0, 1, "create")]])
    run(spark, tmp_path, None, ends=True)
    assert not list((tmp_path / "out").glob("status=*"))
    mark_end(spark, str(tmp_path / "marks"), stream(spark, tmp_path / "in").schema, "at")
    run(spark, tmp_path, None, ends=True)
    assert [r[-1] for r in outcomes(spark.read.parquet(str(tmp_path / "out")))] == ["timeout"]


def test_replay(spark, tmp_path):
    rows = [("k", i * 1000, i, "view") for i in range(1000)]
    random.Random(1).shuffle(rows)
    add_files(tmp_path / "in", [rows + [("k", 5, 2000, "late")]])
    table = spark.read.schema(SCHEMA).parquet(str(tmp_path / "in"))
    table = table.withColumn("at", F.when(F.col("kind") != "late", F.col("at")))
    folder = str(tmp_path / "slices")
    replay(table, folder, "at", 12, files=2)
    source = arriving(spark, folder, table.schema, 2)
    query = finish(write_outputs(source, str(tmp_path / "out"), str(tmp_path / "progress"), "kind"))
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert len(sizes) == 12 and sum(sizes) == 1001 and max(sizes) < 120
    # Each micro-batch is later than the one before.
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1001


def test_replay_of_few_rows_and_none(spark, tmp_path):
    table = spark.createDataFrame([("k", None, 1, "view")], SCHEMA)
    replay(table, str(tmp_path / "one"), "at", 5)
    assert spark.read.parquet(str(tmp_path / "one")).count() == 1
    replay(table.limit(0), str(tmp_path / "none"), "at", 5)
    assert spark.read.schema(table.schema).parquet(str(tmp_path / "none")).count() == 0


def test_time_slices(spark, tmp_path):
    """Any slice of time gives the same outcomes."""
    from datetime import timedelta

    add_files(tmp_path / "in", disorder(5))
    expected = in_table(spark, tmp_path)
    for i, wide in enumerate((timedelta(seconds=1), timedelta(hours=2), timedelta(milliseconds=7 * 60_001))):
        found = match_stream(
            stream(spark, tmp_path / "in"), paying(), ["key"], "at", "tie", ["tie", "at"], DELAY, time_slice=wide
        )
        finish(write_outputs(found, str(tmp_path / f"out{i}"), str(tmp_path / f"progress{i}")))
        assert outcomes(spark.read.parquet(str(tmp_path / f"out{i}"))) == expected


def test_input_is_read_once(spark, tmp_path):
    """Slots need no sample of the input, and settled matches share its exchange."""
    rows = [("k", i * 1000, i, "create" if i % 3 else "pay") for i in range(600)]
    add_files(tmp_path / "in", [rows[i : i + 200] for i in range(0, 600, 200)])
    found = match_stream(
        stream(spark, tmp_path / "in"), paying(), ["key"], "at", "tie", ["tie", "at"], buffered=False
    )
    query = finish(write_outputs(found, str(tmp_path / "out"), str(tmp_path / "progress")))
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [200] * 3
    # What the state of the key got: fewer rows than matches that passed it by.
    states = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
    assert len(states) == 3
    assert spark.read.parquet(str(tmp_path / "out")).where("status = 'payed'").count() == 398


def test_work_stays_level_while_nothing_closes(spark, tmp_path):
    """Twenty micro-batches of first steps of one key: the last cost no more than the first."""
    from datetime import timedelta

    from sequon.operators.sequence import Pattern, Step

    kind = F.col("kind")
    pattern = Pattern(Step("create", kind == "create"), Step("pay", kind == "pay"), timedelta(days=30))
    size = 1500
    batches = [
        [("hot", (b * size + i) * 1000, b * size + i, "create") for i in range(size)] for b in range(20)
    ]
    add_files(tmp_path / "in", batches)
    found = match_stream(
        stream(spark, tmp_path / "in"), pattern, ["key"], "at", "tie", ["tie", "at"],
        time_slice=timedelta(seconds=size),
    )
    query = finish(write_outputs(found, str(tmp_path / "out"), str(tmp_path / "progress")))
    took = [p["durationMs"]["addBatch"] for p in query.recentProgress if p["numInputRows"]]
    assert len(took) == 20
    middle = lambda values: sorted(values)[len(values) // 2]
    assert middle(took[-6:]) < 1.6 * middle(took[2:8])
    table = spark.read.schema(SCHEMA).parquet(str(tmp_path / "in"))
    assert match(table, pattern, ["key"], "at", "tie").count() == 20 * size
