"""Work of streams that must not grow with the number of keys, of tasks or of parts of a hot key."""

from datetime import timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sequon.streaming.kept import BUCKETS, identity
from sequon.streaming.routes import STRETCHES, dealt
from sequon.streaming.stretches import MOST_PARTS, reduce_stretches
from sequon.operators.sequence import match
from sequon.sources.ending import mark_end, run_to_end, with_end
from sequon.sources.sinks import write_outputs
from test_machine import ALERT
from test_streams import (
    add_files,
    finish,
    in_table,
    machine_alerts_of,
    match_stream,
    outcomes,
    paying,
    same_alerts,
    stream,
)

KEYS = 1200


def wide(kinds):
    """Two batches in which each of many keys has a row per kind."""
    rows = [
        (f"k{k}", i * 60_000 + k, i * KEYS + k, kind) for i, kind in enumerate(kinds) for k in range(KEYS)
    ]
    return [rows[: KEYS + 300], rows[KEYS + 300 :]]


@pytest.mark.parametrize("expire", [None, timedelta(minutes=30)])
def test_keys_of_a_machine_share_states(spark, tmp_path, expire):
    add_files(tmp_path / "in", wide(["fail", "fail", "fail", "fail"]))
    alerts = machine_alerts_of(spark, tmp_path, ALERT, expire=expire)
    query = finish(write_outputs(alerts, str(tmp_path / "out"), str(tmp_path / "progress"), "label"))
    same_alerts(spark, tmp_path, ALERT, expire=expire)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    # A state and, with expiry, its timer, which Spark lists twice.
    assert 0 < max(held) <= BUCKETS * (1 if expire is None else 3)


@pytest.mark.parametrize("buffered", [True, False])
def test_keys_of_a_sequence_share_states(spark, tmp_path, buffered):
    add_files(tmp_path / "in", wide(["create", "create", "pay", "modify", "create"]))
    marks, out, progress = (str(tmp_path / n) for n in ("marks", "out", "progress"))
    source = with_end(stream(spark, tmp_path / "in"), marks)
    # Slices so wide that all rows are in one.
    found = match_stream(
        source, paying(), ["key"], "at", "tie", ["tie", "at"], buffered=buffered, time_slice=timedelta(minutes=15)
    )
    held = []

    def start():
        query = finish(write_outputs(found, out, progress))
        held.extend(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress)
        return query

    run_to_end(start, lambda: mark_end(spark, marks, source.schema, "at"))
    assert outcomes(spark.read.parquet(out)) == in_table(spark, tmp_path)
    # An index, a timer, which Spark lists twice, and a chunk per micro-batch.
    assert 0 < max(held) <= BUCKETS * 5 and held[-1] == 0


@pytest.mark.parametrize("parts", [2, 3, 1000])
def test_copies_do_not_grow_with_parts(spark, parts):
    rows = spark.range(4000).select(
        F.lit("hot").alias("key"),
        F.timestamp_seconds(F.col("id") * 7).alias("at"),
        F.col("id").alias("tie"),
        F.when(F.col("id") % 2 == 0, "create").otherwise("pay").alias("kind"),
    )
    span = "array(named_struct('since', {0}, 'until', {1}, 'parts', {2}), named_struct('since', {1}, 'until', {3}, 'parts', 5))"
    whole, change = 2**62, 14_000_000_000
    routes = spark.range(1).select(
        F.lit("hot").alias("key"), F.expr(span.format(-whole, change, parts, whole)).alias("__routes")
    )
    within = paying().within
    salted, salt, here = dealt(rows, routes, ["key"], "at", "tie", F.col("kind") == "pay", within)
    sent = salted.select("key", "at", "tie", "kind", salt.alias("salt"), here.alias("here"))
    pays = sent.where("kind = 'pay'").groupBy("tie").count().agg(F.max("count")).first()[0]
    assert pays <= 2 * (STRETCHES + 2)
    assert sent.where("kind = 'create' and here").count() == sent.where("kind = 'create'").count() == 2000
    # Each task of the key finds the matches of its first steps.
    steps = sent.where("here or kind = 'pay'")
    split = match(steps, paying(), ["key", "salt"], "at", "tie", ["key", "tie", "at"])
    one = match(rows, paying(), ["key"], "at", "tie", ["key", "tie", "at"])
    found = split.select(F.col("create.key").alias("key"), "create", "pay", "status")
    assert outcomes(found) == outcomes(one.select("key", "create", "pay", "status"))


def test_parts_do_not_grow_with_tasks(spark):
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        rows = spark.range(20_000).select(F.col("id").cast("string").alias("key"), F.col("id").alias("at"))

        def size(part, starts):
            yield pa.RecordBatch.from_pydict({"rows": [part.num_rows]})

        found = reduce_stretches(rows, ["key"], ["at"], F.lit(0), "rows long", size).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
    assert found["rows"].sum() == 20_000 and len(found) <= MOST_PARTS


def test_identity():
    assert identity((float("nan"), bytearray(b"x"), [1])) == identity((float("nan"), b"x", [1]))
    assert identity((0.0, None)) == identity((-0.0, None)) != identity((0.0, "NaN"))
    assert identity((float("nan"),)) != identity((1.0,))


@pytest.mark.parametrize("buffered", [True, False])
def test_steps_reach_a_state_as_one_value(spark, tmp_path, buffered):
    """Spark hands every value of a row to a state one by one, so kept columns must cost nothing there."""
    add_files(tmp_path / "in", wide(["create", "pay"]))
    source = stream(spark, tmp_path / "in").select("*", *[F.lit(i).alias(f"more{i}") for i in range(20)])
    keep = ["tie", "at", *[f"more{i}" for i in range(20)]]
    found = match_stream(source, paying(), ["key"], "at", "tie", keep, buffered=buffered)
    query = finish(write_outputs(found, str(tmp_path / "out"), str(tmp_path / "progress")))
    plan = query._jsq.explainInternal(True).split("== Physical Plan ==")[1].splitlines()
    at = next(i for i, line in enumerate(plan) if "TransformWithStateInPySpark" in line)
    sent = next(line for line in plan[at + 1 :] if "Project [" in line)
    # The bucket, the step, the time.
    assert len(set(sent[sent.index("[") + 1 : sent.index("]")].split(", "))) <= 3
    # They are packed behind an exchange, not by the few tasks that read the source.
    packing = next(i for i, line in enumerate(plan) if "ArrowEvalPython [" in line)
    assert at < packing and any("Exchange hashpartitioning(bucket" in line for line in plan[packing + 1 :])
