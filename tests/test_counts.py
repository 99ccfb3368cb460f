"""Rows that operators refuse are counted where they are refused."""

from datetime import timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sequon.operators.machine import run_machine
from sequon.operators.runs import run_alerts, run_lengths
from sequon.operators.sequence import match
from sequon.sources.sinks import write_outputs
from sequon.streaming.counts import counted
from sequon.streaming.machine import machine_stream
from sequon.streaming.sequence import match_stream
from test_machine import ALERT
from test_streams import SCHEMA, add_files, closing, finish, paying, stream

ROWS = [("a", 60_000, 1, "create"), (None, 60_000, 2, "create"), (None, 60_000, 3, None), ("a", 70_000, 4, "pay")]


def without_time(rows):
    return rows.withColumn("at", F.when(F.col("tie") != 7, F.col("at")))


def test_table(spark, tmp_path):
    add_files(tmp_path / "in", [[*ROWS, ("b", 0, 7, "create")]])
    rows = without_time(spark.read.schema(SCHEMA).parquet(str(tmp_path / "in")))
    for segment_rows in (2_000_000, 1):
        seen = Observation()
        found = match(rows, paying(), ["key"], "at", "tie", segment_rows=segment_rows, seen=seen)
        assert [r.status for r in found.collect()] == ["payed"]
        assert seen.get == {"accepted": 2, "rejected": 2, "untimed": 1}


@pytest.mark.parametrize("segment_rows", [2_000_000, 1])
def test_runs_and_machines_over_tables(spark, tmp_path, segment_rows):
    add_files(tmp_path / "in", [[*ROWS, ("b", 0, 7, "create")]])
    rows = without_time(spark.read.schema(SCHEMA).parquet(str(tmp_path / "in")))
    order, hit, options = ["at", "tie"], F.col("kind") == "create", {"segment_rows": segment_rows}
    for run, kept in ((run_lengths, 3), (run_alerts, 0)):
        seen = Observation()
        assert len(run(rows, ["key"], order, hit, seen=seen, **options).collect()) == kept
        assert seen.get == {"accepted": 3, "rejected": 2}
    seen = Observation()
    args = rows, ALERT, ["key"], order, F.col("kind")
    assert len(run_machine(*args, seen=seen, **options).collect()) == 3
    assert seen.get == {"accepted": 3, "rejected": 2}
    seen = Observation()
    found = run_machine(*args, seen=seen, expire=timedelta(days=1), **options)
    assert len(found.collect()) == 2
    assert seen.get == {"accepted": 2, "rejected": 2, "untimed": 1}


def test_sequence_stream(spark, tmp_path):
    batches = [
        [*ROWS, ("b", 0, 7, "create")],
        [("c", 80_000, 8, "modify")],
        [("late", 10, 9, "create"), ("late", 20, 10, "create")],
        closing(10**7),
    ]
    add_files(tmp_path / "in", batches)
    source = without_time(stream(spark, tmp_path / "in"))
    found = match_stream(source, paying(), ["key"], "at", "tie", ["tie"], seen="refused")
    query = finish(write_outputs(found, str(tmp_path / "out"), str(tmp_path / "progress")))
    assert counted(query.recentProgress, "refused") == {
        "accepted": 6, "rejected": 2, "untimed": 1, "late": 2
    }
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_machine_stream(spark, tmp_path):
    add_files(tmp_path / "in", [ROWS, ROWS])
    found = machine_stream(
        stream(spark, tmp_path / "in"), ALERT, ["key"], ["at", "tie"], F.col("kind"), ["tie"], seen="refused"
    ).withColumn("label", F.lit("warning"))
    query = finish(write_outputs(found, str(tmp_path / "out"), str(tmp_path / "progress"), "label"))
    got = counted(query.recentProgress, "refused")
    assert (got["accepted"], got["rejected"], got["late"]) == (4, 4, 0)
