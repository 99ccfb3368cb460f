"""Stretches in parts: what a task holds at a time, and what reaches the state of a key."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sequon.operators.machine import run_alert_machine
from sequon.streaming.machine import reduced
from sequon.streaming.stretches import PARTS, reduce_stretches


def test_a_task_holds_a_small_part_at_a_time(spark):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(400_000).select(
        (F.col("id") % 20).cast("string").alias("key"), F.hash("id").alias("at"), "id"
    )

    def size(part, starts):
        yield pa.RecordBatch.from_pydict(
            {"rows": [part.num_rows], "stretches": [int(starts.sum())], "total": [sum(part["id"].to_pylist())]}
        )

    # Slots of about 2,000 rows over all keys, 100 of a key.
    place = F.floor(F.col("at") / 21_474_836)
    out = reduce_stretches(rows, ["key"], ["at", "id"], place, "rows long, stretches long, total long", size)
    found = out.toPandas()
    whole = rows.select("key", place.alias("slot")).distinct().count()
    assert found["rows"].sum() == 400_000 and found["stretches"].sum() == whole
    assert found["total"].sum() == 400_000 * 399_999 // 2
    assert found["rows"].max() < 20 * 400_000 / (tasks * PARTS)


def test_rows_certain_to_be_reported_do_not_reach_the_state():
    machine = run_alert_machine("fail", "success")
    moves, reports = machine.table()
    n = 10_000
    rows = pa.table(
        {"key0": ["a"] * n, "order0": range(n), "kept0": range(n), "symbol": [0] * n}
    )
    starts = np.zeros(n, bool)
    starts[[0, n // 2]] = True
    out = pa.Table.from_batches(reduced(rows, starts, moves, reports, ["key0"], ["order0"], ["kept0"]))
    pieces = out.to_pylist()
    certain = [p["kept0"] for p in pieces if p["when"] is not None and all(p["when"])]
    # The first two of a stretch depend on what came before it.
    assert certain == [i for i in range(n) if i % (n // 2) >= 2]
    assert len(pieces) - len(certain) == 6
