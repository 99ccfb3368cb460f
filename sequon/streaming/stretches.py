"""Stretches: the rows of one key within one slot of its order, in one micro-batch.

Rows are dealt out by the hash of key and slot, so that the rows of a hot key go to many tasks
and the source is read once. A task takes its stretches in parts, brought together by a sort that
Spark spills, and Python holds one part at a time: the largest stretch, or a ``PARTS``-th of the
task; with many tasks a ``MOST_PARTS``-th of the micro-batch. Each stretch is reduced to what the state of the key needs to know; what passes from one
slot to the next is carried by that state. The same rows always form the same stretches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SLOT, _PART = "slot", "part"
#: Parts a task has on average; each costs a millisecond or more, however few its rows.
PARTS = 256
#: Most parts of all tasks, unless there are more tasks than that.
MOST_PARTS = 2048


def reduce_stretches(
    flat: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slot: Column,
    schema: T.StructType,
    reduce: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]],
) -> DataFrame:
    """Give ``reduce`` the rows of each part, in order, with the starts of its stretches.

    ``slot`` must not go down along ``order``; null for rows whose place is null.
    """
    sort_by = [(n, "ascending") for n in (*keys, _SLOT, *order)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(b for b in batches if b.num_rows).drop_columns(_PART)
        # Nulls first, as Spark sorts them.
        places = pc.sort_indices(rows, sort_keys=sort_by, null_placement="at_start")
        rows = rows.take(places)
        yield from reduce(rows, stretch_starts(rows, [*keys, _SLOT]))

    tasks = int(flat.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = flat.withColumn(_SLOT, slot)
    parts = max(tasks, min(tasks * PARTS, MOST_PARTS))
    part = F.pmod(F.xxhash64(*keys, _SLOT), F.lit(parts))
    return dealt.withColumn(_PART, part).groupBy(_PART).applyInArrow(run, schema)


def stretch_starts(rows: pa.Table, names: Sequence[str]) -> np.ndarray:
    """True at the first row of each group of equal values, nulls equal, in sorted rows."""
    starts = np.zeros(rows.num_rows, dtype=bool)
    for name in names:
        column = rows.column(name)
        now, last = column[1:], column[:-1]
        differs = pc.fill_null(pc.not_equal(now, last), False)
        starts[1:] |= pc.or_(differs, pc.xor(now.is_null(), last.is_null())).to_numpy()
    starts[0] = True
    return starts
