"""Two-step sequences over a stream."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from datetime import timedelta
from itertools import batched

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor

from sequon.model import counted_keys, has_key
from sequon.operators.sequence import MATCHED, TIMED_OUT, Pattern
from sequon.plans.segments import Segments
from sequon.streaming.folders import keep_state_on_disk
from sequon.streaming.kept import BUCKET, identity, in_buckets, plain, typed
from sequon.streaming.routes import dealt, fixed_routes, has_routes
from sequon.streaming.stretches import reduce_stretches

_SALT, _AT, _TIE, _FIRST, _SECOND = "salt", "at", "tie", "is_first", "is_second"
_STATUS, _STEP, _FOUND = "status", "step", "found"
_MICRO = timedelta(microseconds=1)
# Slices of time in a bound, unless told otherwise.
SLICES = 32
# Slots per slice that the rows of a micro-batch are dealt out by.
_SLOTS = 8
# Outcomes that a state gives back in one row.
_TOGETHER = 10_000


def match_stream(
    df: DataFrame,
    pattern: Pattern,
    keys: Sequence[str],
    ts: str,
    tie: str,
    keep: Sequence[str] | None = None,
    delay: str = "1 millisecond",
    buffered: bool = True,
    segments: Segments | None = None,
    routes: DataFrame | None = None,
    time_slice: timedelta | None = None,
    seen: str | None = None,
) -> DataFrame:
    """As the batch operator, one row per first step, once its outcome is certain.

    ``ts`` must be a timestamp with time zone. By default steps wait until the
    watermark, ``delay`` behind the latest time, has passed them and are then taken in
    time order. With ``routes``, from ``plan_routes``, the first steps of a hot key are
    dealt out to several tasks, by a plan that may change whenever the stream is started.
    ``segments`` is such a plan for a stream that keeps it for ever.

    Steps are held by slices of time, a 32nd of the bound unless ``time_slice`` says
    otherwise. A slice is taken as a whole once the watermark has passed its end, so an
    outcome may be reported that much later; more slices cost more calls to the state.

    Where each micro-batch holds later times than the one before, ``buffered=False``
    takes steps as they come. Matches within a slot of time are then settled on the way,
    by columns, and go straight to the output; only the first second step of a slot and the
    first steps left open in it reach the state. Keys share states (``streaming.kept``).

    Rows without a key or a time are left out; under the name ``seen`` the progress of the
    query counts them. Matches still open when the stream ends are not reported, unless the end of the input
    is marked (``sources.ending``).
    """
    keep_state_on_disk(df.sparkSession)
    keep = list(keep) if keep is not None else df.columns
    is_first, is_second = pattern.first.where, pattern.second.where
    # Rows of neither step move time on as well, so they must reach the watermark. A
    # condition on the time column itself is not pushed below it.
    is_step = (is_first | is_second) & has_key(keys)
    timed = df.withWatermark(ts, delay)
    if seen is not None:
        timed = counted_keys(timed, keys, seen, ts)
    steps = timed.where(F.when(F.col(ts).isNotNull(), is_step))
    first, second = F.coalesce(is_first, F.lit(False)), F.coalesce(is_second, F.lit(False))
    salt = F.lit(0)
    if routes is None and segments is not None and segments.split:
        routes = fixed_routes(segments)
    if buffered and has_routes(routes):
        salted, salt, starts_here = dealt(
            steps, routes, list(keys), ts, tie, second, pattern.within
        )
        steps, first = salted, first & F.coalesce(starts_here, F.lit(False))
    flat = steps.select(
        *[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)],
        # Never null, with or without a plan: a state keeps the types it began with.
        F.coalesce(salt, F.lit(0)).alias(_SALT),
        F.unix_micros(ts).alias(_AT),
        plain(df, tie).alias(_TIE),
        first.alias(_FIRST),
        second.alias(_SECOND),
        *[plain(df, c).alias(f"kept{i}") for i, c in enumerate(keep)],
        F.col(ts).alias("time"),
    )
    kept = T.StructType([flat.schema[f"kept{i}"] for i in range(len(keep))])
    groups = [flat.schema[f"key{i}"] for i in range(len(keys))]
    leading = [flat.schema[c] for c in (_AT, _TIE, _FIRST, _SECOND, _SALT)]
    step = T.StructType([*leading, *groups, *kept])
    nexts = [T.StructField(f"next{i}", f.dataType) for i, f in enumerate(kept)]
    out = T.StructType([*groups, *kept, *nexts, T.StructField(_STATUS, T.StringType())])
    # Times are whole microseconds, so a match may be at most this long.
    within = pattern.within // _MICRO
    longest = within if pattern.inclusive else within - 1
    names = [g.name for g in groups]
    wide = max(1, (time_slice // _MICRO) if time_slice is not None else within // SLICES)
    settled = None
    if not buffered:
        # Both parts read the same exchange: stretches are the same whoever asks.
        reduced = _settled(flat, names, kept, longest, max(1, wide // _SLOTS))
        settled = reduced.where(F.col(_STATUS).isNotNull())
        flat = reduced.where(F.col(_STATUS).isNull())
    processor = FollowedBy(step, within, longest, buffered, wide)
    moment = [c for c in ("time",) if c in flat.columns]
    # Packed behind the exchange: a micro-batch may come from few files.
    states = (
        in_buckets(flat, [*names, _SALT])
        .repartition(BUCKET)
        .select(BUCKET, _packed(step.names), *moment)
        .groupBy(BUCKET)
        .transformWithStateInPandas(processor, f"{_FOUND} binary", outputMode="Append", timeMode="EventTime")
    )
    found = _unpacked(states, out)
    if settled is not None:
        found = found.unionByName(settled.select(*out.names))
    second = F.struct(*[F.col(n.name).alias(k) for n, k in zip(nexts, kept.names)])
    found = found.select(
        *names,
        F.struct(*kept.names).alias("first"),
        F.when(F.col(_STATUS) == MATCHED, second).alias("second"),
        _STATUS,
    )

    def rows(name: str) -> Column:
        values = [typed(df, c, F.col(name)[f"kept{i}"]).alias(c) for i, c in enumerate(keep)]
        return F.when(F.col(name).isNotNull(), F.struct(*values))

    return found.select(
        *[F.col(g.name).alias(k) for g, k in zip(groups, keys)],
        rows("first").alias(pattern.first.name),
        rows("second").alias(pattern.second.name),
        "status",
    )


def _packed(names: Sequence[str]) -> Column:
    """A step as one value: Spark hands every value of a row to a state, and takes it back,
    one by one."""

    @F.arrow_udf(T.BinaryType())
    def pack(*columns: pa.Array) -> pa.Array:
        steps = zip(*(c.to_pylist() for c in columns))
        return pa.array([pickle.dumps(s, pickle.HIGHEST_PROTOCOL) for s in steps], pa.binary())

    return pack(*names).alias(_STEP)


def _unpacked(states: DataFrame, out: T.StructType) -> DataFrame:
    """The outcomes in the values that states give back."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out)
        for batch in batches:
            for value in batch[_FOUND]:
                columns = zip(*pickle.loads(value.as_py()))
                arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return states.mapInArrow(unpack, out)


def _settled(
    flat: DataFrame, keys: list[str], kept: T.StructType, longest: int, slot: int
) -> DataFrame:
    """Matches settled within a slot of time, with a status, and the steps that concern
    earlier or later rows."""
    nexts = [T.StructField(f"next{i}", f.dataType) for i, f in enumerate(kept)]
    names = [*keys, _SALT, _AT, _TIE, _FIRST, _SECOND, *kept.names]
    schema = T.StructType([T.StructField(n, flat.schema[n].dataType) for n in names])
    schema = T.StructType([*schema, *nexts, T.StructField(_STATUS, T.StringType())])

    def reduce(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        return settle(rows, starts, keys, kept.names, longest)

    place = F.floor(F.col(_AT) / slot)
    return reduce_stretches(flat.drop("time"), keys, [_AT, _TIE], place, schema, reduce)


def settle(
    rows: pa.Table, starts: np.ndarray, keys: Sequence[str], kept: Sequence[str], longest: int
) -> Iterator[pa.RecordBatch]:
    """Settled matches, with a status and the second step if in time; then, as steps,
    the first second step of each stretch and the first steps after the last."""
    is_first, is_second = (rows.column(c).to_numpy() for c in (_FIRST, _SECOND))
    at, size = rows.column(_AT).to_numpy(), rows.num_rows
    stretch = np.cumsum(starts) - 1
    ends = np.append(np.flatnonzero(starts)[1:], size)[stretch]
    seconds = np.flatnonzero(is_second)
    # The next second step, or a place behind the last row.
    after = np.append(seconds, size)[np.searchsorted(seconds, np.arange(size), side="right")]
    closed = np.flatnonzero(is_first & (after < ends))
    in_time = at[after[closed]] - at[closed] <= longest
    is_head = np.zeros(size, dtype=bool)
    is_head[seconds[np.diff(stretch[seconds], prepend=-1) > 0]] = True
    is_open = is_first & (after >= ends)
    left = np.flatnonzero(is_head | is_open)

    def taken(names: Sequence[str], places: np.ndarray, mask: np.ndarray | None = None) -> list:
        return [rows.column(n).take(pa.array(places, mask=mask)) for n in names]

    nexts = [f"next{i}" for i in range(len(kept))]
    names = [*keys, _SALT, _AT, _TIE, _FIRST, _SECOND, *kept, *nexts, _STATUS]
    if len(closed):
        columns = taken(keys, closed)
        columns += taken([_SALT, _AT, _TIE, _FIRST, _SECOND, *kept], closed)
        columns += taken(kept, after[closed], ~in_time)
        columns += [pa.array(np.where(in_time, MATCHED, TIMED_OUT).tolist())]
        yield from pa.table(columns, names=names).to_batches()
    if len(left):
        columns = taken([*keys, _SALT, _AT, _TIE], left)
        columns += [pa.array(is_open[left]), pa.array(is_head[left])]
        columns += taken(kept, left)
        columns += [pa.nulls(len(left), rows.schema.field(n).type) for n in kept]
        columns += [pa.nulls(len(left), pa.string())]
        yield from pa.table(columns, names=names).to_batches()


class FollowedBy(StatefulProcessor):
    """Steps of the keys of one bucket by slices of time: those waiting for the watermark, and
    open ones.

    Steps are tuples (at, tie, first, second, salt, *keys, *kept), pickled one by one on the way in,
    in chunks while they are held, and as outcomes (*keys, *kept, *next, status) on the way out. What one micro-batch adds to a
    slice is a chunk, an entry of a map of its own, so adding never reads what is there. A small
    index lists, for each slice, its chunks, whether it has second steps and whether it is open:
    then all its steps are first steps that have been taken and no second step has closed. One
    timer says that the watermark has passed the end of a slice or that its open steps have timed
    out; then all slices that are due are taken at once. Slices after the last second step become
    open without being read.

    Timers are at ends of slices. The open steps of a slice are given up only at the first
    end by which all that could close them has been taken.
    """

    def __init__(self, step: T.StructType, within: int, longest: int, buffered: bool, wide: int):
        self.buffered, self.within, self.longest, self.wide = buffered, within, longest, wide
        self.kept = len(step) - sum(f.startswith("kept") for f in step.names)
        self.unmatched = (None,) * (len(step) - self.kept)
        self.place = T.StructType([T.StructField("chunk", T.LongType())])
        self.chunk = T.StructType([T.StructField("steps", T.BinaryType())])
        entry = T.StructType(
            [
                T.StructField("slice", T.LongType()),
                T.StructField("open", T.BooleanType()),
                T.StructField("second", T.BooleanType()),
                T.StructField("chunks", T.ArrayType(T.LongType())),
            ]
        )
        self.listed = T.StructType(
            [
                T.StructField("next", T.LongType()),
                T.StructField("timer", T.LongType()),
                T.StructField("slices", T.ArrayType(entry)),
            ]
        )

    def init(self, handle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", self.place, self.chunk)
        self.index = handle.getValueState("index", self.listed)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        steps = [pickle.loads(step) for part in rows for step in part[_STEP]]
        index = _Index(self.index.get())
        if self.buffered:
            self._add(index, steps, False)
        elif any(s[3] for s in steps):
            # Every open step comes before them or among them.
            steps += self._drop(index, [k for k in index.slices if k[1]])
            still_open = []
            yield from _together(self._take(steps, still_open))
            self._add(index, still_open, True)
        else:
            self._add(index, steps, True)
        self._keep(index)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        index = _Index(self.index.get())
        if index.timer == expiredTimerInfo.getExpiryTimeInMs():
            index.timer = None
        due = sorted(k for k in index.slices if not k[1] and self._end(k[0]) <= now)
        closing = [k[0] for k in due if index.slices[k][0]]
        if closing:
            # Open steps of later slices cannot be closed by steps of these.
            taken = [k for k in index.slices if k[0] <= closing[-1]]
            still_open = []
            yield from _together(self._take(self._drop(index, taken), still_open))
            self._add(index, still_open, True)
        for ready in due:
            if ready in index.slices:
                self._open(index, ready[0], index.slices.pop(ready)[1])
        late = sorted(k for k in index.slices if k[1] and self._gone(k[0]) <= now)
        yield from _together(map(self._out, self._drop(index, late)))
        self._keep(index)

    def close(self) -> None:
        pass

    def _end(self, place: int) -> int:
        return (place + 1) * self.wide

    def _gone(self, place: int) -> int:
        """The end of a slice by which open steps of this one have timed out."""
        return -(-(self._end(place) + self.within) // self.wide) * self.wide

    def _add(self, index: _Index, steps: list, is_open: bool) -> None:
        """Put steps into their slices, a chunk to each."""
        by_slice: dict[int, list] = {}
        for step in steps:
            by_slice.setdefault(step[0] // self.wide, []).append(step)
        for place, own in by_slice.items():
            chunk, index.next = index.next, index.next + 1
            self.chunks.updateValue((chunk,), (pickle.dumps(own, pickle.HIGHEST_PROTOCOL),))
            if is_open:
                self._open(index, place, [chunk])
            else:
                second, chunks = index.slices.get((place, False), (False, []))
                second = second or any(s[3] for s in own)
                index.slices[place, False] = second, [*chunks, chunk]

    def _open(self, index: _Index, place: int, chunks: list[int]) -> None:
        _, own = index.slices.get((place, True), (False, []))
        index.slices[place, True] = False, [*own, *chunks]

    def _drop(self, index: _Index, places: list[tuple[int, bool]]) -> list[tuple]:
        """Take slices out of the state: their steps."""
        steps = []
        for place in places:
            for chunk in index.slices.pop(place)[1]:
                steps += pickle.loads(self.chunks.getValue((chunk,))[0])
                self.chunks.removeKey((chunk,))
        return steps

    def _take(self, steps: list, still_open: list) -> Iterator[tuple]:
        """Let steps, in time order, close open first steps of their key or open new ones;
        ``still_open`` gets those that are left."""
        waiting: dict[tuple, list] = {}
        for step in sorted(steps, key=_in_order):
            own = identity(step[4 : self.kept])
            if step[3]:
                for first in waiting.pop(own, ()):
                    yield self._out(first, step)
            if step[2]:
                waiting.setdefault(own, []).append(step)
        # A step held as open is a first step, whatever else it was.
        still_open += [(*s[:3], False, *s[4:]) for own in waiting.values() for s in own]

    def _out(self, first: tuple, second: tuple | None = None) -> tuple:
        matched = second is not None and second[0] - first[0] <= self.longest
        after = second[self.kept :] if matched else self.unmatched
        return *first[5:], *after, MATCHED if matched else TIMED_OUT

    def _keep(self, index: _Index) -> None:
        """Write the index, with a timer for the slice that is due next."""
        ends = [self._gone(place) if is_open else self._end(place) for place, is_open in index.slices]
        wake = -(-min(ends) // 1000) if ends else None
        if wake != index.timer:
            if index.timer is not None:
                self.handle.deleteTimer(index.timer)
            if wake is not None:
                self.handle.registerTimer(wake)
        if index.slices:
            entries = [(p, o, s, c) for (p, o), (s, c) in index.slices.items()]
            self.index.update((index.next, wake, entries))
        else:
            self.index.clear()


class _Index:
    """Chunks by (slice, open), whether there are second steps among them, and the timer."""

    def __init__(self, kept: tuple | None):
        self.next, self.timer, entries = kept if kept is not None else (0, None, [])
        self.slices = {(e[0], e[1]): (e[2], list(e[3])) for e in entries}


def _together(found: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    """Outcomes, many to a row."""
    for part in batched(found, _TOGETHER):
        yield pd.DataFrame({_FOUND: [pickle.dumps(part, pickle.HIGHEST_PROTOCOL)]})


def _in_order(step: tuple) -> tuple:
    # A null tie comes first, as Spark sorts it.
    return step[0], step[1] is not None, step[1]
