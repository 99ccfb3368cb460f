"""Finite-state machines over a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from sequon.model import counted_keys, has_key
from sequon.operators.machine import Machine, lists, state_type, states_before
from sequon.streaming.folders import keep_state_on_disk
from sequon.streaming.kept import BUCKET, TIMES, identity, in_buckets, plain, typed
from sequon.streaming.stretches import reduce_stretches

#: Slots of a time and of a whole number, unless told otherwise.
SLOT_TIME, SLOT_WIDTH = timedelta(minutes=10), 10_000
_SYMBOL, _AT, _WHEN, _MOVES, _LAST = "symbol", "at", "when", "moves", "last"
_MICRO = timedelta(microseconds=1)


def machine_stream(
    df: DataFrame,
    machine: Machine,
    keys: Sequence[str],
    order: Sequence[str],
    event: Column,
    keep: Sequence[str] | None = None,
    ttl_ms: int | None = None,
    slot: timedelta | int | None = None,
    seen: str | None = None,
    expire: timedelta | None = None,
    delay: str = "1 millisecond",
) -> DataFrame:
    """Keys and ``keep`` columns of the rows a machine reports.

    Within a micro-batch the rows of a key are taken in ``order``; a row that arrives
    in a later micro-batch comes later. The state of a key is kept for ever, or for
    ``ttl_ms`` after its last row; with a limit the query keeps looking for expired
    state, so it does not end by itself even under an available-now trigger.

    Within a slot of its first order column, the rows of a key are reduced to one function
    from state to state and the rows that some state would report. Rows that every state would
    report go straight to the output; only the others and the function reach the task that
    holds the state of the key, which it shares with others (``streaming.kept``). ``slot`` is how wide slots are: ten minutes of a time,
    10,000 of a whole number; a column of another type is one slot. Rows without a key are
    left out; under the name ``seen`` the progress of the query counts them.
    """
    if expire is not None and ttl_ms is not None:
        raise ValueError("state expires in event time or in processing time, not in both")
    keep_state_on_disk(df.sparkSession)
    keep = list(keep) if keep is not None else [c for c in df.columns if c not in keys]
    key_names = [f"key{i}" for i in range(len(keys))]
    order_names = [f"order{i}" for i in range(len(order))]
    kept_names = [f"kept{i}" for i in range(len(keep))]
    ts = None
    if expire is not None:
        ts, df = order[0], df.withWatermark(order[0], delay)
    own = df.where(has_key(keys)) if seen is None else counted_keys(df, keys, seen, ts)
    if ts is not None:
        # Rows without a key move time on as well, so the watermark comes first.
        own = own.where(F.col(ts).isNotNull())
    flat = own.select(
        *[F.col(c).alias(n) for c, n in zip(keys, key_names)],
        *[plain(df, c).alias(n) for c, n in zip(order, order_names)],
        *[plain(df, c).alias(n) for c, n in zip(keep, kept_names)],
        machine.symbol(event).alias(_SYMBOL),
    )
    moves, reports = machine.table() if expire is None else machine.expiring_table()
    longest = None if expire is None else expire // _MICRO
    fields = {f.name: T.StructField(f.name, f.dataType) for f in flat.schema}
    pieces = T.StructType(
        [
            *[fields[n] for n in (*key_names, *order_names, *kept_names)],
            T.StructField(_AT, T.LongType()),
            T.StructField(_WHEN, T.ArrayType(T.BooleanType())),
            T.StructField(_MOVES, T.ArrayType(state_type(moves))),
            *([] if expire is None else [T.StructField(_LAST, T.LongType())]),
        ]
    )

    def reduce(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        names = key_names, order_names, kept_names
        return reduced(rows, starts, moves, reports, *names, longest)

    place = _place(df, order[0], order_names[0], slot)
    stretches = reduce_stretches(flat, key_names, order_names, place, pieces, reduce)
    out = T.StructType([fields[n] for n in (*key_names, *kept_names)])
    if longest is not None:
        processor = ExpiringState(pieces, out, longest, state_type(moves))
        mode = "EventTime"
    else:
        processor = KeptState(pieces, out, ttl_ms, state_type(moves))
        mode = "None" if ttl_ms is None else "ProcessingTime"
    # Both parts read the same exchange: stretches are the same whoever asks.
    alerts = (
        in_buckets(stretches.where(~_certain()), key_names)
        .groupBy(BUCKET)
        .transformWithState(processor, out, outputMode="Append", timeMode=mode)
        .unionByName(stretches.where(_certain()).select(*out.names))
    )
    return alerts.select(
        *[F.col(n).alias(c) for c, n in zip(keys, key_names)],
        *[typed(df, c, F.col(n)).alias(c) for c, n in zip(keep, kept_names)],
    )


def _certain() -> Column:
    """Whether a row of a stretch is reported whatever the state before the stretch."""
    return F.coalesce(F.forall(F.col(_WHEN), lambda w: w), F.lit(False))


def _place(df: DataFrame, column: str, name: str, slot: timedelta | int | None) -> Column:
    """The slot of a row; times are held as whole microseconds."""
    kind = df.schema[column].dataType
    if isinstance(kind, TIMES):
        width = (slot or SLOT_TIME) // timedelta(microseconds=1)
    elif isinstance(kind, T.IntegralType):
        width = slot or SLOT_WIDTH
    else:
        return F.lit(0)
    return F.floor(F.col(name) / width)


def reduced(
    rows: pa.Table,
    starts: np.ndarray,
    moves: np.ndarray,
    reports: np.ndarray,
    keys: Sequence[str],
    order: Sequence[str],
    kept: Sequence[str],
    expire: int | None = None,
) -> Iterator[pa.RecordBatch]:
    """Stretches of keys, from sorted rows.

    A stretch gives a row per event that at least one entry state would report, with
    ``when`` true for those states, then a row with its ``moves``. All carry the
    order of the first event of the stretch. With ``expire``, in microseconds, the row of the
    moves also has the time of the last event, and ``moves`` is an expiring table.
    """
    symbol = rows.column(_SYMBOL).to_numpy()
    if expire is not None:
        at = rows.column(order[0]).to_numpy()
        late = ~starts & (np.diff(at, prepend=at[:1]) >= expire)
        symbol = symbol + late * (len(moves) // 2)
    step, states = moves[symbol], moves.shape[1]
    before, _ = states_before(step, starts, np.arange(states, dtype=moves.dtype), None)
    when = np.take_along_axis(reports[symbol], before.astype(np.intp), axis=1)
    first = np.flatnonzero(starts)
    last = np.append(first[1:], rows.num_rows) - 1
    reported = np.flatnonzero(when.any(axis=1))
    stretch = np.cumsum(starts)[reported] - 1

    def taken(names: Sequence[str], at: np.ndarray) -> list:
        return [rows.column(n).take(pa.array(at)) for n in names]

    names = [*keys, *order, *kept, _AT, _WHEN, _MOVES, *([] if expire is None else [_LAST])]
    if len(reported):
        columns = [*taken(keys, reported), *taken(order, first[stretch]), *taken(kept, reported)]
        none = pa.nulls(len(reported), pa.list_(pa.from_numpy_dtype(moves.dtype)))
        columns += [pa.array(reported), lists(when[reported]), none]
        if expire is not None:
            columns.append(pa.nulls(len(reported), pa.int64()))
        yield from pa.table(columns, names=names).to_batches()
    after = np.take_along_axis(step[last], before[last].astype(np.intp), axis=1)
    columns = [*taken(keys, first), *taken(order, first)]
    columns += [pa.nulls(len(first), rows.schema.field(n).type) for n in kept]
    columns += [pa.array(last), pa.nulls(len(first), pa.list_(pa.bool_())), lists(after)]
    if expire is not None:
        columns.append(pa.array(at[last]))
    yield from pa.table(columns, names=names).to_batches()


class KeptState(StatefulProcessor):
    """Runs the stretches of the keys of one bucket through their states.

    The initial state is the same as none, so it is not kept. A state has a number besides: in
    ``KeptState`` the processing time, in milliseconds, at which it expires, if it does.
    """

    def __init__(self, pieces: T.StructType, out: T.StructType, ttl_ms: int | None, kind: T.DataType):
        self.fields, self.result, self.ttl_ms = pieces.names, Row(*out.names), ttl_ms
        keys = [f for f in out if f.name.startswith("key")]
        self.keys, self.kept = slice(0, len(keys)), self._span("kept")
        self.order = self._span("order")
        self.at, self.when, self.moves = (pieces.names.index(n) for n in (_AT, _WHEN, _MOVES))
        extra = ("state", kind), ("number", T.LongType())
        self.entry = T.StructType([*keys, *[T.StructField(*f) for f in extra]])

    def _span(self, prefix: str) -> slice:
        """Where the fields of that name are; they are next to one another."""
        own = [i for i, f in enumerate(self.fields) if f.startswith(prefix)]
        return slice(own[0], own[-1] + 1) if own else slice(0, 0)

    def init(self, handle) -> None:
        self.handle = handle
        fields = ("timer", T.LongType()), ("entries", T.ArrayType(self.entry))
        kind = T.StructType([T.StructField(*f) for f in fields])
        self.state = handle.getValueState("state", kind, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        timer, held = self._held()
        until = None
        if self.ttl_ms is not None:
            now = timerValues.getCurrentProcessingTimeInMs()
            held = {own: e for own, e in held.items() if e[-1] > now}
            until = now + self.ttl_ms
        for piece in self._in_order(rows):
            own = identity(piece[self.keys])
            entry = held.get(own)
            state = entry[-2] if entry is not None else 0
            if piece[self.moves] is not None:
                held[own] = (*piece[self.keys], piece[self.moves][state], until)
            elif piece[self.when][state]:
                yield self.result(*piece[self.keys], *piece[self.kept])
        self._keep(held, timer)

    def _held(self) -> tuple[int | None, dict[tuple, tuple]]:
        """The timer, and entries (*keys, state, number) by key."""
        timer, entries = self.state.get() or (None, [])
        return timer, {identity(tuple(e)[self.keys]): tuple(e) for e in entries}

    def _keep(self, held: dict[tuple, tuple], timer: int | None) -> None:
        entries = [e for e in held.values() if e[-2]]
        wake = self._wake(entries)
        if wake != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if wake is not None:
                self.handle.registerTimer(wake)
        if entries:
            self.state.update((wake, entries))
        else:
            self.state.clear()

    def _wake(self, entries: list[tuple]) -> int | None:
        return None

    def _in_order(self, rows) -> list[tuple]:
        """A stretch keeps its reported rows in front of its moves; nulls come first, as Spark
        sorts them."""
        pieces, picked = [], None
        for row in rows:
            if picked is None:
                names = row.__fields__
                picked = itemgetter(*[names.index(f) for f in self.fields])
            pieces.append(picked(tuple(row)))
        order, moves, at = self.order, self.moves, self.at
        pieces.sort(
            key=lambda p: (
                *[(v is not None, v) for v in p[order]],
                p[moves] is not None,
                p[at],
            )
        )
        return pieces

    def close(self) -> None:
        pass


class ExpiringState(KeptState):
    """States that end ``expire`` microseconds of event time after the latest row of their key;
    the number of a state is the time of that row.

    A bucket that has states has one timer, for the one that ends first.
    """

    def __init__(self, pieces: T.StructType, out: T.StructType, expire: int, kind: T.DataType):
        super().__init__(pieces, out, None, kind)
        self.expire, self.last = expire, pieces.names.index(_LAST)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        timer, held = self._held()
        for own, entry in held.items():
            if entry[-1] + self.expire <= now:
                held[own] = (*entry[:-2], 0, entry[-1])
        for piece in self._in_order(rows):
            own = identity(piece[self.keys])
            entry = held.get(own)
            state, last = entry[-2:] if entry is not None else (0, None)
            if last is not None and piece[self.order][0] - last >= self.expire:
                state = 0
            if piece[self.moves] is not None:
                last = piece[self.last] if last is None else max(last, piece[self.last])
                held[own] = (*piece[self.keys], piece[self.moves][state], last)
            elif piece[self.when][state]:
                yield self.result(*piece[self.keys], *piece[self.kept])
        self._keep(held, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        timer, held = self._held()
        if timer == expiredTimerInfo.getExpiryTimeInMs():
            timer = None
        self._keep({own: e for own, e in held.items() if e[-1] + self.expire > now}, timer)
        return iter(())

    def _wake(self, entries: list[tuple]) -> int | None:
        ends = min((e[-1] for e in entries), default=None)
        return None if ends is None else -(-(ends + self.expire) // 1000)
