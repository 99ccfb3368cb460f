"""User-defined finite-state machines over the events of a key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sequon.model import counted_keys
from sequon.plans.segments import HOT, SEGMENT, SEGMENT_ROWS, Segments, plan_segments

_SYMBOL, _MOVES, _BEFORE, _GROUP = "__symbol", "__moves", "__before", "__group"
_TIME, _BEGINS, _ENDS = "__time", "__begins", "__ends"


@dataclass(frozen=True)
class Rule:
    """In ``state``, an event of type ``event`` leads to ``target``."""

    state: str
    event: str
    target: str

    def __post_init__(self):
        if None in (self.state, self.event, self.target):
            raise ValueError("a rule needs a state, an event type and a target")


@dataclass(frozen=True)
class Machine:
    """A transition table.

    The first rule that fits applies; an event no rule fits leads to ``initial``.
    A rule to ``matched`` reports the event and leaves the state as it was, a rule
    to ``ended`` starts over. Neither is ever a state of its own.
    """

    initial: str
    rules: tuple[Rule, ...]
    matched: str = "Matched"
    ended: str = "Terminal"
    states: tuple[str, ...] = field(init=False)
    events: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        rules = tuple(self.rules)
        object.__setattr__(self, "rules", rules)
        if not self.initial or self.initial in (self.matched, self.ended):
            raise ValueError("the initial state must be an ordinary state")
        if any(r.state in (self.matched, self.ended) for r in rules):
            raise ValueError("the matched and ended states cannot have rules")
        named = [self.initial, *[r.state for r in rules], *[r.target for r in rules]]
        states = [s for s in dict.fromkeys(named) if s not in (self.matched, self.ended)]
        object.__setattr__(self, "states", tuple(states))
        object.__setattr__(self, "events", tuple(dict.fromkeys(r.event for r in rules)))

    @property
    def other(self) -> int:
        """Symbol shared by null and all event types without a rule."""
        return len(self.events)

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Next state and whether to report, by symbol and state."""
        number = {s: i for i, s in enumerate(self.states)}
        symbol = {e: i for i, e in enumerate(self.events)}
        shape = (len(self.events) + 1, len(self.states))
        # The narrowest signed integers that hold all states.
        moves = np.full(shape, number[self.initial], np.min_scalar_type(-len(self.states)))
        reports = np.zeros(shape, dtype=bool)
        for rule in reversed(self.rules):
            cell = symbol[rule.event], number[rule.state]
            reports[cell] = rule.target == self.matched
            if rule.target == self.matched:
                moves[cell] = number[rule.state]
            elif rule.target == self.ended:
                moves[cell] = number[self.initial]
            else:
                moves[cell] = number[rule.target]
        return moves, reports

    def expiring_table(self) -> tuple[np.ndarray, np.ndarray]:
        """The table with each symbol a second time, for events that come after their key's
        state has expired: whatever the state was, they meet the initial one."""
        return tuple(
            np.concatenate([part, np.repeat(part[:, :1], len(self.states), axis=1)])
            for part in self.table()
        )

    def symbol(self, event: Column) -> Column:
        if not self.events:
            return F.lit(self.other)
        codes = F.create_map(*[F.lit(v) for i, e in enumerate(self.events) for v in (e, i)])
        return F.coalesce(F.try_element_at(codes, event), F.lit(self.other))


def run_alert_machine(event: str, other: str, n: int = 3) -> Machine:
    """Report every event that is at least the ``n``-th of its type in a row."""
    names = ["Initial", *[f"S{i}" for i in range(1, n)]]
    rules = []
    for state, target in zip(names, [*names[1:], "Matched"]):
        rules += [Rule(state, event, target), Rule(state, other, "Terminal")]
    return Machine("Initial", tuple(rules))


def run_machine(
    df: DataFrame,
    machine: Machine,
    keys: Sequence[str],
    order: Sequence[str],
    event: Column,
    keep: Sequence[str] | None = None,
    segments: Segments | None = None,
    segment_rows: int = SEGMENT_ROWS,
    expire: timedelta | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """Add ``state``, the state after each row, and ``matched``, whether it is reported.

    ``order`` must order the rows of a key completely. Keys and the ``keep`` columns,
    all by default, pass through Arrow, at a cost per column.

    With ``expire`` the first order column is a time, and a row that comes so much or more
    after the one before it finds its key in the initial state. Rows without a time are then
    left out, as rows without a key always are; ``seen`` counts them.
    """
    segments = segments or plan_segments(df, keys, order, segment_rows)
    columns = df.columns if keep is None else list(dict.fromkeys([*keys, *keep]))
    moves, reports = machine.table() if expire is None else machine.expiring_table()
    own = df
    if seen is not None:
        own = counted_keys(df, keys, seen, None if expire is None else order[0])
    slim = own.withColumn(_SYMBOL, machine.symbol(event)).select(
        *dict.fromkeys([*columns, *order]), _SYMBOL
    )
    placed = segments.assign(slim)
    if expire is not None:
        placed = _renewed(placed.where(F.col(order[0]).isNotNull()), segments, machine, expire)
    passed = list(dict.fromkeys([*segments.group, *columns, _SYMBOL]))
    before = F.get(_BEFORE, F.lit(0))
    if not segments.split:
        traced = _traced(placed, segments.group, segments.order, passed, moves, entry=0)
    else:
        traced = _traced(placed, segments.group, segments.order, passed, moves)
        entries = _entries(placed.where(HOT), segments, moves, expire)
        traced = traced.join(F.broadcast(entries), segments.group, "left")
        before = F.get(_BEFORE, F.coalesce(F.col("__entry").cast("int"), F.lit(0)))
    cell = F.col(_SYMBOL) * len(machine.states) + before
    after = F.get(F.lit(moves.ravel().tolist()), cell)
    return traced.select(
        *columns,
        F.get(F.lit(list(machine.states)), after).alias("state"),
        F.get(F.lit(reports.ravel().tolist()), cell).alias("matched"),
    )


def machine_alerts(df: DataFrame, machine: Machine, *args, **kwargs) -> DataFrame:
    """Rows a machine reports; arguments as for :func:`run_machine`."""
    return run_machine(df, machine, *args, **kwargs).where("matched").drop("matched")


def _renewed(
    placed: DataFrame, segments: Segments, machine: Machine, expire: timedelta
) -> DataFrame:
    """Give rows that find an expired state their second symbol, within each group.

    The window asks for the exchange and sort that the trace asks for, so both share them.
    """
    rows = W.partitionBy(*segments.group).orderBy(*segments.order)
    timed = placed.withColumn(_TIME, F.unix_micros(F.col(segments.order[0]).cast("timestamp")))
    gap = F.col(_TIME) - F.lag(_TIME).over(rows)
    second = F.when(gap >= expire // timedelta(microseconds=1), machine.other + 1).otherwise(0)
    return timed.withColumn(_SYMBOL, F.col(_SYMBOL) + second)


def _traced(
    placed: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    passed: Sequence[str],
    moves: np.ndarray,
    entry: int | None = None,
) -> DataFrame:
    """Add to the ``passed`` columns the state before each row, for each state its group
    may be entered in.

    With a known ``entry`` the list has that one element.
    """
    rows, marks = _in_order(placed, group, order, passed)
    fields = placed.select(*passed).schema
    schema = T.StructType([*fields, T.StructField(_BEFORE, T.ArrayType(state_type(moves)))])
    names = schema.names

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.arange(moves.shape[1], dtype=moves.dtype)
        for batch, starts in _with_starts(batches, marks):
            before, last = states_before(_steps(batch, moves), starts, last, entry)
            columns = [*batch.select(names[:-1]).columns, lists(before)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(trace, schema)


def _entries(
    hot: DataFrame, segments: Segments, moves: np.ndarray, expire: timedelta | None = None
) -> DataFrame:
    """State each segment of a hot key is entered in.

    A segment is a function from the state it is entered in to the state it is left
    in, so the segments of a key are traced like events. One that begins after the state
    has expired is entered in the initial state, and leads from any state to the same.
    """
    rows, marks = _in_order(hot, segments.group, segments.order, [*segments.group, _SYMBOL])
    fields = hot.select(*segments.group).schema
    schema = T.StructType([*fields, T.StructField(_MOVES, T.ArrayType(state_type(moves)))])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, open_group = np.arange(moves.shape[1], dtype=moves.dtype), None
        for batch, starts in _with_starts(batches, marks):
            ended = last
            before, last = states_before(_steps(batch, moves), starts, last, None)
            groups = batch.select(schema.names[:-1])
            # A group is known to be complete where the next one starts.
            if starts[0] and open_group is not None:
                yield _row(open_group, ended)
            ends = np.flatnonzero(starts[1:])
            if len(ends):
                step = _steps(batch, moves)[ends]
                after = np.take_along_axis(step, before[ends].astype(np.intp), axis=1)
                columns = [*groups.take(pa.array(ends)).columns, lists(after)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
            open_group = groups.slice(batch.num_rows - 1)
        if open_group is not None:
            yield _row(open_group, last)

    def _row(group: pa.RecordBatch, function: np.ndarray) -> pa.RecordBatch:
        columns = [*group.columns, lists(function[None, :])]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    whole = rows.mapInArrow(reduce, schema)
    if expire is None:
        entered = _traced(whole, segments.keys, [SEGMENT], whole.columns, moves, entry=0)
        return entered.select(*segments.group, F.get(_BEFORE, F.lit(0)).alias("__entry"))
    times = hot.groupBy(*segments.group).agg(F.min(_TIME).alias(_BEGINS), F.max(_TIME).alias(_ENDS))
    earlier = W.partitionBy(*segments.keys).orderBy(SEGMENT)
    gap = F.col(_BEGINS) - F.lag(_ENDS).over(earlier)
    expired = F.coalesce(gap >= expire // timedelta(microseconds=1), F.lit(False))
    times = times.select(*segments.group, expired.alias("__expired"))
    same = F.array_repeat(F.get(_MOVES, F.lit(0)), moves.shape[1])
    whole = whole.join(times, segments.group).withColumn(
        _MOVES, F.when(F.col("__expired"), same).otherwise(F.col(_MOVES))
    )
    entered = _traced(whole, segments.keys, [SEGMENT], whole.columns, moves, entry=0)
    entry = F.when(F.col("__expired"), F.lit(0)).otherwise(F.get(_BEFORE, F.lit(0)))
    return entered.select(*segments.group, entry.alias("__entry"))


def _in_order(
    placed: DataFrame, group: Sequence[str], order: Sequence[str], passed: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """``passed`` columns with every group in one partition, in order, and the names of
    the columns that tell groups apart.

    A sort without a window on top costs a fraction of one with it. Columns that only
    order the rows are not passed on.
    """
    marks, texts = [], {}
    for i, name in enumerate(group):
        kind = placed.schema[name].dataType
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            raise TypeError(f"key column {name} must not be nested")
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            # As text, what is not a number equals itself; adding zero drops its sign.
            texts[f"{_GROUP}{i}"] = (F.col(name) + 0.0).cast("string")
            name = f"{_GROUP}{i}"
        marks.append(name)
    rows = placed.repartition(*group).sortWithinPartitions(*group, *order)
    return rows.select(*passed, *[text.alias(n) for n, text in texts.items()]), marks


def _with_starts(
    batches: Iterator[pa.RecordBatch], marks: Sequence[str]
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Filled batches, with true at the first row of each group."""
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        groups = batch.select(marks)
        starts = np.zeros(batch.num_rows, dtype=bool)
        starts[0] = last is None or not groups.slice(0, 1).equals(last)
        for column in groups.columns:
            starts[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        last = groups.slice(batch.num_rows - 1)
        yield batch, starts


def _steps(batch: pa.RecordBatch, moves: np.ndarray) -> np.ndarray:
    """The function each row stands for."""
    if _MOVES in batch.schema.names:
        return batch.column(_MOVES).flatten().to_numpy().reshape(batch.num_rows, -1)
    return moves[batch.column(_SYMBOL).to_numpy()]


def lists(values: np.ndarray) -> pa.ListArray:
    """Rows of an array as Arrow lists."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def state_type(moves: np.ndarray) -> T.DataType:
    """Spark's type for the numbers of states in ``moves``."""
    return {1: T.ByteType(), 2: T.ShortType(), 4: T.IntegerType()}[moves.dtype.itemsize]


def states_before(
    step: np.ndarray, starts: np.ndarray, carried: np.ndarray, entry: int | None
) -> tuple[np.ndarray, np.ndarray]:
    """State before each row of a batch, as functions of the state its group is entered in.

    ``step`` holds a function (an array indexed by state) per row, ``starts`` marks the
    first row of each group and ``carried`` is the function of the rows the first group
    had in earlier batches. Composition is associative, so all prefixes are formed by
    doubling; a row is finished once its prefix reaches the start of the group or no
    longer depends on the state it began in.
    """
    states = step.shape[1]
    identity = np.arange(states, dtype=step.dtype)
    # Row 0 stands for all that came before the batch.
    done = np.concatenate(([carried], step))
    begins = np.concatenate(([True], starts))
    if entry is not None:
        fixed = np.full(states, entry, dtype=step.dtype)
        done[begins] = np.take_along_axis(done[begins], fixed[None, :].astype(np.intp), axis=1)
        if starts[0]:
            done[0] = fixed
    finished = begins | (done == done[:, :1]).all(axis=1)
    reach = 1
    left = np.flatnonzero(~finished)
    while len(left):
        back = left - reach
        joined = np.take_along_axis(done[left], done[back], axis=1)
        closed = finished[back] | (joined == joined[:, :1]).all(axis=1)
        done[left] = joined
        finished[left] = closed
        left = left[~closed]
        reach *= 2
    before = done[:-1].copy()
    before[starts] = identity if entry is None else entry
    if entry is not None:
        before = before[:, :1]
    return before, done[-1]
