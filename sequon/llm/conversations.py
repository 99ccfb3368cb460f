"""Conversations repaired: faults counted, roles put into a legal order by the cheapest edits.

Rows of a conversation are taken by turn (nulls first), then role, then text. A row is blank
without a character but ASCII white space; a duplicate if its role and text came earlier; cut
off if its last such character is none of ``.!?``. Only its first fault counts.

A conversation of at most about ``segment_rows`` rows is read by one task, in order, and
holds its texts just until it is written out. A longer one is cut into segments: each is
searched for the cost of every way through it, those few numbers say which states its cheapest
edits pass between segments, and then each segment is edited on its own. Both give the same
edits.

Nulls count as one space, so a null text is blank, a null role is none of the three, and a
null conversation is one like any other. Repeated rows are duplicates. Very long texts are
read whole. A table without rows has no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from math import inf

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sequon.llm.common import crc32_text, kept
from sequon.llm.edits import (
    ENDS,
    GONE,
    START,
    STATES,
    carried_out,
    cheapest,
    illegal,
)
from sequon.plans.segments import HOT, SEGMENT, plan_segments

#: Rows of one conversation that one task may hold.
SEGMENT_ROWS = 2_000
_SPACE = " \t\n\x0b\x0c\r"
_NONE = " "
_KEY, _TURN, _ROLE, _TEXT, _MARK = "key", "turn", "role", "text", "mark"
_SORT = [_KEY, _TURN, _ROLE, _TEXT]
#: Rows and characters that a task gathers before it writes them out.
_OUT_ROWS, _OUT_CHARS = 512, 4_000_000

_TURNS = T.ArrayType(T.StructType().add("role", "string").add("text", "string"))
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_REPORT = T.StructType([T.StructField(n, T.LongType()) for n in ("gaps", *_COUNTS, "cost")])
_REPORT = T.StructType([*_REPORT, T.StructField("audit", T.StringType())])
_PARTS = T.StructType(
    [
        T.StructField(_KEY, T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("parts", T.IntegerType()),
        T.StructField("report", _REPORT),
        T.StructField("turns", _TURNS),
    ]
)
_PARTS_SQL = _PARTS.simpleString().removeprefix("struct<")[:-1]


def key(value: str) -> Column:
    """What names a conversation: its id as text, null as one space."""
    return F.coalesce(F.col(value).cast("string"), F.lit(_NONE))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows as a rule of their CRC-32 damages them; for trials of the repair.

    Of twenty values of crc32(``conv_id:turn``), 0 drops the row, 1 empties its text, 2 takes
    its stops away, 3 repeats it and 4 has the user say it.
    """
    place = F.concat(key("conv_id"), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(_NONE)))
    text, role = (F.coalesce(c, F.lit(_NONE)) for c in ("text", "role"))
    marked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), place.alias("place"))
    marked = marked.withColumn("rule", crc32_text("place") % 20).where("rule != 0")
    rule = F.col("rule")
    return marked.select(
        "conv_id",
        "turn",
        F.when(rule == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(rule == 1, "")
        .when(rule == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(rule == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def repaired(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """(key, part, parts, report, turns): the repaired turns of each conversation.

    ``rows`` has conv_id, turn, role and text; other columns are left out. A long
    conversation has several parts, in order; its report stands with part 0. A report has
    the gaps in the turns, the rows of each fault, illegal neighbours, and the cheapest
    edits with their cost.
    """
    own = rows.select(
        key("conv_id").alias(_KEY),
        F.col("turn").cast("long").alias(_TURN),
        *(F.coalesce(c, F.lit(_NONE)).alias(c) for c in (_ROLE, _TEXT)),
    )
    # A mark orders rows as they are sorted, so far as it goes; it need not be as long as
    # the text, since rows of one mark may share a segment.
    marked = own.withColumn(_MARK, F.substring(_TEXT, 1, 64))
    segments = plan_segments(marked, [_KEY], [_TURN, _ROLE, _MARK], segment_rows)
    placed = segments.assign(marked).drop(_MARK)
    if not segments.split:
        return _whole(placed)
    # Hot rows are read several times; without the others each reading is short.
    hot = kept(placed.where(HOT).drop(HOT))
    return _whole(placed.where(~F.col(HOT)).drop(HOT, SEGMENT)).unionByName(_split(hot))


def _whole(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _written(_repairs(_groups(batches, (_KEY,))))

    dealt = rows.repartition(_KEY).sortWithinPartitions(*_SORT)
    return dealt.mapInArrow(run, _PARTS_SQL)


def _groups(
    batches: Iterable[pa.RecordBatch], names: Sequence[str]
) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of each group in turn, as they come; a group may span batches."""
    one, own = _rows(batches), None
    row = next(one, None)
    while row is not None:
        group = tuple(row[n] for n in names)

        def members(group: tuple = group) -> Iterator[dict]:
            nonlocal row
            while row is not None and tuple(row[n] for n in names) == group:
                yield row
                row = next(one, None)

        own = members()
        yield group, own
        for _ in own:
            pass


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            yield from batch.slice(begin, 256).to_pylist()


def _kind(text: str) -> str:
    """``b`` for blank, ``t`` for cut off, else a blank."""
    said = text.rstrip(_SPACE)
    return "b" if not said else " " if said[-1] in ".!?" else "t"


def _digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


class _Facts:
    """What a run of rows says of its conversation; runs that follow one another add up."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.first, self.last = 0, None, None
        self.initials = ""
        self.codes: list[str] = []

    def add(self, turn: int | None, role: str, kind: str) -> None:
        """``kind`` may also be ``d``, a duplicate."""
        initial = role[:1]
        if self.codes:
            self.illegal += illegal_pair(self.initials[-1], initial)
        # The first and the last initial.
        self.initials = (self.initials[:1] or initial or "?") + (initial or "?")
        if turn is not None:
            self.turns += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn
        self.blank += kind == "b"
        self.duplicate += kind == "d"
        self.truncated += kind == "t"
        code = initial if initial in ("s", "u", "a") else "o"
        self.codes.append(GONE if kind in "bd" else code.upper() if kind == "t" else code)

    def report(self, cost: int, audit: str) -> dict:
        return dict(
            gaps=self.last - self.first + 1 - self.turns if self.turns else 0,
            blank=self.blank,
            duplicate=self.duplicate,
            truncated=self.truncated,
            illegal=self.illegal,
            cost=cost,
            audit=audit,
        )


def illegal_pair(left: str, right: str) -> int:
    return illegal(left + (right or "?"))


def _repairs(groups: Iterable[tuple[tuple, Iterator[dict]]]) -> Iterator[dict]:
    for (name,), rows in groups:
        facts, seen, texts = _Facts(), set(), []
        for row in rows:
            role, text = row[_ROLE], row[_TEXT]
            kind, digest = _kind(text), _digest(role, text)
            kind = "d" if kind != "b" and digest in seen else kind
            seen.add(digest)
            facts.add(row[_TURN], role, kind)
            # What has to go is not held.
            texts.append((role, "" if kind in "bd" else text))
        cost, audit, _ = cheapest("".join(facts.codes))
        turns = [dict(role=r, text=t) for r, t in carried_out(iter(texts), audit, START)]
        yield dict(key=name, part=0, parts=1, report=facts.report(cost, audit), turns=turns)


def _written(rows: Iterable[dict], schema: T.StructType = _PARTS) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([pa.field(f.name, _arrow(f.dataType)) for f in schema])
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(t["text"]) for t in row.get("turns") or ())
        if len(held) >= _OUT_ROWS or chars >= _OUT_CHARS:
            yield pa.RecordBatch.from_pylist(held, kind)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, kind)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    plain = {T.StringType: pa.string(), T.LongType: pa.int64(), T.IntegerType: pa.int32()}
    return {**plain, T.BinaryType: pa.binary(), T.DoubleType: pa.float64()}[type(kind)]


# Conversations in segments.

_GROUP = [_KEY, SEGMENT]
_SEEN = f"{_KEY} string, {SEGMENT} int, at int, turn long, role string, kind string, digest binary"


def _split(hot: DataFrame) -> DataFrame:
    """As :func:`_whole`, for conversations cut into segments."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_rows():
            for group, rows in _groups(batches, _GROUP):
                for at, row in enumerate(rows):
                    role, text = row[_ROLE], row[_TEXT]
                    yield dict(zip(_GROUP, group)) | dict(
                        at=at,
                        turn=row[_TURN],
                        # An initial is all that the lattice needs of a role.
                        role=role[:1],
                        kind=_kind(text),
                        digest=_digest(role, text),
                    )

        return _written(all_rows(), _SEEN_TYPE)

    in_order = hot.repartition(*_GROUP).sortWithinPartitions(_KEY, SEGMENT, *_SORT[1:])
    seen = kept(in_order.mapInArrow(read, _SEEN))
    first = seen.groupBy(_KEY, "digest").agg(F.min(F.struct(SEGMENT, "at")).alias("first"))
    again = F.struct(SEGMENT, "at") > F.col("first")
    kinds = seen.join(first, [_KEY, "digest"]).select(
        *_GROUP, "at", "turn", "role", F.when(again & (F.col("kind") != "b"), "d").otherwise(F.col("kind")).alias("kind")
    )
    facts = kept(
        kinds.groupBy(*_GROUP)
        .agg(F.array_sort(F.collect_list(F.struct("at", "turn", "role", "kind"))).alias("rows"))
        .select(*_GROUP, _segment_facts("rows").alias("facts"))
    )
    # Costs of the ways through segments, then of what lies behind each: a few numbers each.
    ways = facts.groupBy(_KEY).agg(
        F.array_sort(F.collect_list(F.struct(SEGMENT, "facts.costs"))).alias("ways")
    )
    behind = ways.select(_KEY, F.posexplode(_costs_behind("ways")).alias("n", "behind"))
    behind = behind.select(_KEY, "behind.segment", F.col("behind.ends").alias("ends"))
    behind = behind.withColumnRenamed("segment", SEGMENT)
    moves = kept(
        facts.join(behind, _GROUP).select(*_GROUP, _moves("facts.codes", "ends").alias("moves"))
    )
    passed = moves.groupBy(_KEY).agg(
        F.array_sort(
            F.collect_list(F.struct(SEGMENT, F.transform("moves", lambda m: m["to"]).alias("to")))
        ).alias("ways")
    )
    entered = passed.select(_KEY, F.explode(_states_entered("ways")).alias("e"))
    entered = entered.select(_KEY, F.col("e.segment").alias(SEGMENT), F.col("e.state").alias("state"))
    chosen = kept(
        moves.join(entered, _GROUP).select(
            *_GROUP, "state", F.get("moves", F.col("state"))["audit"].alias("audit")
        )
    )
    audits = chosen.groupBy(_KEY).agg(
        F.array_sort(F.collect_list(F.struct(SEGMENT, "audit"))).alias("parts")
    )
    whole_audit = F.array_join(F.transform("parts", lambda p: p["audit"]), "")
    reports = (
        facts.groupBy(_KEY)
        .agg(
            F.array_sort(
                F.collect_list(F.struct(SEGMENT, F.col("facts").dropFields("codes", "costs").alias("facts")))
            ).alias("facts")
        )
        .join(audits.select(_KEY, F.size("parts").alias("parts"), whole_audit.alias("audit")), _KEY)
        .join(ways.select(_KEY, F.get(_costs_behind("ways"), F.lit(0))["own"].alias("cost")), _KEY)
        .select(_KEY, "parts", _added_up("facts", "cost", "audit").alias("report"))
    )
    # The edits of a segment stand in front of its rows, the state it starts in as the turn.
    report = F.when(F.col(SEGMENT) == 0, F.col("report")).alias("report")
    heads = chosen.join(reports, _KEY).select(
        _KEY, SEGMENT, F.lit(0).alias("kind"), F.col("state").cast("long").alias(_TURN),
        F.lit("").alias(_ROLE), F.col("audit").alias(_TEXT), "parts", report,
    )
    own = hot.select(_KEY, SEGMENT, F.lit(1).alias("kind"), _TURN, _ROLE, _TEXT)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for (name, segment), rows in _groups(batches, _GROUP):
                head = next(rows)
                texts = ((r[_ROLE], r[_TEXT]) for r in rows)
                turns = carried_out(texts, head[_TEXT], head[_TURN])
                yield dict(
                    key=name,
                    part=segment,
                    parts=head["parts"],
                    report=head["report"],
                    turns=[dict(role=r, text=t) for r, t in turns],
                )

        return _written(parts())

    ordered = heads.unionByName(own, allowMissingColumns=True).repartition(*_GROUP)
    ordered = ordered.sortWithinPartitions(_KEY, SEGMENT, "kind", *_SORT[1:])
    return ordered.mapInArrow(write, _PARTS_SQL)


_SEEN_TYPE = (
    T.StructType().add(_KEY, "string").add(SEGMENT, "integer").add("at", "integer").add("turn", "long")
    .add("role", "string").add("kind", "string").add("digest", "binary")
)


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


# As objects: a type in words needs a session to be read.
_LONG, _INT, _STR, _COSTS = T.LongType(), T.IntegerType(), T.StringType(), T.ArrayType(T.DoubleType())
_FACTS = _fields(
    blank=_LONG, duplicate=_LONG, truncated=_LONG, illegal=_LONG, turns=_LONG, first=_LONG,
    last=_LONG, initials=_STR, codes=_STR, costs=_COSTS,
)
_BEHIND = T.ArrayType(_fields(segment=_INT, ends=_COSTS, own=_LONG))


@F.udf(_FACTS)
def _segment_facts(rows):
    facts = _Facts()
    for row in rows:
        facts.add(row["turn"], row["role"], row["kind"])
    codes = "".join(facts.codes)
    costs = [
        float(path[0]) if (path := cheapest(codes, source, ((end, 0),))) else inf
        for source in STATES
        for end in STATES
    ]
    return (
        facts.blank, facts.duplicate, facts.truncated, facts.illegal, facts.turns,
        facts.first, facts.last, facts.initials, codes, costs,
    )


@F.udf(_BEHIND)
def _costs_behind(ways):
    """What each state at the end of a segment costs up to the end of the conversation."""
    n, out = len(STATES), []
    ends = [float(dict(ENDS).get(s, inf)) for s in STATES]
    for segment, costs in reversed(ways):
        out.append((segment, ends))
        ends = [min(costs[s * n + e] + ends[e] for e in STATES) for s in STATES]
    return [(segment, own, int(ends[START])) for segment, own in reversed(out)]


@F.udf(T.ArrayType(_fields(audit=_STR, to=_INT)))
def _moves(codes, ends):
    """The cheapest edits of a segment from each state, and the state they lead to."""
    rest = tuple((s, int(e)) for s, e in enumerate(ends) if e < inf)
    paths = (cheapest(codes, source, rest) for source in STATES)
    return [(path[1], path[2]) if path else (None, None) for path in paths]


@F.udf(T.ArrayType(_fields(segment=_INT, state=_INT)))
def _states_entered(ways):
    out, state = [], START
    for segment, to in ways:
        out.append((segment, state))
        state = to[state]
    return out


@F.udf(_REPORT)
def _added_up(parts, cost, audit):
    """Facts of all segments as one report."""
    whole = _Facts()
    for _, facts in parts:
        whole.blank += facts["blank"]
        whole.duplicate += facts["duplicate"]
        whole.truncated += facts["truncated"]
        whole.illegal += facts["illegal"]
        if whole.initials:
            whole.illegal += illegal(whole.initials[-1] + facts["initials"][0])
        whole.initials = facts["initials"]
        if facts["turns"]:
            whole.turns += facts["turns"] - (facts["first"] == whole.last)
            whole.first = facts["first"] if whole.first is None else whole.first
            whole.last = facts["last"]
    return whole.report(cost, audit)


def turns(parts: DataFrame) -> DataFrame:
    """(key, part, place, role, text): one row per repaired turn, from :func:`repaired`."""
    return parts.select(_KEY, "part", F.posexplode("turns").alias("place", "turn")).select(
        _KEY, "part", "place", "turn.role", "turn.text"
    )


def digests(parts: DataFrame) -> DataFrame:
    """(key, report, repaired_sha256): digest of the turns as lines ``role:text``.

    A digest is worked out in order, so a conversation in parts streams through one task,
    which holds one part at a time.
    """
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    text = F.array_join(lines, "\n")
    one = parts.where("parts = 1").select(_KEY, "report", F.sha2(text, 256).alias("repaired_sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_digests():
            for (name,), rows in _groups(batches, (_KEY,)):
                sha, report, begun = hashlib.sha256(), None, False
                for row in rows:
                    report = report or row["report"]
                    if row["lines"]:
                        sha.update((b"\n" if begun else b"") + row["text"].encode())
                        begun = True
                yield dict(key=name, report=report, repaired_sha256=sha.hexdigest())

        return _written(all_digests(), _DIGESTS)

    long = parts.where("parts > 1").select(
        _KEY, "part", "report", F.size("turns").alias("lines"), text.alias("text")
    )
    ordered = long.repartition(_KEY).sortWithinPartitions(_KEY, "part")
    streamed = ordered.mapInArrow(run, _DIGESTS.simpleString().removeprefix("struct<")[:-1])
    return one.unionByName(streamed)


_DIGESTS = T.StructType(
    [_PARTS[_KEY], _PARTS["report"], T.StructField("repaired_sha256", T.StringType())]
)
