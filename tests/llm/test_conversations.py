"""Conversation repair against plain Python that tries every edit."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from sequon.llm import conversations, queries
from sequon.llm.edits import ENDS, cheapest

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")


def tried(rows):
    """(cost, audit, repaired rows): every string of edits by cost, then by its letters."""
    # A path may pass through any order of initials; only the last counts.
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, made, out = heapq.heappop(heap)
        if at == len(rows) and LEGAL.fullmatch(made):
            return cost, audit, list(out)
        # What may follow depends on the last initials alone.
        if (at, made[:1] == "s", len(made) > 1, made[-1:]) in done:
            continue
        done.add((at, made[:1] == "s", len(made) > 1, made[-1:]))

        def go(letter, more, to, role=None, text=""):
            grown = made + (role[:1] or "?") if role is not None else made
            if re.fullmatch(r"s?(ua)*u?", grown):
                added = (*out, (role, text)) if role is not None else out
                heapq.heappush(heap, (cost + more, audit + letter, to, grown, added))

        for role in ("user", "assistant"):
            go("I", 3, at, role)
        if at < len(rows):
            role, text, kind = rows[at]
            go("D", 4, at + 1)
            if kind not in ("blank", "duplicate"):
                more = 3 if kind == "truncated" else 0
                go("K", more, at + 1, role, text)
                for other in ("user", "assistant"):
                    go("R", 3 + more, at + 1, other, text)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        rule = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if rule == 1:
            text = ""
        if rule == 2:
            text = re.sub("[.!?]", "", text)
        if rule == 4:
            role = "user"
        out += [] if rule == 0 else [(conv, turn, role, text)] * (2 if rule == 3 else 1)
    return out


def expected(rows):
    found = {conv: [] for conv, *_ in rows}
    for row in damaged(rows):
        found[row[0]].append(row[1:])
    out = []
    for conv, own in found.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, judged = set(), []
        for _, role, text in own:
            said = re.findall(r"[^\x20\x09-\x0D]", text)
            kind = (
                "blank" if not said
                else "duplicate" if (role, text) in seen
                else "truncated" if said[-1] not in ".!?"
                else ""
            )
            seen.add((role, text))
            judged.append((role, text, kind))
        cost, audit, made = tried(judged)
        turns = [t for t, *_ in own if t is not None]
        kinds = [k for *_, k in judged]
        pairs = zip(judged, judged[1:])
        out.append((
            conv,
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def rows_of(seed, conversations=60, longest=12):
    dice = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "Is it?", "cut off", " ", "", None, "Well.\n", "a longer one. "]
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(dice.randrange(1, longest)):
            rows.append((conv, dice.choice([turn, turn, turn, turn // 2, None]), dice.choice(roles), dice.choice(texts)))
    return rows + dice.sample(rows, 20)


def found(spark, tmp_path, rows, monkeypatch=None, segment_rows=None):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    if segment_rows:
        own = conversations.repaired
        monkeypatch.setattr(conversations, "repaired", lambda df: own(df, segment_rows))
    out = queries.op13_conversations(spark, str(tmp_path))
    assert out.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ]
    return sorted(map(tuple, out.collect()), key=repr)


def test_every_short_conversation():
    for n in range(5):
        for codes in itertools.product("suaoUAX", repeat=n):
            codes = "".join(codes)
            rows = [
                (dict(s="system", u="user", a="assistant", o="tool", x="user")[c.lower()], "",
                 "blank" if c == "X" else "truncated" if c.isupper() else "")
                for c in codes
            ]
            assert cheapest(codes)[:2] == tried(rows)[:2], codes


def test_long_conversations():
    dice = random.Random(1)
    for n in (100, 400):
        codes = "".join(dice.choices("suaoUAX", k=n))
        rows = [
            (dict(s="system", u="user", a="assistant", o="tool", x="user")[c.lower()], "",
             "blank" if c == "X" else "truncated" if c.isupper() else "")
            for c in codes
        ]
        assert cheapest(codes)[:2] == tried(rows)[:2]


def test_no_way_there():
    assert cheapest("", 2, ((0, 0),)) is None and cheapest("", 0, ENDS) == (0, "", 0)


def test_same_as_plain_python(spark, tmp_path):
    rows = rows_of(2)
    assert found(spark, tmp_path, rows) == expected(rows)


def test_conversations_in_segments(spark, tmp_path, monkeypatch):
    rows = rows_of(3, 8, 160) + [(5, t, r, f"{t} again.") for t in range(300) for r in ("user", "tool")]
    rows += [(6, None, "user", "The same.")] * 200
    assert found(spark, tmp_path, rows, monkeypatch, 64) == expected(rows)


def test_segments_on_a_larger_table(spark, tmp_path, monkeypatch):
    dice = random.Random(9)
    rows = [
        (3 if dice.random() < 0.4 else dice.randrange(200), t, dice.choice(["user", "assistant"]), f"{t % 700}.")
        for t in range(4000)
    ]
    assert found(spark, tmp_path, rows, monkeypatch, 320) == expected(rows)


def test_no_rows_and_lost_conversations(spark, tmp_path):
    lost = [(c, t, "user", "x") for c in range(300) for t in (0,) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert lost
    none = hashlib.sha256(b"").hexdigest()
    (tmp_path / "lost").mkdir()
    assert [r[1:] for r in found(spark, tmp_path / "lost", lost)] == [(0,) * 6 + ("", none)] * len(lost)
    (tmp_path / "no").mkdir()
    assert found(spark, tmp_path / "no", []) == []


def test_turns_and_clashing_names(spark):
    rows = spark.createDataFrame(
        [(1, 0, "user", "Hi.", "x", "y"), (1, 1, "user", "Ho " * 200_000 + ".", "x", "y")],
        SCHEMA + ", key string, part string",
    )
    parts = conversations.repaired(rows)
    got = [(r.place, r.role, len(r.text)) for r in conversations.turns(parts).collect()]
    assert sorted(got) == [(0, "user", 3), (1, "assistant", 600_001)]


@pytest.mark.parametrize("codes", ["", "X", "XX"])
def test_nothing_left(codes):
    assert cheapest(codes) == (4 * len(codes), "D" * len(codes), 0)
