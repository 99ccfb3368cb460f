"""The cheapest edits that put the roles of a conversation into a legal order.

A legal order of role initials is empty, or pairs of ``ua`` with at most one ``s`` in front.
Rows come as one letter each: an initial (``o`` for any other role), in upper case if the
row is cut off, or ``X`` if the row has to go.

The lattice has a node for each place between rows and each state of the order; an edge is an
edit. From a node each edit leads to one other node, so a string of edits names one path.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache
from math import inf

#: State before anything, after the system's turn, after the user's, after the assistant's.
STATES = START, SYSTEM, USER, ASSISTANT = range(4)
GONE = "X"
#: Cost of a new role, of a row put in, of a row taken out, of one left cut off.
REROLE, INSERT, DELETE, CUT_OFF = 3, 3, 4, 3
_AFTER = (
    {"s": SYSTEM, "u": USER},
    {"u": USER},
    {"a": ASSISTANT},
    {"u": USER},
)
#: State after the one turn of a user or an assistant that may come next, and its role.
_ADDED = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Where a whole conversation may end, at no further cost.
ENDS = ((START, 0), (ASSISTANT, 0))

Path = tuple[int, str, int]


def _edits(codes: str, at: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(letter, place, state, cost) of the edits at a node, in the order of their letters."""
    if at < len(codes):
        code = codes[at]
        yield "D", at + 1, state, DELETE
    yield "I", at, _ADDED[state], INSERT
    if at < len(codes) and code != GONE:
        more = CUT_OFF if code.isupper() else 0
        kept = _AFTER[state].get(code.lower())
        if kept is not None:
            yield "K", at + 1, kept, more
        yield "R", at + 1, _ADDED[state], REROLE + more


def _edits_to(codes: str, at: int, state: int) -> Iterator[tuple[int, int, int]]:
    """(place, state, cost) of the nodes with an edit to this one."""
    for before in STATES:
        for place in (at - 1, at):
            if place >= 0:
                for _, to, reached, cost in _edits(codes, place, before):
                    if to == at and reached == state:
                        yield place, before, cost


def _search(codes: str, source: int, ends: tuple[tuple[int, float], ...]):
    """Costs from the source and costs to the ends of the nodes settled by two Dijkstra
    searches that meet, and the cost of the cheapest path.

    They go on until no path of the least cost has an edge that neither has settled.
    """
    last = len(codes)
    # At one cost, nodes that edits of no cost lead from come first.
    ahead, back = [(0, 0, source)], [(cost, -last, state) for state, cost in ends if cost < inf]
    heapq.heapify(back)
    settled_ahead: dict[tuple[int, int], float] = {}
    settled_back: dict[tuple[int, int], float] = {}
    best = inf
    while ahead or back:
        top_ahead = ahead[0][0] if ahead else 0
        top_back = back[0][0] if back else 0
        if top_ahead + top_back > best:
            break
        if ahead and (not back or top_ahead <= top_back):
            cost, at, state = heapq.heappop(ahead)
            node = at, state
            if node in settled_ahead:
                continue
            settled_ahead[node] = cost
            best = min(best, cost + settled_back.get(node, inf))
            for _, place, reached, more in _edits(codes, at, state):
                met = settled_back.get((place, reached))
                if met is not None:
                    best = min(best, cost + more + met)
                if (place, reached) not in settled_ahead:
                    heapq.heappush(ahead, (cost + more, place, reached))
        else:
            cost, at, state = heapq.heappop(back)
            node = -at, state
            if node in settled_back:
                continue
            settled_back[node] = cost
            best = min(best, cost + settled_ahead.get(node, inf))
            for place, before, more in _edits_to(codes, *node):
                met = settled_ahead.get((place, before))
                if met is not None:
                    best = min(best, met + more + cost)
                if (place, before) not in settled_back:
                    heapq.heappush(back, (cost + more, -place, before))
    return settled_ahead, settled_back, best


def cheapest(
    codes: str, source: int = START, ends: tuple[tuple[int, float], ...] = ENDS
) -> Path | None:
    """(cost, audit, state at the end) of the cheapest edits; the least audit among equals.

    ``ends`` has the states that may be reached and what each costs from there on; that is
    part of the cost. None if no edits lead there.
    """
    return _remembered(codes, source, ends) if len(codes) <= 64 else _cheapest(codes, source, ends)


def _cheapest(codes: str, source: int, ends: tuple[tuple[int, float], ...]) -> Path | None:
    ahead, back, best = _search(codes, source, ends)
    if best == inf:
        return None

    def crossings(node):
        """Edits that go over, on a cheapest path, from what the first search settled to
        what the second did."""
        return (
            (letter, (place, state))
            for letter, place, state, cost in _edits(codes, *node)
            if ahead[node] + cost + back.get((place, state), inf) == best
        )

    # Nodes of the first search from which its own cheapest edges lead to a crossing.
    leads: set[tuple[int, int]] = set()

    def onward(node):
        return (
            (letter, (place, state))
            for letter, place, state, cost in _edits(codes, *node)
            if (place, state) in leads and ahead[node] + cost == ahead[place, state]
        )

    for node in sorted(ahead, key=lambda n: (ahead[n], n[0]), reverse=True):
        over = ahead[node] + back.get(node, inf) == best
        if over or any(crossings(node)) or any(onward(node)):
            leads.add(node)
    last, rest = len(codes), dict(ends)
    node, audit, crossed = (0, source), [], (0, source) not in leads
    while True:
        at, state = node
        if at == last and node in back and back[node] == rest.get(state, inf):
            if crossed or ahead[node] + back[node] == best:
                return best, "".join(audit), state
        steps = []
        if not crossed:
            steps += [(letter, to, False) for letter, to in onward(node)]
        if not crossed and node in ahead:
            steps += [(letter, to, True) for letter, to in crossings(node)]
        if node in back and (crossed or ahead[node] + back[node] == best):
            steps += [
                (letter, (place, reached), True)
                for letter, place, reached, cost in _edits(codes, at, state)
                if (place, reached) in back and back[node] == cost + back[place, reached]
            ]
        # One letter leads to one node, however it was found.
        letter, to, over = min(steps, key=lambda s: (s[0], not s[2]))
        audit.append(letter)
        node, crossed = to, crossed or over


@lru_cache(maxsize=100_000)
def _remembered(codes: str, source: int, ends: tuple[tuple[int, float], ...]) -> Path | None:
    return _cheapest(codes, source, ends)


def illegal(initials: str) -> int:
    """Neighbours other than system and user, user and assistant, assistant and user."""
    pairs = zip(initials, initials[1:])
    return sum(a + b not in ("su", "ua", "au") for a, b in pairs)


def carried_out(
    rows: Iterator[tuple[str, str]], audit: str, state: int
) -> Iterator[tuple[str, str]]:
    """(role, text) of a conversation after its edits, which start in ``state``."""
    for letter in audit:
        if letter == "I":
            state = _ADDED[state]
            yield ROLES[state], ""
            continue
        role, text = next(rows)
        if letter == "K":
            state = _AFTER[state][role[:1]]
            yield role, text
        elif letter == "R":
            state = _ADDED[state]
            yield ROLES[state], text
