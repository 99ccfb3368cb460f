"""A page as a flat tree of blocks and text runs, and what is measured of each node.

Nodes stand in page order, so the nodes below one are those from it to its end. An element
that breaks the line is a node; text and inline elements between such breaks are one run, a
leaf. Markup without text for readers (scripts, styles, controls) is left out as it is read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

# Names of elements by how a browser treats them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark nobr q"
    " rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not markup; it ends at their end tag.
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
#: Their content is markup, and nothing to read.
SILENT = frozenset("audio button canvas datalist head map math object option select svg video".split())
_CONTROLS = frozenset("button fieldset form input select textarea".split())
_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary"
    " table ul".split()
)
#: An element closes open ones of the first set, looked for up to one of the second.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "thead": ({"caption", "colgroup"}, {"table"}),
}
_SCOPE = frozenset("body html table td th caption".split())

_TAG = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<(?:[!?]|/(?![A-Za-z]))[^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"\b(class|id|role|itemprop|hidden|style|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+|[^\W\d_a-zA-Z]+")
_BLANK = re.compile(r"\s+")


@dataclass
class Page:
    """Columns of nodes. ``run`` has the text of a run, None for an element."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    tokens: list[tuple[str, ...]] = field(default_factory=list)
    run: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    controls: list[int] = field(default_factory=list)

    def open(self, tag: str, parent: int, tokens: tuple[str, ...], run: str | None = None) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.tokens.append(tokens)
        self.run.append(run)
        self.linked.append(0)
        self.links.append(0)
        self.controls.append(0)
        self.end.append(len(self.tag))
        return len(self.tag) - 1


@lru_cache(maxsize=50_000)
def _attributes(tag: str, text: str) -> tuple[tuple[str, ...], bool]:
    """Tokens of the tag and of what names an element, and whether it is hidden."""
    tokens, hidden = [f"<{tag}>"], False
    for name, value in _ATTRIBUTE.findall(text):
        name, value = name.lower(), html.unescape(value.strip("\"'"))
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style":
            hidden |= bool(_HIDDEN.search(value))
        else:
            tokens += [w.lower() for w in _WORDS.findall(value)]
    return tuple(dict.fromkeys(tokens)), hidden


def parsed(text: str) -> Page:
    """The nodes of a page; its root is node 0."""
    page = Page()
    root = page.open("#page", -1, ())
    # Open elements: (tag, node or -1 if inside something silent).
    stack: list[tuple[str, int]] = [("#page", root)]
    pieces: list[tuple[str, bool]] = []
    # Open links, by the size of the stack when they were opened.
    link_at = 0
    # How many open elements are silent, and how many there are of each tag.
    silent, opened = 0, Counter()

    def flush() -> None:
        nonlocal pieces
        if pieces:
            run = _BLANK.sub(" ", html.unescape("".join(p for p, _ in pieces))).strip()
            if run:
                node = page.open("#text", stack[-1][1], (), run)
                page.linked[node] = sum(len(p.strip()) for p, linked in pieces if linked)
            pieces = []

    def close(to: int) -> None:
        """Close all open elements from a place in the stack on."""
        nonlocal silent, link_at
        flush()
        while len(stack) > to:
            name, node = stack.pop()
            opened[name] -= 1
            if node < 0:
                silent -= 1
            else:
                page.end[node] = len(page.tag)
        if link_at > len(stack):
            link_at = 0

    def close_open(tags, stop) -> None:
        if not any(opened[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                close(i)
                return
            if stack[i][0] in stop:
                return

    at, size = 0, len(text)
    while at < size:
        match = _TAG.search(text, at)
        begin = match.start() if match else size
        if begin > at and not silent:
            pieces.append((text[at:begin], link_at > 0))
        if match is None:
            break
        at = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1]:
            if tag == "a":
                link_at = 0
            elif tag == "br":
                pieces.append((" ", False))
            elif tag not in INLINE and tag not in ("html", "body"):
                close_open({tag}, {"table"} if tag not in ("table", "td", "th", "tr") else ())
            continue
        if stack[-1][0] == "head" and tag not in _HEAD:
            close(len(stack) - 1)
        node = stack[-1][1]
        if tag in _CONTROLS and node >= 0:
            page.controls[node] += 1
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(text, at)
            at = end.start() if end else size
            continue
        if tag == "br":
            pieces.append((" ", False))
            continue
        if tag in INLINE:
            if tag == "a":
                link_at = len(stack)
                if node >= 0:
                    page.links[node] += 1
            continue
        if tag == "hr" or tag in VOID:
            if tag == "hr":
                close_open({"p"}, _SCOPE)
                flush()
            continue
        if tag in ("html", "body") and opened[tag]:
            continue
        if tag in _CLOSES_P:
            close_open({"p"}, _SCOPE)
        if tag in _CLOSES:
            close_open(*_CLOSES[tag])
        flush()
        tokens, hidden = _attributes(tag, match[3])
        opened[tag] += 1
        if silent or hidden or tag in SILENT:
            silent += 1
            stack.append((tag, -1))
        else:
            stack.append((tag, page.open(tag, stack[-1][1], tokens)))
    close(0)
    return page


class TokenOdds:
    """Log odds that a node with a token holds main text; unknown tokens may hold known ones."""

    def __init__(self, odds: dict[str, float]):
        self.odds = odds
        self._inner = sorted(t for t in odds if len(t) >= 4 and t.isalpha())
        self._cache: dict[tuple[str, ...], tuple[float, float]] = {}

    def of(self, tokens: tuple[str, ...]) -> tuple[float, float]:
        """Sum and least over the tokens of one node."""
        found = self._cache.get(tokens)
        if found is None:
            own = [self._one(t) for t in tokens]
            found = (sum(own), min(own, default=0.0))
            if len(self._cache) < 100_000:
                self._cache[tokens] = found
        return found

    def _one(self, token: str) -> float:
        known = self.odds.get(token)
        if known is None:
            inside = [self.odds[t] for t in self._inner if t in token] if token.isalpha() else []
            known = sum(inside) / len(inside) if inside else 0.0
        return known


def words_said(run: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys("said:" + w.lower() for w in _WORDS.findall(run)))


def said(run: str | None) -> tuple[str, ...]:
    """Tokens of a run of few words."""
    if run is None or len(run) > 40:
        return ()
    words = words_said(run)
    return words if len(words) <= 3 else ()


#: Measures of each node, in the order of the columns of :func:`measured`.
NAMES = (
    "is_run is_item is_heading is_p chars words linked ends commas digits longest mean_run links"
    " controls density share before depth place siblings alike sibling_chars sibling_linked"
    " parent_chars parent_linked parent_ends previous_chars next_chars own_odds own_least"
    " odds_above least_above previous_odds least_below said_odds previous_said"
).split()
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 legend summary".split())
_ITEMS = frozenset("li dt dd option td th".split())


def measured(pages: list[Page], odds: TokenOdds) -> np.ndarray:
    """One row per node of all pages, one column per measure."""
    tag = [t for p in pages for t in p.tag]
    n = len(tag)
    if not n:
        return np.zeros((0, len(NAMES)))
    sizes = np.array([len(p.tag) for p in pages], dtype=np.int64)
    begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
    parent = np.array([x for p in pages for x in p.parent], dtype=np.int64)
    root = parent < 0
    parent = np.where(root, 0, parent) + begin
    end = np.array([x for p in pages for x in p.end], dtype=np.int64) + begin
    depth = np.array([x for p in pages for x in p.depth], dtype=np.int64)
    runs = [r or "" for p in pages for r in p.run]
    is_run = np.array([r is not None for p in pages for r in p.run], dtype=float)
    here = np.arange(n)

    def counted(values) -> np.ndarray:
        return np.fromiter(values, dtype=float, count=n)

    def below(own: np.ndarray) -> np.ndarray:
        """Sum over a node and all below it."""
        total = np.concatenate([[0.0], np.cumsum(own)])
        return total[end] - total[here]

    own_chars = counted(len(r) for r in runs)
    chars = below(own_chars)
    words = below(counted(r.count(" ") + 1 if r else 0 for r in runs))
    linked = below(np.minimum(own_chars, counted(x for p in pages for x in p.linked)))
    ends = below(counted(r.count(". ") + r.count("! ") + r.count("? ") + r.endswith((".", "!", "?")) for r in runs))
    commas = below(counted(r.count(",") for r in runs))
    digits = below(counted(sum(map(str.isdigit, r)) if len(r) < 400 else 0 for r in runs))
    links = below(counted(x for p in pages for x in p.links))
    controls = below(counted(x for p in pages for x in p.controls))
    n_runs = np.maximum(1, below(is_run))
    per_char, per_word = np.maximum(1, chars), np.maximum(1, words)
    page_chars = np.maximum(1, chars[begin])
    before = np.concatenate([[0.0], np.cumsum(own_chars)])
    before = before[here] - before[begin]

    token_odds = np.array([odds.of(t) for p in pages for t in p.tokens]).reshape(n, 2)
    words_of = [said(r) for p in pages for r in p.run]
    said_odds, said_words = counted(odds.of(w)[0] for w in words_of), counted(map(len, words_of))
    # From the top down: what stands above a node; and back up: what is below it.
    odds_above, least_above = np.zeros(n), np.zeros(n)
    longest, least_below = own_chars.copy(), np.minimum(token_odds[:, 1], 0)
    by_depth = np.argsort(depth, kind="stable")
    levels = np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1)[1:]
    for own in levels:
        above = parent[own]
        odds_above[own] = odds_above[above] + token_odds[above, 0]
        least_above[own] = np.minimum(least_above[above], token_odds[above, 1])
    for own in reversed(levels):
        np.maximum.at(longest, parent[own], longest[own])
        np.minimum.at(least_below, parent[own], least_below[own])

    # Siblings stand side by side, in page order.
    order = np.argsort(np.where(root, -1, parent), kind="stable")
    same = np.zeros(n, dtype=bool)
    same[1:] = (parent[order][1:] == parent[order][:-1]) & ~root[order][1:] & ~root[order][:-1]
    group = np.cumsum(~same) - 1
    size = np.bincount(group)
    starts = np.flatnonzero(~same)
    place, siblings = np.zeros(n), np.zeros(n)
    place[order], siblings[order] = here - starts[group], size[group]
    codes = {t: i for i, t in enumerate(dict.fromkeys(tag))}
    kind = np.array([codes[t] for t in tag])
    alike_key = np.where(root, -1 - here, parent * len(codes) + kind)
    _, which, alike = np.unique(alike_key, return_inverse=True, return_counts=True)
    previous, following = np.full(n, -1), np.full(n, -1)
    previous[order[1:]] = np.where(same[1:], order[:-1], -1)
    following[order[:-1]] = np.where(same[1:], order[1:], -1)

    def of(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.where(at >= 0, values[at], 0.0)

    others = np.maximum(1, siblings - 1)
    group_chars, group_linked = np.zeros(n), np.zeros(n)
    group_chars[order] = np.bincount(group, chars[order])[group]
    group_linked[order] = np.bincount(group, linked[order])[group]
    sibling_chars = (group_chars - chars) / others
    sibling_linked = (group_linked - linked) / np.maximum(1, group_chars - chars)
    # What is said in a short block, as a heading is.
    short = np.where(chars <= 40, below(said_odds) / np.maximum(1, below(said_words)), 0.0)
    log = np.log1p
    columns = [
        is_run,
        counted(t in _ITEMS for t in tag),
        counted(t in _HEADINGS for t in tag),
        counted(t == "p" for t in tag),
        log(chars),
        log(words),
        linked / per_char,
        ends / per_word,
        commas / per_word,
        digits / per_char,
        log(longest),
        log(chars / n_runs),
        log(links),
        log(controls),
        log(chars / (end - here)),
        chars / page_chars,
        before / page_chars,
        depth,
        place,
        siblings,
        alike[which] / np.maximum(1, siblings),
        log(sibling_chars),
        sibling_linked,
        log(chars[parent]),
        (linked / per_char)[parent],
        (ends / per_word)[parent],
        log(of(chars, previous)),
        log(of(chars, following)),
        token_odds[:, 0],
        token_odds[:, 1],
        odds_above,
        least_above,
        of(token_odds[:, 0], previous),
        least_below,
        short,
        of(short, previous),
    ]
    return np.column_stack(columns)


def decoded(page: Page, odds: np.ndarray) -> list[bool]:
    """Which nodes are kept, for the greatest sum of log odds of the kept ones.

    A node is kept only below kept ones: nothing is main text inside what is not, and what
    holds main text is kept around it.
    """
    n = len(page.tag)
    best = odds.tolist()
    best[0] = 0.0
    for i in range(n - 1, 0, -1):
        if best[i] > 0:
            best[page.parent[i]] += best[i]
    kept = [True] * n
    for i in range(1, n):
        kept[i] = best[i] > 0 and kept[page.parent[i]]
    return kept
