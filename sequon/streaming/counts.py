"""What a stream has refused, by its own progress reports."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from typing import Any

COUNTED = ("accepted", "rejected", "untimed")


def counted(progress: Iterable[Any], seen: str) -> dict[str, int]:
    """Rows accepted, rejected for want of a key, untimed, and late, over micro-batches.

    ``progress`` has reports of a query, such as its ``recentProgress``, which holds the last
    hundred; ``seen`` is the name its operator was given. Late are rows that reached a keyed
    operator behind the watermark.
    """
    total = Counter(dict.fromkeys((*COUNTED, "late"), 0))
    for report in progress:
        row = report["observedMetrics"].get(seen)
        if row is not None:
            total.update({name: row.asDict().get(name, 0) for name in COUNTED})
        for state in report["stateOperators"]:
            total["late"] += state["numRowsDroppedByWatermark"]
    return dict(total)
