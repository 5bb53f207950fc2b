"""Interval helpers for plan construction."""

from __future__ import annotations

import re

_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def interval_micros(text: str) -> int:
    """``"3500 milliseconds"`` / ``"1 hour 30 minutes"`` -> microseconds."""
    total = 0
    parts = re.findall(r"(-?\d+)\s*([a-zA-Z]+)", text)
    if not parts:
        raise ValueError(f"bad interval {text!r}")
    for n, unit in parts:
        u = unit.lower().rstrip("s")
        if u not in _UNITS_US:
            raise ValueError(f"bad interval unit {unit!r}")
        total += int(n) * _UNITS_US[u]
    return total
