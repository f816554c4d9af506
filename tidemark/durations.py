"""Durations given as text ("5 minutes") or as whole seconds."""

from __future__ import annotations

import re

MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def micros(duration: str | int) -> int:
    """Length of a duration in microseconds; a bare number counts seconds."""
    if isinstance(duration, int):
        return duration * MICROS["second"]
    found = re.fullmatch(r"\s*(-?\d+)\s*([a-z]+?)s?\s*", duration)
    if not found or found[2] not in MICROS:
        raise ValueError(f"not a duration: {duration!r}")
    return int(found[1]) * MICROS[found[2]]


def spark_interval(duration: str | int) -> str:
    """The same duration as Spark's window() and withWatermark() read it."""
    return f"{micros(duration)} microseconds"
