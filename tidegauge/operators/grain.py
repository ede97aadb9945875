"""Window length and slide of a time-grouped table."""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, functions as F, types as T

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds(interval: str) -> int:
    """Length of a fixed interval such as ``10 minutes`` or ``1 hour 30 minutes``."""
    parts = re.findall(r"(\d+)\s*([a-z]+)", interval.lower())
    if not parts or re.sub(r"\d+\s*[a-z]+|\s", "", interval.lower()):
        raise ValueError(f"not an interval: {interval!r}")
    try:
        return sum(int(n) * _UNIT_SECONDS[unit.removesuffix("s")] for n, unit in parts)
    except KeyError as unit:
        raise ValueError(f"no fixed length: {interval!r}") from unit


def span(length: int) -> Column:
    """``length`` seconds as an interval column."""
    return F.expr(f"INTERVAL '{length}' SECOND")


# Aligned times as whole numbers of steps since the epoch: date arithmetic is slow and
# has no place in rows that a window spread multiplies. Zone-less times are counted
# without passing through the session zone.
_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def slot_of(name: str, kind: T.DataType, step: int) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"({name} - {_EPOCH}) div INTERVAL '{step}' SECOND")
    return F.expr(f"unix_seconds({name}) div {step}")


def time_of(name: str, kind: T.DataType, step: int) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"{_EPOCH} + {name} * INTERVAL '{step}' SECOND")
    return F.expr(f"timestamp_seconds({name} * {step})")


@dataclass(frozen=True)
class Grain:
    """Epoch-aligned windows ``[start, start + window)`` every ``slide``; no slide: tumbling."""

    window: str = "10 minutes"
    slide: str | None = "1 minute"

    @property
    def window_seconds(self) -> int:
        return seconds(self.window)

    @property
    def slide_seconds(self) -> int:
        return seconds(self.slide or self.window)

    @property
    def panes(self) -> int | None:
        """Slides per window, None where the window is no multiple of the slide."""
        n, rest = divmod(self.window_seconds, self.slide_seconds)
        return None if rest else n

    def divided(self) -> Grain:
        """Windows of the same length by the longest slide that divides window and slide."""
        return Grain(self.window, f"{gcd(self.window_seconds, self.slide_seconds)} seconds")

    def column(self, ts: Column) -> Column:
        return F.window(ts, self.window, self.slide or self.window)

    def pane(self, ts: Column) -> Column:
        """Start of the slide-long pane that holds ``ts``; also the last window start over it."""
        return F.window(ts, f"{self.slide_seconds} seconds")["start"]


REALTIME = Grain()
HOURLY = Grain("1 hour", None)
