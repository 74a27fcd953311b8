"""Numeric expressions shared by the detection rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_zero(c: Column | str) -> Column:
    """The number, or 0.0 where it is missing."""
    return F.coalesce(_col(c).cast("double"), F.lit(0.0))


def deviation_pct(current: Column | str, mean: Column | str) -> Column:
    """Percent by which `current` lies above `mean`, with the divisor held at 1 or more."""
    return (_col(current) - _col(mean)) / F.greatest(_col(mean), F.lit(1.0)) * 100


def share_pct(flag: Column, digits: int = 2) -> Column:
    """Aggregate: percent of rows for which `flag` holds, rounded."""
    rate = F.lit(100.0) * F.sum(F.when(flag, 1).otherwise(0)) / F.nullif(F.count(F.lit(1)), F.lit(0))
    return F.round(rate.cast("double"), digits)


def grade(ratio: Column | str, warn: float = 0.8, alarm: float = 0.9, invert: bool = False) -> Column:
    """Colour of a ratio: green below `warn`, yellow from `warn`, red from `alarm`.

    `invert` gives the reading for ratios where high is good: green from `alarm`, red below `warn`.
    """
    low, high = ("red", "green") if invert else ("green", "red")
    value = _col(ratio)
    return F.when(value >= alarm, high).when(value >= warn, "yellow").otherwise(low)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Seconds from `start` to `end` with microseconds kept."""
    first, last = (F.unix_micros(_col(c).cast("timestamp")) for c in (start, end))
    return (last - first) / F.lit(1_000_000.0)
