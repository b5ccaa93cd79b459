"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return c if isinstance(c, Column) else F.col(f"`{c}`")


def rounded(c: str | Column, digits: int = 6) -> Column:
    """Round a double and turn -0.0 into 0.0, so results compare equal across engines."""
    return F.round(col(c).cast("double"), digits) + F.lit(0.0)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null when b is zero or null."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def ratio_or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(ratio(a, b), F.lit(0.0))


def finite(c: str | Column) -> Column:
    """True for a present, non-NaN, non-infinite number."""
    v = col(c).cast("double")
    return F.coalesce(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), F.lit(False))


def nan_to_null(c: str | Column) -> Column:
    v = col(c)
    return F.when(~F.isnan(v), v)


def bucket_floor(c: str | Column, width: float) -> Column:
    """Floor to a multiple of `width`; floors toward minus infinity for negative values."""
    return (F.floor(col(c) / F.lit(width)) * F.lit(width)).cast("int")


def elapsed_seconds(ts: str | Column, start: Column) -> Column:
    """Seconds from `start` to `ts` with microsecond resolution."""
    micros = F.timestamp_diff("MICROSECOND", start, col(ts))
    return micros.cast("double") / F.lit(1e6)


def band(c: str | Column, edges: list[float], labels: list[str], right: bool = False) -> Column:
    """Label of the half-open interval a value falls into; null outside [edges[0], edges[-1]].

    right=False gives [a, b); right=True gives (a, b].
    """
    v = col(c)
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels, strict=True):
        inside = ((v > lo) & (v <= hi)) if right else ((v >= lo) & (v < hi))
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def mean_if(condition: Column) -> Column:
    """Share of rows meeting a condition (null counts as not met)."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))
