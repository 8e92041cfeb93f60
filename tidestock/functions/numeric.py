"""Null-aware arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def floor_zero(value: Column) -> Column:
    """Negative values become 0 and NULL stays NULL (``greatest`` alone would drop the NULL)."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def clamp(value: Column, low: Column, high: Column) -> Column:
    """Limit to [low, high]; NULL stays NULL."""
    return F.when(value < low, low).when(value > high, high).otherwise(value)


def number_or_zero(value: Column) -> Column:
    """Parse as double; unreadable text and NULL count as 0."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def divide_or(numerator: Column, denominator: Column, default: float | None = None) -> Column:
    """Division that yields ``default`` (or NULL) when the denominator is 0 or NULL."""
    ratio = F.try_divide(numerator, denominator)
    return ratio if default is None else F.coalesce(ratio, F.lit(default))


def total(value: Column) -> Column:
    """Sum in which a group of NULLs counts as 0."""
    return F.coalesce(F.sum(value), F.lit(0.0))


def one_row(df: DataFrame) -> Column:
    """A one-row frame as a struct-valued scalar subquery.

    The frame runs once and its fields enter other plans as constants: no join, and the
    caller's rows are neither shuffled nor collected.
    """
    return df.select(F.struct(*[F.col(c) for c in df.columns])).scalar()
