"""Calendar expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_fields(date: Column) -> dict[str, Column]:
    """Month, quarter, year, day, weekday (Monday = 0) and month-end flag of a date."""
    return {
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year": F.year(date),
        "day": F.dayofmonth(date),
        "weekday": F.weekday(date),
        "is_month_end": (date == F.last_day(date)).cast("int"),
    }


def cycle(position: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position on a cycle of the given length."""
    angle = F.lit(2 * math.pi) * position / F.lit(period)
    return F.sin(angle), F.cos(angle)


def month_label(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year, month)
