"""Train and test splits."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as day

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestock.functions.hashing import row_key, uniform
from tidestock.operators.windows import from_end_position


def filter_item(df: DataFrame, item: str | None) -> DataFrame:
    """Rows of one item, or all rows when no item is named."""
    return df if item is None else df.where(F.col("item_id") == item)


def last_month(df: DataFrame, date: str = "invoice_date") -> Column:
    """First day of the last month present, as a scalar subquery."""
    return df.agg(F.trunc(F.max(date), "month")).scalar()


def in_month(df: DataFrame, year: int | None = None, month: int | None = None, date: str = "invoice_date") -> Column:
    """True for rows of the held-out month; the default is the last month present.

    Written as a date range, which reaches the file scan when the month is given.
    """
    if year is None or month is None:
        start = last_month(df, date)
        return (F.col(date) >= start) & (F.col(date) < F.add_months(start, 1))
    following = day(year + month // 12, month % 12 + 1, 1)
    return (F.col(date) >= F.lit(day(year, month, 1))) & (F.col(date) < F.lit(following))


def holdout_month_split(df: DataFrame, year: int | None = None, month: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test): one month is the test, all other months train."""
    held_out = in_month(df, year, month)
    return df.where(~held_out), df.where(held_out)


def tail_split(series: DataFrame, n_test: int, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(train, test): the last ``n_test`` days of each daily series are the test."""
    placed = from_end_position(series, by)
    train = placed.where(F.col("from_end") > n_test).drop("from_end")
    return train, placed.where(F.col("from_end") <= n_test).drop("from_end")


def random_split(df: DataFrame, key: Sequence[str], test_share: float = 0.2, salt: str = "split-42") -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the row key: the same rows on every run and partitioning."""
    draw = uniform(row_key(key), salt)
    return df.where(draw >= test_share), df.where(draw < test_share)


def with_fold(df: DataFrame, key: Sequence[str], folds: int, salt: str = "fold-42") -> DataFrame:
    """Add ``fold`` in 0..folds-1 by a hash of the row key."""
    return df.withColumn("fold", F.floor(uniform(row_key(key), salt) * folds).cast("int"))
