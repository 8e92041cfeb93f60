"""Ordered-row operators that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunked_lags(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    lags: Mapping[str, int],
    chunk: Column,
    descending: bool = False,
) -> DataFrame:
    """Values of the k-th previous row of the key, for every (name -> k) in ``lags``.

    A window over the key alone would sort all rows of a hot key in one task. Rows are ordered inside
    (key, chunk) instead, where ``chunk`` is a non-decreasing function of the order such as the month.
    Rows beyond the first ``max(lags)`` of a chunk find their values there. The first ones look among the
    edges of chunks alone, first and last rows, which hold all rows that can precede them closely enough:
    a second exchange moves these, a bounded number for each chunk. Both parts read the same first exchange.
    The result equals the plain window. ``descending`` turns lags into leads.
    """
    depth = max(lags.values())
    direction = F.desc if descending else F.asc
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*map(direction, order))
    across = Window.partitionBy(*keys).orderBy(*map(direction, ["_chunk", *order]))
    placed = df.withColumn("_chunk", chunk).select(
        "*", F.row_number().over(inside).alias("_row"), F.count("*").over(Window.partitionBy(*keys, "_chunk")).alias("_size")
    )

    def found(rows: DataFrame, window) -> DataFrame:
        return rows.select("*", *[F.lag(value, k).over(window).alias(name) for name, k in lags.items()])

    first, last = F.col("_row") <= depth, F.col("_row") > F.col("_size") - depth
    body = found(placed, inside).where(~first)
    heads = found(placed.where(first | last), across).where(first)
    return body.unionByName(heads).select(*df.columns, *lags)


def group_means(df: DataFrame, key: str, part: str, value: str, key_mean: str, part_mean: str) -> DataFrame:
    """Mean of ``value`` per key and per (key, part), attached to every row.

    Sums and counts are aggregated map-side to one row per (key, part) and joined back once;
    the rows themselves are not sorted or windowed. ``part`` must have few values per key.
    """
    sums = df.groupBy(key, part).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    whole = Window.partitionBy(key)
    means = sums.select(
        key,
        part,
        F.try_divide(F.sum("_sum").over(whole), F.sum("_n").over(whole)).alias(key_mean),
        F.try_divide(F.col("_sum"), F.col("_n")).alias(part_mean),
    )
    return df.join(means, [key, part], "left")


def past_means(
    df: DataFrame, key: str, part: str, value: str, key_mean: str, part_mean: str, order: Sequence[str], chunk: Column
) -> DataFrame:
    """Mean of ``value`` over the earlier rows of the key and over those of its (key, part); null without any.

    Totals of (key, chunk) are accumulated over chunks, one short row each; a row adds the running sum of its
    own chunk, so no key is sorted in one task. ``part`` must be the same for all rows of a chunk, as the
    calendar month is for months.
    """
    cut = df.withColumn("_chunk", chunk)
    totals = cut.groupBy(key, "_chunk", part).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    before = {
        "_key": Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1),
        "_part": Window.partitionBy(key, part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1),
    }
    sums = {f"{name}{c}": F.coalesce(F.sum(c).over(w), F.lit(0)) for name, w in before.items() for c in ("_sum", "_n")}
    carried = totals.select(key, "_chunk", *[c.alias(name) for name, c in sums.items()])
    own = Window.partitionBy(key, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = cut.select("*", F.coalesce(F.sum(value).over(own), F.lit(0)).alias("_in_sum"), F.count(value).over(own).alias("_in_n"))
    joined = rows.join(carried, [key, "_chunk"], "left")

    def mean(name: str) -> Column:
        return F.try_divide(F.col(f"{name}_sum") + F.col("_in_sum"), F.col(f"{name}_n") + F.col("_in_n"))

    return joined.select(*df.columns, mean("_key").alias(key_mean), mean("_part").alias(part_mean))


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Mean of ``value`` over rows with equal keys, attached to every row."""
    means = df.groupBy(*keys).agg(F.avg(value).alias(name))
    return df.join(means, list(keys), "left")


def previous_values(
    series: DataFrame, steps: int, value: Column, name: str, by: Sequence[str] = (), order: str = "invoice_date"
) -> DataFrame:
    """Array of the ``steps`` values before each row; rows with a shorter past are dropped.

    ``series`` holds at most one gap-free row per day and series, so a window partition is
    never longer than the calendar.
    """
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(-steps, -1)
    past = series.withColumn(name, F.collect_list(value).over(window))
    return past.where(F.size(name) == steps)


def difference(series: DataFrame, value: str, name: str, by: Sequence[str] = (), order: str = "invoice_date") -> DataFrame:
    """First difference of a daily series."""
    window = Window.partitionBy(*by).orderBy(order)
    return series.withColumn(name, F.col(value) - F.lag(value).over(window))


def adjacent_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each row with the next row of its item in (date, site) order as struct ``next_row``."""
    packed = df.withColumn("_row_values", F.struct(*columns))
    month = F.trunc("invoice_date", "month")
    paired = chunked_lags(
        packed, ["item_id"], ["invoice_date", "site"], "_row_values", {"next_row": 1}, month, descending=True
    )
    return paired.drop("_row_values").where(F.col("next_row").isNotNull())


def from_end_position(series: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Position from the end (1 = last day) of each row of a daily series."""
    newest_first = Window.partitionBy(*by).orderBy(F.desc("invoice_date"))
    return series.withColumn("from_end", F.row_number().over(newest_first))
