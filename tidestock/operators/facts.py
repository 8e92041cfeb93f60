"""Daily facts, prices and summary statistics."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestock.functions.numeric import one_row, total
from tidestock.functions.quantiles import exact_quantiles


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose grouping keys are all present; a NULL key belongs to no group."""
    return df.dropna(subset=list(keys))


def daily_quantity(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Quantity summed to the given grain, partially aggregated before the shuffle."""
    return with_keys(lines, keys).groupBy(*keys).agg(total(F.col("qty")).alias("qty"))


def daily_sales(lines: DataFrame) -> DataFrame:
    return daily_quantity(lines, ["invoice_date", "site", "item_id"])


def daily_purchases(lines: DataFrame) -> DataFrame:
    return daily_quantity(lines, ["invoice_date", "supplier", "item_id"])


def day_order(df: DataFrame, date: str, sequence: str) -> Column:
    """Date, then a whole number, as one decimal: an ordering that hash aggregation can hold."""
    day = F.unix_date(F.col(date).cast("date")).cast("decimal(10,0)") * F.lit(Decimal(10**20))
    return day + F.coalesce(F.col(sequence), F.lit(-(1 << 63))).cast("decimal(20,0)")


def last_price(lines: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Latest non-null unit price per item.

    ``tie_break`` columns make the order total where one item has several prices on its last
    day. With one whole number, or none, the aggregation over the lines is hash-based and keeps one
    candidate per item and task. Other orders first narrow the lines to each item's last day.
    """
    known = with_keys(lines, ["item_id", "unit_price"])
    kinds = dict(known.dtypes)
    if not tie_break or len(tie_break) == 1 and kinds[tie_break[0]] in ("tinyint", "smallint", "int", "bigint"):
        newest = day_order(known, "invoice_date", tie_break[0]) if tie_break else F.unix_date(F.col("invoice_date").cast("date"))
        return known.groupBy("item_id").agg(F.max_by("unit_price", newest).alias("last_price"))
    days = known.groupBy(F.col("item_id").alias("_item")).agg(F.max("invoice_date").alias("_day"))
    on_last = (F.col("item_id") == F.col("_item")) & (F.col("invoice_date") == F.col("_day"))
    return known.join(days, on_last, "left_semi").groupBy("item_id").agg(
        F.max_by("unit_price", F.struct(*tie_break)).alias("last_price")
    )


def attach_last_price(daily: DataFrame, price: DataFrame) -> DataFrame:
    """Every daily row with its item's last price; items without a price keep NULL.

    No join hint: AQE broadcasts the price list when its measured size allows and otherwise
    splits the partitions of items with very many daily rows.
    """
    return daily.join(price, "item_id", "left").select(*daily.columns, "last_price")


def daily_total_series(lines: DataFrame, by: Sequence[str] = (), measures: Sequence[str] = ("qty",)) -> DataFrame:
    """Measures summed per day, over everything or per ``by`` columns."""
    keys = [*by, "invoice_date"]
    return with_keys(lines, keys).groupBy(*keys).agg(*[total(F.col(m)).alias(m) for m in measures])


def mean_qty_by_item(df: DataFrame) -> DataFrame:
    return with_keys(df, ["item_id"]).groupBy("item_id").agg(
        F.avg("qty").alias("mean_qty")
    ).orderBy(F.desc("mean_qty"), "item_id")


def item_stats(daily: DataFrame, order: Sequence[str] = ("invoice_date", "site")) -> DataFrame:
    """Per item: mean quantity, latest quantity (used for both lags) and latest price.

    The last days come from a hash aggregation; only their rows, one for each site, are compared.
    """
    date, *ties = order
    known = with_keys(daily, ["item_id"])
    last_day = lambda c: F.max(F.when(F.col(c).isNotNull(), F.col(date)))
    days = known.groupBy("item_id").agg(
        F.avg("qty").alias("qty_mean_item"), last_day("qty").alias("_qty_day"), last_day("last_price").alias("_price_day")
    )
    on_last = (F.col(date) == F.col("_qty_day")) | (F.col(date) == F.col("_price_day"))
    rows = known.join(days.drop("qty_mean_item"), "item_id").where(on_last)

    def latest(column: str, day: str) -> Column:
        there = (F.col(date) == F.col(day)) & F.col(column).isNotNull()
        return F.array_max(F.collect_list(F.when(there, F.struct(*ties, F.col(column).alias("_value")))))["_value"]

    picked = rows.groupBy("item_id").agg(
        latest("qty", "_qty_day").alias("qty_last"), latest("last_price", "_price_day").alias("last_price")
    )
    return days.select("item_id", "qty_mean_item").join(picked, "item_id", "left")


def monthly_revenue(df: DataFrame, qty: str, revenue: str) -> DataFrame:
    """Revenue and quantity by (year, month), in calendar order."""
    return with_keys(df, ["year", "month"]).groupBy("year", "month").agg(
        total(F.col(revenue)).alias("revenue"), total(F.col(qty)).alias("qty")
    ).orderBy("year", "month")


def revenue_total(df: DataFrame, revenue: str) -> DataFrame:
    return df.agg(total(F.col(revenue)).alias("revenue_total"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles in one row."""
    quartiles = one_row(exact_quantiles(df, column, {"p25": 0.25, "p50": 0.50, "p75": 0.75}))
    value = F.col(column)
    return df.agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ).select(
        "n", "mean", "std", "min",
        *[quartiles[q].alias(q) for q in ("p25", "p50", "p75")],
        "max",
    )


def quantile_table(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """Rows (probability, value) of exact interpolated quantiles."""
    names = {f"q{i}": p for i, p in enumerate(probabilities)}
    row = exact_quantiles(df, column, names)
    pairs = F.array(*[
        F.struct(F.lit(float(p)).alias("probability"), F.col(name).alias("value"))
        for name, p in names.items()
    ])
    return row.select(F.inline(pairs))


def dataset_profile(df: DataFrame, keys: Sequence[str], date: str | None = None, amount: str | None = None) -> DataFrame:
    """One row: row count, distinct values per key, first and last date, total amount."""
    measures = [F.count("*").alias("n_rows")]
    measures += [F.countDistinct(k).alias(f"n_{k}") for k in keys]
    if date is not None:
        measures += [F.min(date).alias("first_date"), F.max(date).alias("last_date")]
    if amount is not None:
        measures += [total(F.col(amount)).alias(f"total_{amount}")]
    return df.agg(*measures)


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; ``top`` keeps a leading part for a report."""
    counted = with_keys(df, [column]).groupBy(column).agg(F.count("*").alias("n_rows"))
    ordered = counted.orderBy(F.desc("n_rows"), column)
    return ordered if top is None else ordered.limit(top)
