"""Item-by-month forecast inputs, quantities and revenue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestock.functions.dates import month_label
from tidestock.functions.numeric import floor_zero, total
from tidestock.operators.facts import item_stats, monthly_revenue, revenue_total

MID_MONTH = 15  # fixed value: day number given to every future month


def future_grid(items: DataFrame, months: int, start: Column) -> DataFrame:
    """Every row of ``items`` for each of the next ``months`` months after ``start``.

    The months are generated per row, so no join takes place. Future dates clamp to the end
    of short months.
    """
    ahead = F.explode(F.sequence(F.lit(1), F.lit(months)))
    return items.select("*", ahead.alias("months_ahead")).withColumn(
        "forecast_date", F.add_months(start, F.col("months_ahead"))
    )


def last_date(daily: DataFrame, date: str = "invoice_date") -> Column:
    return daily.agg(F.max(date)).scalar()


def month_means(daily: DataFrame) -> DataFrame:
    """Mean daily quantity per (item, calendar month), years pooled."""
    return daily.groupBy("item_id", F.month("invoice_date").alias("month")).agg(
        F.avg("qty").alias("qty_mean_item_month")
    )


def seasonal_mean(grid: DataFrame, means: DataFrame, fallback: str = "qty_mean_item") -> DataFrame:
    """Attach the (item, month) mean; a month without history takes the item mean."""
    joined = grid.join(means, ["item_id", "month"], "left")
    return joined.withColumn("qty_mean_item_month", F.coalesce("qty_mean_item_month", fallback))


def forecast_features(daily: DataFrame, months: int = 12) -> DataFrame:
    """Model inputs for every item and future month.

    The day is fixed to the middle of the month while the weekday is that of the future
    date; both lags repeat the item's latest quantity.
    """
    grid = future_grid(item_stats(daily), months, last_date(daily))
    date = F.col("forecast_date")
    dated = grid.withColumns({
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year": F.year(date),
        "day": F.lit(MID_MONTH),
        "weekday": F.weekday(date),
        "qty_lag_1": F.col("qty_last"),
        "qty_lag_7": F.col("qty_last"),
    })
    return seasonal_mean(dated, month_means(daily)).drop("qty_last")


def baseline_prediction(rows: DataFrame) -> DataFrame:
    """Deterministic predictor: the seasonal mean itself."""
    return rows.withColumn("prediction", F.col("qty_mean_item_month"))


def forecast_detail(predicted: DataFrame) -> DataFrame:
    """(item_id, year, month, qty_forecast, revenue_forecast) from predicted future rows."""
    qty = floor_zero(F.col("prediction"))
    return predicted.select(
        "item_id",
        "year",
        "month",
        qty.alias("qty_forecast"),
        (qty * F.col("last_price")).alias("revenue_forecast"),
    )


def forecast_monthly(detail: DataFrame) -> DataFrame:
    """Monthly totals of a forecast, in calendar order."""
    return monthly_revenue(detail, "qty_forecast", "revenue_forecast")


def forecast_total(detail: DataFrame) -> DataFrame:
    return revenue_total(detail, "revenue_forecast")


def fitted_revenue_monthly(predicted: DataFrame) -> DataFrame:
    """Monthly predicted revenue on historical rows; the last price column must exist."""
    if "last_price" not in predicted.columns:
        raise ValueError("column last_price is missing: attach the last price first")
    qty = floor_zero(F.col("prediction"))
    rows = predicted.select(
        F.year("invoice_date").alias("year"),
        F.month("invoice_date").alias("month"),
        qty.alias("qty"),
        (qty * F.col("last_price")).alias("revenue"),
    )
    return monthly_revenue(rows, "qty", "revenue")


def forecast_rollup(detail: DataFrame) -> DataFrame:
    """Item rows per year-month with a subtotal per month and a grand total."""
    keyed = detail.withColumn("year_month", month_label(F.col("year"), F.col("month")))
    return keyed.rollup("year_month", "item_id").agg(
        total(F.col("qty_forecast")).alias("qty_forecast"),
        total(F.col("revenue_forecast")).alias("revenue_forecast"),
        F.grouping_id().alias("level"),
    ).select(
        F.coalesce("year_month", F.lit("TOTAL")).alias("year_month"),
        F.coalesce("item_id", F.lit("TOTAL")).alias("item_id"),
        "qty_forecast",
        "revenue_forecast",
        F.col("level").cast("int").alias("level"),
    )
