"""Forecast quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestock.functions.numeric import divide_or, one_row, total

# Quality thresholds.
R2_GOOD = 0.85
MAPE_GOOD = 15.0
MAPE_ACCEPTABLE = 25.0


def regression_metrics(df: DataFrame, by: Sequence[str] = (), actual: str = "actual", predicted: str = "prediction") -> DataFrame:
    """R2, MAE and RMSE in one aggregation pass; R2 is NULL when the actual value is constant."""
    error = F.col(actual) - F.col(predicted)
    spread = F.var_pop(actual) * F.count(actual)
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        (1.0 - F.try_divide(F.sum(error * error), spread)).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


def mape_unit_floor(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error; an actual of 0 is divided by 1."""
    base = F.when(actual == 0, F.lit(1.0)).otherwise(actual)
    return F.avg(F.abs((actual - predicted) / base)) * 100.0


def mape_positive(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error over rows whose actual is above 0."""
    return F.avg(F.when(actual > 0, F.abs(F.try_divide(actual - predicted, actual)))) * 100.0


def mape_table(df: DataFrame, by: Sequence[str] = (), actual: str = "actual", predicted: str = "prediction") -> DataFrame:
    pair = F.col(actual), F.col(predicted)
    return df.groupBy(*by).agg(
        mape_unit_floor(*pair).alias("mape_all"), mape_positive(*pair).alias("mape_positive")
    )


def quality_verdict(scores: DataFrame, r2_good: float = R2_GOOD) -> DataFrame:
    """Whether R2 reaches its threshold, and the class of the percentage error."""
    return scores.select(
        "*",
        (F.col("r2") >= r2_good).alias("r2_ok"),
        F.when(F.col("mape") < MAPE_GOOD, "good")
        .when(F.col("mape") < MAPE_ACCEPTABLE, "acceptable")
        .otherwise("high")
        .alias("mape_class"),
    )


def compare_models(scores: DataFrame) -> DataFrame:
    """All metric rows with the best model (largest R2, then name) marked."""
    ranked = F.when(F.col("r2").isNotNull(), F.struct("r2", "model"))
    best = one_row(scores.agg(F.max_by("model", ranked).alias("model")))["model"]
    return scores.withColumn("is_best", (F.col("model") == best).cast("int"))


def revenue_gap(predicted: DataFrame, actual: str = "actual", prediction: str = "prediction") -> DataFrame:
    """Actual and predicted quantity and revenue per item, gap in percent (0 without actual revenue)."""
    price = F.col("last_price")
    per_item = predicted.groupBy("item_id").agg(
        total(F.col(actual)).alias("qty_actual"),
        total(F.col(prediction)).alias("qty_predicted"),
        F.avg(price).alias("mean_price"),
        total(F.col(actual) * price).alias("revenue_actual"),
        total(F.col(prediction) * price).alias("revenue_predicted"),
    )
    return per_item.withColumn("gap_pct", _gap_pct())


def revenue_gap_total(gaps: DataFrame) -> DataFrame:
    """One row of totals over the per-item gaps."""
    return gaps.agg(*[
        total(F.col(c)).alias(c)
        for c in ("qty_actual", "qty_predicted", "revenue_actual", "revenue_predicted")
    ]).withColumn("gap_pct", F.when(F.col("revenue_actual") > 0, _gap_pct()).otherwise(F.lit(0.0)))


def _gap_pct() -> Column:
    return divide_or(
        (F.col("revenue_predicted") - F.col("revenue_actual")) * 100.0, F.col("revenue_actual"), 0.0
    )
