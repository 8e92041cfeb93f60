"""Outlier detection and treatment on one numeric column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestock.functions.numeric import clamp, divide_or, one_row
from tidestock.functions.quantiles import exact_quantiles
from tidestock.models.isolation import isolation_forest
from tidestock.operators.facts import describe

# Default detection limits.
IQR_LOWER_FACTOR = 1.5
IQR_UPPER_FACTOR = 1.5
Z_THRESHOLD = 3.0


def iqr_bounds(
    df: DataFrame,
    column: str = "qty",
    lower_factor: float = IQR_LOWER_FACTOR,
    upper_factor: float = IQR_UPPER_FACTOR,
) -> DataFrame:
    """One row: quartiles, their distance and the two bounds."""
    quartiles = exact_quantiles(df, column, {"q1": 0.25, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    return quartiles.select(
        "q1",
        "q3",
        spread.alias("iqr"),
        (F.col("q1") - F.lit(lower_factor) * spread).alias("lower_bound"),
        (F.col("q3") + F.lit(upper_factor) * spread).alias("upper_bound"),
    )


def _outside(bounds: Column, column: str) -> Column:
    return (F.col(column) < bounds["lower_bound"]) | (F.col(column) > bounds["upper_bound"])


def iqr_outliers(df: DataFrame, bounds: DataFrame, column: str = "qty") -> DataFrame:
    """Rows strictly outside the bounds."""
    return df.where(_outside(one_row(bounds), column))


def iqr_outlier_share(df: DataFrame, bounds: DataFrame, column: str = "qty") -> DataFrame:
    """One row: rows, outliers and their share in percent."""
    return _share(df, _outside(one_row(bounds), column))


def _share(df: DataFrame, flagged: Column) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.count_if(flagged).alias("n_outliers")).withColumn(
        "share_pct", divide_or(F.col("n_outliers") * 100.0, F.col("n_rows"), 0.0)
    )


def iqr_clean(df: DataFrame, bounds: DataFrame, column: str = "qty") -> DataFrame:
    """Rows inside the bounds, bounds included; a NULL value is not inside."""
    limits = one_row(bounds)
    return df.where(F.col(column).between(limits["lower_bound"], limits["upper_bound"]))


def winsorize(df: DataFrame, bounds: DataFrame, column: str = "qty") -> DataFrame:
    """Values beyond a bound are set to it."""
    limits = one_row(bounds)
    return df.withColumn(column, clamp(F.col(column), limits["lower_bound"], limits["upper_bound"]))


def z_score(df: DataFrame, column: str = "qty") -> Column:
    """Distance from the mean in population deviations; NULL when the column is constant."""
    stats = one_row(df.agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std")))
    return F.try_divide(F.col(column) - stats["mean"], stats["std"])


def zscore_outliers(df: DataFrame, column: str = "qty", threshold: float = Z_THRESHOLD) -> DataFrame:
    return df.where(F.abs(z_score(df, column)) > threshold)


def zscore_outlier_share(df: DataFrame, column: str = "qty", threshold: float = Z_THRESHOLD) -> DataFrame:
    return _share(df, F.abs(z_score(df, column)) > threshold)


def outlier_labels(df: DataFrame, column: str = "qty", threshold: float = Z_THRESHOLD) -> DataFrame:
    """Every row with its IQR flag, z-score and z flag."""
    flagged = _outside(one_row(iqr_bounds(df, column)), column)
    score = z_score(df, column)
    return df.select(
        "*",
        F.coalesce(flagged, F.lit(False)).cast("int").alias("is_iqr_outlier"),
        score.alias("z_score"),
        F.coalesce(F.abs(score) > threshold, F.lit(False)).cast("int").alias("is_z_outlier"),
    )


def clean(df: DataFrame, column: str = "qty", method: str = "iqr") -> DataFrame:
    """Treat outliers: ``iqr`` removes them, ``winsor`` caps them."""
    bounds = iqr_bounds(df, column)
    if method == "winsor":
        return winsorize(df, bounds, column)
    if method == "iqr":
        return iqr_clean(df, bounds, column)
    raise ValueError(f"unknown method {method!r}")


def preprocess(df: DataFrame, key: Sequence[str], column: str = "qty", method: str = "iqr") -> dict[str, DataFrame]:
    """What the three detectors find, and the treated table.

    ``describe``: distribution of the column; ``detectors``: rows, outliers and share by the quartile
    fences, the z-score and the isolation forest; ``rows``: the table after :func:`clean`. ``df`` is
    read by each of them: pass a staged table. ``key`` identifies its rows.
    """
    bounds = iqr_bounds(df, column)
    forest = isolation_forest(df, column, list(key))
    parts = {
        "iqr": iqr_outlier_share(df, bounds, column),
        "zscore": zscore_outlier_share(df, column),
        "isolation_forest": _share(forest, F.col("anomaly") == -1),
    }
    detectors = None
    for name, part in parts.items():
        row = part.select(F.lit(name).alias("detector"), *part.columns)
        detectors = row if detectors is None else detectors.unionByName(row)
    return {"describe": describe(df, column), "detectors": detectors, "rows": clean(df, column, method)}


def masked_cap(series: DataFrame, normal: Column, column: str = "qty", probability: float = 0.99) -> DataFrame:
    """Cap normal days at their own quantile; other days keep their value.

    ``series`` has a row a day, so the built-in quantile never holds more values than the calendar has days.
    """
    cap = one_row(series.where(normal).agg(F.percentile(column, probability).alias("cap")))["cap"]
    value = F.col(column)
    return series.withColumn(column, F.when(normal & (value > cap), cap).otherwise(value))


def before_after(before: DataFrame, after: DataFrame, column: str = "qty") -> DataFrame:
    """Row count and distribution of the raw and the cleaned table, one row each."""
    def summary(df: DataFrame, tag: str) -> DataFrame:
        return df.agg(
            F.count("*").alias("n_rows"),
            F.avg(column).alias("mean"),
            F.stddev_samp(column).alias("std"),
            F.min(column).alias("min"),
            F.max(column).alias("max"),
        ).select(F.lit(tag).alias("stage"), "*")

    return summary(before, "before").unionByName(summary(after, "after"))
