"""Label codes, one-hot vectors and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.functions.numeric import divide_or, one_row
from tidestock.functions.ranking import ordered_codes


def label_encode(df: DataFrame, codes: Mapping[str, str]) -> DataFrame:
    """Add 0-based codes (column -> code name) in sorted order of the values as text."""
    given = df
    for column, code in codes.items():
        text = F.col(column).cast("string")
        dictionary = ordered_codes(given.select(text.alias("_label")), "_label", code)
        keyed = df.withColumn("_label", text)
        df = keyed.join(dictionary, "_label", "left").drop("_label")
    return df


def encode_with(df: DataFrame, train: DataFrame, column: str, code: str) -> DataFrame:
    """Codes of ``train``'s values; a value not seen there gets 0, the first class."""
    dictionary = ordered_codes(
        train.select(F.col(column).cast("string").alias("_label")), "_label", code
    )
    coded = df.withColumn("_label", F.col(column).cast("string")).join(dictionary, "_label", "left")
    return coded.withColumn(code, F.coalesce(code, F.lit(0))).drop("_label")


def one_hot_item(df: DataFrame, train: DataFrame, column: str = "item_id", vector: str = "item_vector") -> DataFrame:
    """Sparse one-hot vector over ``train``'s items; an unknown item is all zeros.

    Codes come from a joined dictionary table, so no list of labels passes the driver; the
    encoder only learns how many there are. Unknown items take the code after the last one,
    which is the dropped category.
    """
    dictionary = ordered_codes(train.select(F.col(column).alias("_label")), "_label", "_code")
    n_items = one_row(dictionary.agg(F.count("*").alias("n")))["n"]
    coded = df.withColumn("_label", F.col(column)).join(dictionary, "_label", "left")
    coded = coded.withColumn("_code", F.coalesce(F.col("_code"), n_items).cast("double")).drop("_label")
    top = dictionary.agg(F.count("*").cast("double").alias("_code"))
    encoder = OneHotEncoder(inputCols=["_code"], outputCols=[vector], dropLast=True)
    return encoder.fit(top).transform(coded).drop("_code")


def standard_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population deviation as ``<column>_scaled``; a constant column becomes 0."""
    source = df if fit_on is None else fit_on
    stats = one_row(source.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    ))
    scaled = [
        F.when(F.col(c).isNotNull(), divide_or(F.col(c) - stats[f"mean_{c}"], stats[f"std_{c}"], 0.0))
        .alias(f"{c}_scaled")
        for c in columns
    ]
    return df.select("*", *scaled)


def minmax_scale(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), fit_on: DataFrame | None = None) -> DataFrame:
    """(x - min) / (max - min) as ``<column>_scaled``; a constant column becomes 0.

    With ``by`` each group (such as an item) has its own range, joined from its aggregate.
    """
    source = df if fit_on is None else fit_on
    ranges = [F.min(c).alias(f"_min_{c}") for c in columns] + [F.max(c).alias(f"_max_{c}") for c in columns]
    if by:
        df = df.join(source.groupBy(*by).agg(*ranges), list(by), "left")
        low = {c: F.col(f"_min_{c}") for c in columns}
        high = {c: F.col(f"_max_{c}") for c in columns}
    else:
        bounds = one_row(source.agg(*ranges))
        low = {c: bounds[f"_min_{c}"] for c in columns}
        high = {c: bounds[f"_max_{c}"] for c in columns}
    scaled = [
        F.when(F.col(c).isNotNull(), divide_or(F.col(c) - low[c], high[c] - low[c], 0.0))
        .alias(f"{c}_scaled")
        for c in columns
    ]
    kept = [c for c in df.columns if not c.startswith(("_min_", "_max_"))]
    return df.select(*kept, *scaled)


def minmax_restore(df: DataFrame, column: str, scaled: str, fit_on: DataFrame, name: str) -> DataFrame:
    """Undo :func:`minmax_scale` for a column scaled over the whole frame ``fit_on``."""
    bounds = one_row(fit_on.agg(F.min(column).alias("low"), F.max(column).alias("high")))
    return df.withColumn(name, F.col(scaled) * (bounds["high"] - bounds["low"]) + bounds["low"])
