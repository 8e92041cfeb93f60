import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidestock.functions.hashing import gaussian, row_key, uniform
from tidestock.functions.numeric import clamp, divide_or, floor_zero, number_or_zero, one_row
from tidestock.functions.quantiles import exact_quantiles
from tidestock.functions.ranking import ordered_codes


def test_floor_zero_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (2.0,), (None,)], "x double")
    assert [r[0] for r in df.select(floor_zero(F.col("x"))).collect()] == [0.0, 2.0, None]


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (2.0,), (9.0,), (None,)], "x double")
    out = df.select(clamp(F.col("x"), F.lit(0.0), F.lit(5.0))).collect()
    assert [r[0] for r in out] == [0.0, 2.0, 5.0, None]


def test_number_or_zero(spark):
    df = spark.createDataFrame([("1.5",), ("n/a",), (None,)], "x string")
    assert [r[0] for r in df.select(number_or_zero(F.col("x"))).collect()] == [1.5, 0.0, 0.0]


def test_divide_or(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(divide_or(F.col("a"), F.col("b"), 0.0)).collect()] == [0.0, 0.5, 0.0]


def test_one_row_is_usable_in_filters(spark):
    df = spark.range(10)
    bounds = one_row(df.agg(F.max("id").alias("top"), F.min("id").alias("low")))
    assert df.where((F.col("id") == bounds["top"]) | (F.col("id") == bounds["low"])).count() == 2


def test_uniform_is_stable_and_even(spark):
    df = spark.range(5000).withColumn("u", uniform(row_key(["id"]), "s"))
    again = spark.range(5000).repartition(7).withColumn("u", uniform(row_key(["id"]), "s"))
    assert df.join(again, ["id", "u"]).count() == 5000
    row = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= row[0] and row[1] < 1 and abs(row[2] - 0.5) < 0.02


def test_gaussian_moments(spark):
    row = spark.range(5000).select(gaussian(row_key(["id"]), "g").alias("g")).agg(F.avg("g"), F.stddev("g")).first()
    assert abs(row[0]) < 0.05 and abs(row[1] - 1) < 0.05


@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [1.0, 2.0],
        [7.0] * 50,
        list(np.random.default_rng(1).exponential(50, 3000)),
        [3.0] * 2000 + list(np.random.default_rng(2).normal(0, 9, 1000)),
        [float(v) for v in np.random.default_rng(3).integers(-3, 4, 900)],
    ],
)
def test_exact_quantiles_match_numpy(spark, values):
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(5)
    row = exact_quantiles(df, "x", {f"q{i}": p for i, p in enumerate(probabilities)}).first()
    assert np.allclose(list(row), np.quantile(values, probabilities), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("held, buckets", [(1000, 8), (300, 4)])
def test_exact_quantiles_of_more_values_than_are_held(spark, held, buckets):
    """Ranges are cut again until they may be held; ties and a hot value stay in one place."""
    values = [3.0] * 2000 + [round(v, 3) for v in np.random.default_rng(2).normal(0, 9, 3000)] + [-1e300, 1e300]
    probabilities = [0.001, 0.5, 1.0]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(5)
    names = {f"q{i}": p for i, p in enumerate(probabilities)}
    got = exact_quantiles(df, "x", names, held, buckets).first()
    assert np.allclose(list(got), np.quantile(values, probabilities), rtol=1e-12, atol=1e-12)


def test_exact_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, "x", {"q": 0.5}).first()[0] is None


def test_ordered_codes(spark):
    words = [f"w{i % 700:05d}" for i in range(2000)] + [None]
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(6)
    got = {r["w"]: r["code"] for r in ordered_codes(df, "w", "code").collect()}
    assert got == {w: i for i, w in enumerate(sorted({w for w in words if w}))}


def test_ordered_codes_of_dates_as_text(spark):
    day = datetime.date(2020, 1, 1)
    df = spark.createDataFrame([(day,), (day,)], "d date").select(F.col("d").cast("string").alias("d"))
    assert [tuple(r) for r in ordered_codes(df, "d", "c").collect()] == [("2020-01-01", 0)]
