from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidestock.functions.hashing import row_key, uniform
from tidestock.operators import augment, encoding, features, outliers, splits, windows
from tidestock.operators.augment import augmented_table, gaussian_noise, interpolate_rows, rare_mix, union_augmented
from tidestock.session import staged

START = date(2023, 1, 1)


def hot_daily(spark, seed=5):
    """One item owns most rows: many sites per day, gaps of months; others are short."""
    rng = np.random.default_rng(seed)
    rows = set()
    for _ in range(900):
        day = START + timedelta(days=int(rng.choice([rng.integers(0, 25), rng.integers(200, 420)])))
        rows.add((day, f"S{rng.integers(0, 30):02d}", "HOT"))
    for item, n in (("B", 12), ("C", 7), ("D", 1)):
        for k in range(n):
            rows.add((START + timedelta(days=40 * k), "S00", item))
    data = [(*r, float(rng.integers(1, 60)), 2.5) for r in sorted(rows)]
    schema = "invoice_date date, site string, item_id string, qty double, last_price double"
    return spark.createDataFrame(data, schema).repartition(6), pd.DataFrame(
        data, columns=["invoice_date", "site", "item_id", "qty", "last_price"]
    )


def test_chunked_lags_equal_plain_lags(spark):
    df, pdf = hot_daily(spark)
    pdf = pdf.sort_values(["item_id", "invoice_date", "site"])
    for name, k in features.LAGS.items():
        pdf[name] = pdf.groupby("item_id")["qty"].shift(k)
    got = features.lag_features(df).toPandas().sort_values(["item_id", "invoice_date", "site"])
    for name in features.LAGS:
        assert np.array_equal(got[name].to_numpy(), pdf[name].to_numpy(), equal_nan=True)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("depths", [(1,), (1, 7), (3, 40)])
def test_chunked_lags_at_any_depth(spark, descending, depths):
    """Chunks shorter and longer than the lags, gaps of many months, one hot item."""
    df, pdf = hot_daily(spark, seed=11)
    lags = {f"k{k}": k for k in depths}
    got = windows.chunked_lags(
        df, ["item_id"], ["invoice_date", "site"], "qty", lags, F.trunc("invoice_date", "month"), descending
    ).toPandas().sort_values(["item_id", "invoice_date", "site"])
    pdf = pdf.sort_values(["item_id", "invoice_date", "site"])
    for name, k in lags.items():
        want = pdf.groupby("item_id")["qty"].shift(-k if descending else k)
        assert np.array_equal(got[name].to_numpy(), want.to_numpy(), equal_nan=True)


def test_chunked_lags_read_once_and_shuffle_twice(spark):
    rows = staged(hot_daily(spark)[0].drop("last_price"), "hot")
    got = features.lag_features(rows)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    exchanges = [line for line in plan.splitlines() if " Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    assert len(exchanges) == 2 and plan.count("ReusedExchange") == 1 and plan.count("FileScan") == 1
    assert any("item_id" in e and "_chunk" not in e.split("hashpartitioning")[1].split(")")[0] for e in exchanges)


def past_means(pdf):
    """Means of earlier rows by definition."""
    pdf = pdf.sort_values(["item_id", "invoice_date", "site"]).reset_index(drop=True)
    pdf["month"] = pd.to_datetime(pdf["invoice_date"]).dt.month
    for keys, name in ((["item_id"], "mean"), (["item_id", "month"], "month_mean")):
        pdf[name] = pdf.groupby(keys)["qty"].transform(lambda q: q.shift().expanding().mean())
    return pdf


def test_past_means_know_only_earlier_rows(spark):
    df, pdf = hot_daily(spark)
    got = features.mean_features(features.date_features(df), leak_free=True)
    assert got.columns == [*features.date_features(df).columns, "qty_mean_item", "qty_mean_item_month"]
    got, want = got.toPandas().sort_values(["item_id", "invoice_date", "site"]), past_means(pdf)
    assert np.allclose(got["qty_mean_item"], want["mean"], equal_nan=True)
    assert np.allclose(got["qty_mean_item_month"], want["month_mean"], equal_nan=True)
    table = features.feature_table(df, leak_free=True).toPandas().sort_values(["item_id", "invoice_date", "site"])
    want["lag7"] = want.groupby("item_id")["qty"].shift(7)
    want = want.dropna(subset=["lag7"])
    assert len(table) == len(want)
    assert np.allclose(table["qty_mean_item_month"], want["month_mean"].fillna(want["mean"]))


def test_past_means_do_not_change_with_later_quantities(spark):
    df, _ = hot_daily(spark)
    cut = F.lit(START + timedelta(days=210))
    changed = df.withColumn("qty", F.when(F.col("invoice_date") >= cut, F.col("qty") * 1000).otherwise(F.col("qty")))
    key = ["item_id", "invoice_date", "site", "qty_mean_item", "qty_mean_item_month"]
    before = [features.mean_features(features.date_features(d), leak_free=True).where(F.col("invoice_date") < cut).select(*key) for d in (df, changed)]
    assert before[0].exceptAll(before[1]).count() == 0


def test_chunked_lags_keep_null_values(spark):
    rows = [(START + timedelta(days=31 * i), "S", "A", None if i == 1 else float(i)) for i in range(4)]
    df = spark.createDataFrame(rows, "invoice_date date, site string, item_id string, qty double")
    got = windows.chunked_lags(
        df, ["item_id"], ["invoice_date"], "qty", {"before": 1}, F.trunc("invoice_date", "month")
    ).orderBy("invoice_date")
    assert [r["before"] for r in got.collect()] == [None, 0.0, None, 2.0]


def test_adjacent_rows_cross_chunks(spark):
    df, pdf = hot_daily(spark)
    got = windows.adjacent_rows(df, ["qty"]).select("item_id", "invoice_date", "site", F.col("next_row.qty").alias("n"))
    pdf = pdf.sort_values(["item_id", "invoice_date", "site"])
    pdf["n"] = pdf.groupby("item_id")["qty"].shift(-1)
    pdf = pdf.dropna()
    got = got.toPandas().sort_values(["item_id", "invoice_date", "site"])
    assert np.array_equal(got["n"].to_numpy(), pdf["n"].to_numpy())


def test_feature_table_against_pandas(spark):
    df, pdf = hot_daily(spark)
    got = features.feature_table(df).toPandas().sort_values(["item_id", "invoice_date", "site"])
    pdf = pdf.sort_values(["item_id", "invoice_date", "site"])
    when = pd.to_datetime(pdf["invoice_date"])
    pdf["month"] = when.dt.month
    pdf["mean"] = pdf.groupby("item_id")["qty"].transform("mean")
    pdf["month_mean"] = pdf.groupby(["item_id", "month"])["qty"].transform("mean")
    pdf["weekday"] = when.dt.dayofweek
    pdf["item_code"] = pdf["item_id"].map({k: i for i, k in enumerate(sorted(pdf["item_id"].unique()))})
    pdf["lag7"] = pdf.groupby("item_id")["qty"].shift(7)
    pdf = pdf.dropna()
    assert len(got) == len(pdf) and set(got["item_id"]) == {"HOT", "B"}
    assert np.allclose(got["qty_mean_item"], pdf["mean"])
    assert np.allclose(got["qty_mean_item_month"], pdf["month_mean"])
    assert np.array_equal(got["weekday"], pdf["weekday"])
    assert np.array_equal(got["item_code"], pdf["item_code"])


def test_month_end_flag(spark):
    df = spark.createDataFrame([(date(2024, 2, 28),), (date(2024, 2, 29),)], "invoice_date date")
    assert [r["is_month_end"] for r in features.date_features(df).collect()] == [0, 1]


def test_overlapping_events_do_not_repeat_days(spark):
    days = spark.createDataFrame([(START + timedelta(days=i),) for i in range(10)], "invoice_date date")
    events = spark.createDataFrame(
        [("a", START, START + timedelta(days=3)), ("a", START + timedelta(days=2), START + timedelta(days=5)),
         ("b", START + timedelta(days=5), START + timedelta(days=5))],
        "name string, start_date date, end_date date",
    )
    got = features.event_flags(days, events, ["a", "b", "c"]).orderBy("invoice_date").collect()
    assert [r["is_a"] for r in got] == [1, 1, 1, 1, 1, 1, 0, 0, 0, 0]
    assert [r["is_b"] for r in got] == [0, 0, 0, 0, 0, 1, 0, 0, 0, 0]
    assert [r["is_c"] for r in got] == [0] * 10


def test_gap_fill_and_windows(spark):
    series = spark.createDataFrame(
        [("A", START, 1.0), ("A", START + timedelta(days=3), 4.0), ("B", START, 2.0)],
        "item_id string, invoice_date date, qty double",
    )
    filled = features.gap_fill_daily(series, by=["item_id"])
    assert filled.count() == 5 and filled.agg(F.sum("qty")).first()[0] == 7.0
    past = windows.previous_values(filled, 2, F.col("qty"), "past", by=["item_id"]).orderBy("invoice_date").collect()
    assert [(r["qty"], r["past"]) for r in past] == [(0.0, [1.0, 0.0]), (4.0, [0.0, 0.0])]


def test_discount_pct_zero_denominator(spark):
    df = spark.createDataFrame([(0.0, 0.0), (-5.0, 15.0)], "d double, n double")
    out = df.select(features.discount_pct(F.col("d"), F.col("n"))).collect()
    assert [r[0] for r in out] == [0.0, 25.0]


def test_unseen_label_is_zero_and_one_hot_is_empty(spark):
    train = spark.createDataFrame([("a",), ("b",)], "item_id string")
    test = spark.createDataFrame([("b",), ("zz",)], "item_id string")
    codes = {r["item_id"]: r["code"] for r in encoding.encode_with(test, train, "item_id", "code").collect()}
    assert codes == {"b": 1, "zz": 0}
    vectors = {r["item_id"]: r["item_vector"] for r in encoding.one_hot_item(test, train).collect()}
    assert vectors["b"].toArray().tolist() == [0.0, 1.0] and vectors["zz"].toArray().tolist() == [0.0, 0.0]


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "x double, c double")
    z = [tuple(r)[2:] for r in encoding.standard_scale(df, ["x", "c"]).collect()]
    assert z == [(-1.0, 0.0), (1.0, 0.0), (None, 0.0)]
    m = encoding.minmax_scale(df, ["x", "c"])
    assert [tuple(r)[2:] for r in m.collect()] == [(0.0, 0.0), (1.0, 0.0), (None, 0.0)]
    back = encoding.minmax_restore(m, "x", "x_scaled", df, "again").collect()
    assert [r["again"] for r in back] == [1.0, 3.0, None]


def test_outlier_rules_both_sides(spark):
    values = [float(v) for v in range(1, 101)] + [-500.0, 900.0, None]
    df = spark.createDataFrame([(v,) for v in values], "qty double")
    known = [v for v in values if v is not None]
    q1, q3 = np.quantile(known, [0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    bounds = outliers.iqr_bounds(df)
    row = bounds.first()
    assert np.allclose([row["lower_bound"], row["upper_bound"]], [low, high])
    assert sorted(r[0] for r in outliers.iqr_outliers(df, bounds).collect()) == [-500.0, 900.0]
    assert outliers.iqr_clean(df, bounds).count() == 100
    capped = [r[0] for r in outliers.winsorize(df, bounds).collect()]
    assert min(v for v in capped if v is not None) == low and max(v for v in capped if v is not None) == high
    assert capped.count(None) == 1
    z = (np.array(known) - np.mean(known)) / np.std(known)
    assert outliers.zscore_outliers(df).count() == int((np.abs(z) > 3).sum())


def test_constant_column_has_no_outliers(spark):
    df = spark.createDataFrame([(4.0,)] * 20, "qty double")
    assert outliers.zscore_outliers(df).count() == 0
    assert outliers.clean(df).count() == 20
    with pytest.raises(ValueError):
        outliers.clean(df, method="other")


def test_masked_cap_spares_event_days(spark):
    rows = [(float(i), 0) for i in range(100)] + [(1000.0, 1), (1000.0, 0)]
    df = spark.createDataFrame(rows, "qty double, event int")
    cap = np.quantile([q for q, e in rows if e == 0], 0.99)
    got = outliers.masked_cap(df, F.col("event") == 0).collect()
    assert [r["qty"] for r in got if r["event"] == 1] == [1000.0]
    assert max(r["qty"] for r in got if r["event"] == 0) == pytest.approx(cap)


def test_splits_cover_everything_once(spark):
    df, _ = hot_daily(spark)
    train, test = splits.random_split(df, ["item_id", "invoice_date", "site"])
    assert train.count() + test.count() == df.count()
    assert 0.1 < test.count() / df.count() < 0.3
    train, test = splits.holdout_month_split(df)
    assert test.select(F.trunc("invoice_date", "month")).distinct().count() == 1
    assert train.count() + test.count() == df.count()
    daily = df.where("item_id = 'B'")
    train, test = splits.tail_split(daily, 5)
    assert test.count() == 5
    assert train.agg(F.max("invoice_date")).first()[0] < test.agg(F.min("invoice_date")).first()[0]
    folds = splits.with_fold(df, ["item_id", "invoice_date", "site"], 5)
    assert {r[0] for r in folds.select("fold").distinct().collect()} == set(range(5))


def test_augmentation_invariants(spark):
    df, _ = hot_daily(spark)
    table = features.feature_table(df).cache()
    noisy = gaussian_noise(table)
    assert noisy.count() == table.count()
    assert noisy.agg(F.min("qty")).first()[0] >= 0
    united = union_augmented(table).cache()
    counts = {r["source"]: r["count"] for r in united.groupBy("source").count().collect()}
    assert counts["original"] == counts["gaussian_noise"] == table.count()
    assert counts["interpolation"] == 300 and counts["seasonal_jitter"] == 300 and 0 < counts["rare_mix"] <= 200
    key = ["item_id", "invoice_date", "site", "qty"]
    final = augmented_table(table)
    assert table.join(final.where("source = 'original'"), key, "left_anti").count() == 0
    assert final.count() == final.dropDuplicates().count()
    # The noise scale is a deviation of doubles, whose last bits depend on the summation order.
    drawn = [*key[:-1], F.round("qty", 6).alias("qty")]
    again = union_augmented(table.repartition(3))
    assert united.select(*drawn).exceptAll(again.select(*drawn)).count() == 0


def test_interpolation_draws_all_it_can_from_a_long_tail_of_single_rows(spark):
    table = spark.range(5060).selectExpr(
        "CAST(IF(id < 60, id div 2, id) AS STRING) AS item_id", "date_add(DATE '2024-03-01', CAST(id % 2 AS INT)) AS invoice_date",
        "'S' AS site", "CAST(id AS DOUBLE) AS qty",
    )
    draw = uniform(row_key(["item_id", "invoice_date", "site"]), "interpolate-pick")
    first = table.where("qty < 60 and qty % 2 = 0").orderBy(draw).limit(10)
    assert {r.item_id for r in interpolate_rows(table, 10).collect()} == {r.item_id for r in first.collect()}
    assert interpolate_rows(table, 10).count() == 10


def test_rare_mix_needs_two_rows(spark):
    df, _ = hot_daily(spark)
    one = features.mean_features(features.date_features(df)).where("item_id = 'D'")
    assert rare_mix(one).count() == 0


def test_gap_fill_by_series_shuffles_rows_not_days(spark):
    """Rows go through one exchange and days through none; ties of a day stay, days without a date go."""
    rows = [("A", START, 1.0), ("A", START, 2.0), ("A", START + timedelta(days=400), None), ("B", None, 3.0), ("B", START, 5.0), ("C", None, 1.0)]
    filled = features.gap_fill_daily(spark.createDataFrame(rows, "item_id string, invoice_date date, qty double"), by=["item_id"])
    plan = filled.groupBy("item_id").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan
    got = sorted((r["item_id"], r["qty"]) for r in filled.where("qty > 0").collect())
    assert got == [("A", 1.0), ("A", 2.0), ("B", 5.0)]
    counts = {r["item_id"]: (r["count"], r["days"]) for r in filled.groupBy("item_id").agg(
        F.count("*").alias("count"), F.count_distinct("invoice_date").alias("days")).collect()}
    assert counts == {"A": (402, 401), "B": (1, 1)}
    assert filled.agg(F.sum("qty")).first()[0] == 8.0


def test_dedupe_of_wide_rows_shuffles_hashes_and_repeats(spark, monkeypatch):
    """Exact duplicates go, rows that share the first columns alone stay; without any repeat, rows pass no exchange."""
    rows = [(k, None if k % 3 else "a", float(k)) for k in range(20)] + [(1, None, 1.0), (1, None, 7.0), (3, "a", 3.0), (3, "a", 3.0)]
    df = spark.createDataFrame(rows, "k int, s string, v double")
    for most in (augment.MOST_ALIKE, 1):
        monkeypatch.setattr(augment, "MOST_ALIKE", most)
        got = augment.dedupe_wide(df, ["k", "s"])
        assert got.columns == df.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(set(rows), key=repr)
    single = df.where("k > 5")
    assert "Exchange" not in augment.dedupe_wide(single, ["k", "s"])._jdf.queryExecution().executedPlan().toString()


def test_augmented_table_computes_noise_once_and_writes_no_union(spark, monkeypatch):
    names = []
    monkeypatch.setattr(augment, "staged_lean", lambda df, name: (names.append(name), df.cache())[1])
    data = [("A" if i % 2 else "B", START + timedelta(days=i), "S", float(i % 7 + 1), 2.0, 2.0, 1.0, 1.0, 0, 0) for i in range(60)]
    df = spark.createDataFrame(data, "item_id string, invoice_date date, site string, qty double, qty_mean_item double, "
                               "qty_mean_item_month double, qty_lag_1 double, qty_lag_7 double, site_code int, item_code int")
    out = augment.augmented_table(df)
    assert set(names) == {"coded", "alike"}
    assert out.columns[-2:] == ["site_code", "item_code"] and "source" in out.columns
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "noise-qty_lag_1" in plan and not [x for x in plan.splitlines() if "Filter" in x and "noise-" in x]
    counts = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert counts["original"] == 60 and counts["gaussian_noise"] == 60


def test_small_dictionaries_shuffle_no_rows(spark):
    """The written dictionary's size is known, so that joining it needs no exchange of the coded rows."""
    df = spark.range(1000).selectExpr("cast(id % 7 as string) as site", "id")
    coded = encoding.label_encode(df, {"site": "site_code"})
    assert "hashpartitioning" not in coded._jdf.queryExecution().executedPlan().toString()
    assert coded.agg(F.max("site_code")).first()[0] == 6
