from dataclasses import replace
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tidestock.models import regressors, store
from tidestock.models.fits import rows_key
from tidestock.models.linear import ItemLinearModel
from tidestock.models.isolation import isolation_forest, mean_path
from tidestock.models.regressors import INPUTS, Settings
from tidestock.operators import arma, series
from tidestock.operators.seasonal import TrendsTimesSeasons, TrendTimesSeason
from tidestock.operators.unitroot import augmented_dickey_fuller, augmented_dickey_fuller_many, default_lags, p_value
from tidestock.session import new_path, staged

START = date(2022, 1, 1)
SMALL = Settings(forest_trees=5, forest_depth=5, boost_rounds=4, boost_step=0.5, deep_rounds=3, deep_depth=4, folds=3)


def frame(spark, values, name="A", keep=lambda v: True):
    rows = [(name, START + timedelta(days=i), float(v)) for i, v in enumerate(values) if keep(v)]
    return spark.createDataFrame(rows, "series_id string, invoice_date date, qty double")


def dickey_fuller(y):
    x, dy = y[:-1], np.diff(y)
    sxx = ((x - x.mean()) ** 2).sum()
    slope = ((x - x.mean()) * (dy - dy.mean())).sum() / sxx
    rest = dy - dy.mean() - slope * (x - x.mean())
    return slope / np.sqrt((rest @ rest) / (len(x) - 2) / sxx)


def test_stationarity_matches_least_squares_on_gap_filled_values(spark):
    rng = np.random.default_rng(0)
    sparse = np.where(rng.random(200) < 0.3, rng.integers(1, 9, 200), 0).astype(float)
    sparse[0] = sparse[-1] = 3.0
    walk = np.cumsum(rng.normal(0, 1, 300)) + 100
    df = frame(spark, sparse, "sparse", keep=lambda v: v != 0).union(frame(spark, walk, "walk")).union(
        frame(spark, [1.0, 2.0], "short")
    ).union(frame(spark, [4.0] * 30, "flat"))
    got = {r["series_id"]: r for r in series.stationarity(df).collect()}
    assert got["sparse"]["t_stat"] == pytest.approx(dickey_fuller(sparse), rel=1e-9)
    assert got["walk"]["t_stat"] == pytest.approx(dickey_fuller(walk), rel=1e-6)
    plain = augmented_dickey_fuller(np.flatnonzero(sparse), sparse[sparse != 0], 0, False)
    assert plain[2] == pytest.approx(dickey_fuller(sparse))
    assert (got["sparse"]["d"], got["walk"]["d"], got["short"]["d"], got["flat"]["d"]) == (0, 1, None, None)


def test_arima_follows_an_autoregression(spark):
    rng = np.random.default_rng(1)
    y = [50.0]
    for _ in range(600):
        y.append(50 + 0.8 * (y[-1] - 50) + rng.normal(0, 1))
    got = series.arima_forecast(frame(spark, y), 5).orderBy("step").collect()
    assert got[0]["qty_forecast"] == pytest.approx(50 + 0.8 * (y[-1] - 50), abs=0.8)
    assert got[0]["forecast_date"] == START + timedelta(days=len(y)) and got[0]["aic"] is not None


def test_seasonal_trend_finds_the_week(spark):
    y = [20 + 10 * (i % 7 == 0) for i in range(400)]
    got = series.seasonal_trend_forecast(frame(spark, y), 14).orderBy("step").collect()
    want = [20 + 10 * (i % 7 == 0) for i in range(400, 414)]
    assert np.allclose([r["qty_forecast"] for r in got], want, atol=1.5)
    assert all(r["qty_lower"] <= r["qty_forecast"] <= r["qty_upper"] for r in got)


def test_recursive_lag_repeats_a_cycle(spark):
    y = [float(i % 5) for i in range(200)]
    got = series.recursive_lag_forecast(frame(spark, y), 10).orderBy("step").collect()
    assert np.allclose([r["qty_forecast"] for r in got], [float(i % 5) for i in range(200, 210)], atol=0.3)


FORECASTS = [series.arima_forecast, series.seasonal_trend_forecast, series.recursive_lag_forecast]


@pytest.mark.parametrize("forecast", FORECASTS)
def test_series_without_variation_go_on_as_they_are(spark, forecast):
    df = frame(spark, [4.0] * 50, "flat").union(frame(spark, [7.0], "one"))
    got = forecast(df, 360).collect()
    assert len(got) == 720 and not any(r["fitted"] for r in got)
    assert all(r["qty_forecast"] == {"flat": 4.0, "one": 7.0}[r["series_id"]] for r in got)


@pytest.mark.parametrize("forecast", FORECASTS)
def test_short_and_rough_series_are_fitted_and_stay_in_bounds(spark, forecast):
    rng = np.random.default_rng(8)
    df = frame(spark, [2.0, 4.0, 6.0], "short")
    for k in range(25):
        n = int(rng.integers(2, 400))
        y = np.where(rng.random(n) < rng.uniform(0.01, 1), rng.integers(1, 98, n), 0).astype(float)
        y[0] = 97.0
        y[-1] = 1.0
        df = df.union(frame(spark, y, f"s{k}"))
    got = forecast(df, 360).toPandas()
    assert got["series_id"].nunique() == 26 and got["fitted"].all()
    assert np.isfinite(got["qty_forecast"]).all() and got["qty_forecast"].between(0, 5 * 97).all()


def test_weights_that_fade():
    got = arma.fading(np.array([[1.5, 0.6, -0.1], [0.5, 0.1, 0.0], [0.6, 0.6, 0.6]]))
    for row in got:
        assert np.abs(np.roots([1, *-row])).max() <= arma.FADE + 1e-9
    assert (got[1] == [0.5, 0.1, 0.0]).all()
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 40):
        assert np.abs(np.roots([1, *-arma.yule_walker(rng.normal(0, 1, (1, n)), 10)[0]])).max() < 1 + 1e-9


def augmented(y, lags=None, choose=True):
    """The test by least squares on all columns."""
    change, most = np.diff(y), default_lags(len(y)) if lags is None else min(lags, len(y) // 2 - 2)

    def fit(p, start):
        t = np.arange(start, len(change))
        x = np.column_stack([np.ones(len(t)), y[t], *[change[t - k] for k in range(1, p + 1)]])
        weights = np.linalg.lstsq(x, change[t], rcond=None)[0]
        rest = change[t] - x @ weights
        return len(t), weights, rest @ rest, x

    used = most
    if choose:
        used = int(np.argmin([n * np.log(sse / n) + 2 * p for p in range(most + 1) for n, _, sse, _ in [fit(p, most)]]))
    n, weights, sse, x = fit(used, used)
    return n, used, weights[1] / np.sqrt(sse / (n - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])


@pytest.mark.parametrize("lags, choose", [(None, True), (0, False), (1, False), (5, True), (12, False)])
def test_augmented_stationarity_matches_least_squares(spark, lags, choose):
    rng = np.random.default_rng(9)
    data = {f"walk{n}": np.cumsum(rng.normal(0, 1, n)) for n in (12, 60, 400)}
    data |= {f"wave{n}": 20 + 5 * np.sin(np.arange(n)) + rng.normal(0, 1, n) for n in (9, 150)}
    data["sparse"] = np.where(rng.random(900) < 0.1, rng.integers(1, 50, 900), 0).astype(float)
    data["sparse"][[0, -1]] = 7.0
    df = None
    for name, y in data.items():
        part = frame(spark, y, name, keep=lambda v: v != 0)
        df = part if df is None else df.union(part)
    df = df.union(frame(spark, [1.0, 2.0, 4.0], "short")).union(frame(spark, [4.0] * 30, "flat"))
    got = {r["series_id"]: r for r in series.augmented_stationarity(df, lags, choose).collect()}
    assert len(got) == len(data) + 2
    for name, y in data.items():
        r = got[name]
        n, used, statistic = augmented(y, lags, choose)
        assert (r["n_changes"], r["lags"]) == (n, used), name
        assert r["t_stat"] == pytest.approx(statistic, rel=1e-6)
        assert r["p_value"] == pytest.approx(p_value(statistic)) and r["d"] == int(r["p_value"] >= 0.05)
    assert got["short"]["t_stat"] is got["flat"]["t_stat"] is got["flat"]["d"] is None


def test_p_values_of_known_statistics():
    for statistic, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert p_value(statistic) == pytest.approx(p, rel=0.03)
    assert (p_value(-30.0), p_value(3.0)) == (0.0, 1.0) and p_value(-1.62) == pytest.approx(p_value(-1.60), rel=0.05)


def simulated(ar, ma, n, days, seed):
    rng = np.random.default_rng(seed)
    shocks, y = rng.normal(0, 1, (n, days + 50)), np.zeros((n, days + 50))
    for t in range(5, days + 50):
        y[:, t] = shocks[:, t] + sum(w * y[:, t - 1 - k] for k, w in enumerate(ar)) + sum(w * shocks[:, t - 1 - k] for k, w in enumerate(ma))
    return y[:, 50:]


def responses(ar, ma, steps=8):
    """What a shock of 1 adds to the values after it."""
    out = [1.0]
    for t in range(1, steps):
        out.append((ma[t - 1] if t <= len(ma) else 0.0) + sum(w * out[t - 1 - k] for k, w in enumerate(ar) if k < t))
    return np.array(out)


def test_arma_fit_lowers_the_error_and_finds_the_process():
    ar, ma = np.array([0.6, -0.3, 0.1, 0.0, 0.1]), np.array([0.5, 0.2])
    y = simulated(ar, ma, 12, 6000, 3)
    length = np.full(len(y), y.shape[1])
    weights, shocks, error = arma.fit(y, length)
    start = (arma.shocks_of(y, arma.start_weights(y, length)) ** 2).sum(axis=1)
    true = (arma.shocks_of(y, np.tile(np.r_[ar, ma], (len(y), 1))) ** 2).sum(axis=1)
    assert (error <= start).all() and (error <= true * (1 + 1e-4)).all()
    assert np.allclose((shocks**2).sum(axis=1), error)
    for row in weights:
        assert np.allclose(responses(row[:5], row[5:]), responses(ar, ma), atol=0.06)


def test_arma_batches_do_not_mix_series():
    """A series gives the same forecast alone and beside longer ones; rough ones end, too."""
    rng = np.random.default_rng(4)
    parts = [rng.normal(0, 1, n).cumsum() for n in (3, 1, 40, 200)]
    parts.append(np.where(rng.random(300) < 0.05, 9.0, 0.0))
    matrix, length = series._aligned(parts)
    together, aic = arma.paths(matrix, length, 20)
    for k, y in enumerate(parts):
        alone, own = arma.paths(y[None, :], np.array([len(y)]), 20)
        assert np.allclose(alone[0], together[k], rtol=1e-5, atol=1e-6) and own[0] == pytest.approx(aic[k], rel=1e-6, abs=1e-4)
    weights, _, error = arma.fit(matrix, length)
    assert (error <= (arma.shocks_of(matrix, arma.start_weights(matrix, length)) ** 2).sum(axis=1)).all()
    for row in weights:
        assert max(np.abs(np.roots([1, *-row[:5]])).max(), np.abs(np.roots([1, *row[5:]])).max()) <= arma.FADE + 1e-9


def test_trend_times_season_is_exact_without_noise():
    days = np.arange(10_000, 11_500)
    true = lambda d: (50 + 0.03 * (d - 10_000)) * (1 + 0.4 * np.sin(2 * np.pi * d / 365.25) + 0.2 * np.cos(2 * np.pi * d / 7))
    model, ahead = TrendTimesSeason(days, true(days), 1500.0), np.arange(11_500, 11_860)
    assert np.abs(model.at(ahead) - true(ahead)).max() < 1e-4 and model.spread < 1e-4
    rng = np.random.default_rng(7)
    gaps = np.sort(rng.choice(days, 700, replace=False))
    assert np.abs(TrendTimesSeason(gaps, true(gaps), 1500.0).at(ahead) - true(ahead)).max() < 1e-2


def test_trend_times_season_never_raises_its_error():
    rng = np.random.default_rng(8)
    for n in (2, 3, 10, 40, 300):
        days = np.sort(rng.choice(1500, n, replace=False)) + 9_000
        model = TrendTimesSeason(days, rng.integers(1, 98, n).astype(float), 1500.0)
        assert (np.diff(model.errors) <= 1e-9 * model.errors[0]).all() and np.isfinite(model.at(days)).all()


@pytest.mark.parametrize("level", [0.0, 1e2, 1e6, 1e8])
def test_stationarity_keeps_its_digits(spark, level):
    y = np.random.default_rng(6).normal(0, 1, 300) + level
    got = series.stationarity(frame(spark, y)).first()["t_stat"]
    # the values themselves carry rounding of 1e-16 times the level, which no computation can undo
    assert got == pytest.approx(dickey_fuller(y - level), rel=max(1e-9, 1e-15 * level))
    assert got == pytest.approx(augmented_dickey_fuller(np.arange(300), y, 0, False)[2], rel=1e-6)


def test_naive_backtest_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    y = np.where(rng.random(90) < 0.5, rng.integers(1, 9, 90), 0).astype(float)
    y[0] = y[-1] = 5.0
    got = series.naive_backtest(frame(spark, y, keep=lambda v: v != 0)).first()
    actual, repeat = y[-30:], np.array([y[60 - 7 + j % 7] for j in range(30)])
    assert got["mae"] == pytest.approx(np.abs(actual - repeat).mean())
    assert got["r2"] == pytest.approx(1 - ((actual - repeat) ** 2).sum() / ((actual - actual.mean()) ** 2).sum())
    short = series.naive_backtest(frame(spark, [1.0] * 5)).first()
    assert (short["n_rows"], short["mae"]) == (30, 5 / 30)


def test_model_backtest_scores_every_test_day(spark):
    y = [float(i % 5) for i in range(200)]
    sparse = frame(spark, y, keep=lambda v: v != 0)
    got = series.model_backtest(sparse, series.recursive_lag_forecast, 30).first()
    assert got["n_rows"] == 30 and got["r2"] > 0.9
    late = series.model_backtest(frame(spark, [3.0] * 6), series.arima_forecast, 30).first()
    assert (late["n_rows"], late["mae"]) == (30, 18 / 30)


def test_isolation_forest_flags_the_extremes(spark):
    rng = np.random.default_rng(3)
    values = list(rng.normal(50, 5, 1900)) + list(rng.uniform(200, 400, 50)) + [-100.0]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id long, qty double")
    got = isolation_forest(df, "qty", ["id"])
    flagged = got.where("anomaly = -1")
    share = flagged.count() / len(values)
    assert 0.03 <= share <= 0.051
    assert flagged.where("qty >= 200 or qty < 0").count() >= 45
    again = isolation_forest(df.repartition(9), "qty", ["id"]).where("anomaly = -1")
    assert flagged.select("id").exceptAll(again.select("id")).count() == 0
    cut = float(np.quantile([r["score"] for r in got.collect()], 0.95))
    assert flagged.agg(F.min("score")).first()[0] > cut >= got.where("anomaly = 1").agg(F.max("score")).first()[0]
    odd = spark.createDataFrame([(1, None), (2, 5.0), (3, 5.0)], "id long, qty double")
    assert {(r["id"], r["score"] is None) for r in isolation_forest(odd, "qty", ["id"]).collect()} == {(1, True), (2, False), (3, False)}
    assert isolation_forest(odd.limit(0), "qty", ["id"]).count() == 0


def test_mean_path_of_small_trees():
    assert (mean_path(1), mean_path(2)) == (0.0, 1.0)
    assert mean_path(256) == pytest.approx(10.24, abs=0.01)


def model_rows(spark, n=600):
    rng = np.random.default_rng(4)
    data = pd.DataFrame({c: rng.integers(0, 10, n).astype(float) for c in INPUTS})
    data["item_code"] = rng.integers(0, 4, n)
    data["item_id"] = data["item_code"].map(lambda c: f"I{c}")
    data["site"], data["invoice_date"] = "S", [START + timedelta(days=i) for i in range(n)]
    data["qty"] = 5 * data["qty_mean_item"] + 2 * data["qty_lag_1"] + rng.normal(0, 1, n) + 10
    return spark.createDataFrame(data)


def test_every_model_beats_the_mean(spark):
    rows = staged(model_rows(spark), "rows")
    train, test = rows.where("invoice_date < date'2023-04-01'"), rows.where("invoice_date >= date'2023-04-01'")
    models, scores = regressors.train_and_evaluate(train, test, SMALL)
    got = {r["model"]: r["r2"] for r in scores.collect()}
    assert set(got) == {"linear", "random_forest", "gbt", "gbt_deep", "stacking"}
    assert all(r2 > 0.3 for r2 in got.values()) and got["linear"] > 0.98
    folder = new_path(spark, "model")
    with pytest.raises(FileNotFoundError):
        store.load_model(spark, folder)
    store.save_model(spark, models["stacking"], folder, "stacked", INPUTS, {"r2": got["stacking"]})
    store.save_model(spark, models["stacking"], folder, "stacked", INPUTS, {"r2": 0.5})
    again, meta = store.load_model(spark, folder)
    assert meta.first()["metrics"] == {"r2": 0.5} and meta.first()["features"] == INPUTS
    left = regressors.predict_rows(models["stacking"], test).select("invoice_date", "prediction")
    right = regressors.predict_rows(again, test).select("invoice_date", "prediction")
    assert left.exceptAll(right).count() == 0
    assert left.agg(F.min("prediction")).first()[0] >= 0


@pytest.mark.parametrize("scale", [False, True])
def test_ridge_equals_closed_form(spark, scale):
    rng = np.random.default_rng(6)
    x = rng.normal(0, [1.0, 4.0, 0.3], (200, 3)) + 7
    y = x @ [2.0, -1.0, 5.0] + rng.normal(0, 2, 200) + 30
    rows = [(float(t), Vectors.dense(v)) for t, v in zip(y, x, strict=True)]
    model = regressors.fit_ridge(spark.createDataFrame(rows, ["qty", "meta_features"]), 40.0, scale)
    spread = x.std(axis=0, ddof=1) if scale else np.ones(3)
    centered = (x - x.mean(axis=0)) / spread
    want = np.linalg.solve(centered.T @ centered + 40.0 * np.eye(3), centered.T @ (y - y.mean())) / spread
    assert np.allclose(model.coefficients.toArray(), want, rtol=5e-3)


def test_models_do_not_depend_on_partitioning(spark):
    rows = staged(model_rows(spark, 300), "rows")
    one = regressors.predict_rows(regressors.fit_single("random_forest", rows, SMALL), rows)
    two = regressors.predict_rows(regressors.fit_single("random_forest", rows.repartition(7), SMALL), rows)
    assert one.select("invoice_date", "prediction").exceptAll(two.select("invoice_date", "prediction")).count() == 0


def test_linear_model_equals_dummy_regression(spark):
    rows = model_rows(spark, 300)
    data = rows.toPandas()
    model = regressors.fit_linear(rows)
    dummies = pd.get_dummies(data["item_id"]).to_numpy(float)
    x = np.hstack([data[regressors.NUMERIC_INPUTS].to_numpy(float), dummies])
    want = x @ np.linalg.lstsq(x, data["qty"].to_numpy(), rcond=None)[0]
    got = model.transform(rows).select("invoice_date", "raw_prediction").toPandas().sort_values("invoice_date")
    assert np.allclose(got["raw_prediction"], want[np.argsort(data["invoice_date"])])
    folder = new_path(spark, "linear")
    model.save(folder)
    again = ItemLinearModel.load(folder)
    unseen = rows.limit(1).withColumn("item_id", F.lit("new"))
    assert again.transform(unseen).first()["raw_prediction"] == pytest.approx(model.transform(unseen).first()["raw_prediction"])


def test_linear_model_is_a_pipeline_stage(spark):
    rows = staged(model_rows(spark, 200), "rows")
    model = PipelineModel([regressors.fit_linear(rows)])
    folder = new_path(spark, "model")
    store.save_model(spark, model, folder, "linear", INPUTS, {"r2": 1.0})
    again, _ = store.load_model(spark, folder)
    key = ["invoice_date", "raw_prediction"]
    assert isinstance(again.stages[0], ItemLinearModel)
    assert sorted(map(tuple, again.transform(rows).select(*key).collect())) == sorted(map(tuple, model.transform(rows).select(*key).collect()))


def test_kept_fits_are_found_again(spark, monkeypatch):
    vectors = regressors.training_vectors(model_rows(spark, 120), "qty")
    first = regressors.fit_base("gbt", vectors, SMALL, keep=True)
    reordered = staged(vectors.orderBy(F.rand(3)), "reordered")
    with monkeypatch.context() as patched:
        patched.setattr(GBTRegressor, "fit", lambda *_: pytest.fail("fitted again"))
        again = regressors.fit_base("gbt", reordered, SMALL, keep=True)
    assert again.toDebugString == first.toDebugString
    deeper = regressors.fit_base("gbt", vectors, replace(SMALL, boost_depth=2), keep=True)
    assert deeper.toDebugString != first.toDebugString
    fewer = staged(vectors.limit(60), "fewer")
    assert rows_key(fewer) != rows_key(vectors) and rows_key(reordered) == rows_key(vectors)


def test_forests_may_use_all_inputs():
    forest = regressors.base_estimators(Settings())["random_forest"]
    assert forest.getFeatureSubsetStrategy() == "all" and forest.getMaxBins() == Settings.max_bins


def test_out_of_fold_covers_each_row_once(spark):
    rows = model_rows(spark, 200)
    vectors = regressors.training_vectors(
        regressors.with_fold(rows, regressors.ROW_KEY, SMALL.folds), "qty", extra=["fold", "invoice_date"]
    )
    scored = regressors.out_of_fold(vectors, SMALL)
    assert scored.count() == 200 and scored.select("invoice_date").distinct().count() == 200


def test_feature_importance_sums_to_one(spark):
    got = regressors.feature_importance(model_rows(spark)).collect()
    assert sum(r["importance"] for r in got) == pytest.approx(1.0)
    assert got[0]["feature"] == "qty_mean_item"


def test_contract_counts_rows_above_the_bound_and_shuffles_no_forecasts(spark):
    """A forecaster that is too high, negative, NaN or repeats steps shows; the rows themselves pass no exchange."""
    from checks import q_series

    items = frame(spark, [1.0, 2.0, 3.0]).unionByName(frame(spark, [4.0, 4.0], "B")).unionByName(frame(spark, [1.0], "C"))
    plans = []

    def forecast(rows, steps):
        ahead = series.future_days(rows, steps).withColumn("step", F.when(F.expr("series_id = 'C' and step = 360"), 359).otherwise(F.col("step")))
        value = F.expr("case when series_id = 'A' and step <= 10 then 15.5 when series_id = 'B' and step = 1 then -1.0 "
                       "when series_id = 'B' and step = 2 then double('nan') else 1.0 end")
        plans.append(ahead.select("*", value.alias("qty_forecast")))
        return plans[-1]

    got = {r["series_id"]: (r["n_rows"], r["n_steps"], r["n_good"]) for r in q_series.forecast_contract(items, forecast).collect()}
    assert got == {"A": (360, 360, 350), "B": (360, 360, 358), "C": (360, 359, 360)}
    assert len(plans) == 2 and plans[1].select("series_id").distinct().count() == 1
    steps = plans[0].groupBy("series_id").agg(q_series._distinct_steps())._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in steps and "gid" not in steps
    assert steps.count("partial_bit_or") >= 6


def test_many_series_are_fitted_as_each_alone(spark):
    """Seasons, lags and unit roots of a batch are those of one series at a time."""
    rng = np.random.default_rng(11)
    rows = []
    for n in (2, 3, 9, 30, 200, 900):
        days = np.sort(rng.choice(1500, n, replace=False)) + 9_000
        rows.append((days, rng.integers(1, 98, n).astype(float)))
    together = TrendsTimesSeasons([d for d, _ in rows], [y for _, y in rows], np.full(len(rows), 1500.0))
    ahead = np.arange(10_500, 10_530)
    for k, (days, y) in enumerate(rows):
        alone = TrendTimesSeason(days, y, 1500.0)
        assert np.allclose(alone.at(ahead), together.at(np.tile(ahead, (len(rows), 1)))[k]) and alone.spread == pytest.approx(together.spread[k])
    assert augmented_dickey_fuller_many(rows) == [
        None if one is None else (*one[:2], pytest.approx(one[2]), pytest.approx(one[3])) for one in (augmented_dickey_fuller(*r) for r in rows)
    ]
    width, penalty = 5, np.array([0.3, 0.2])
    y = np.concatenate([np.zeros((2, width)), rng.normal(size=(2, 40))], axis=1)
    y[1, :30] = 0.0
    for values, weights, own in zip(y, series.lag_fits(y, width, penalty), penalty):
        x = np.lib.stride_tricks.sliding_window_view(values[:-1], width)[:, ::-1]
        assert np.allclose(weights, np.linalg.solve(x.T @ x + own * np.eye(width), x.T @ values[width:]))
    parts = list(series._alike(np.array([0, 2, 3]), np.array([5, 9, 1, 400]), 10))
    assert [p.tolist() for p in parts] == [[2, 0], [3]]


def test_model_backtest_lays_out_days_after_the_exchange(spark):
    """No join by day: a series' days and path meet as a row each."""
    values = frame(spark, [3.0, 1.0] * 30).unionByName(frame(spark, [2.0], "B"))
    plan = series.model_backtest(values, series.recursive_lag_forecast, 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") + plan.count("ShuffledHashJoin") == 1
    assert plan.index("Generate explode") < plan.index("Join")
    got = {r["series_id"]: r["n_rows"] for r in series.model_backtest(values, series.recursive_lag_forecast, 10).collect()}
    assert got == {"A": 10, "B": 10}
