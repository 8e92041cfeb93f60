"""Pipelines around the fitted models: hold-out validation, full run, re-planning."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.functions.numeric import one_row
from tidestock.models.regressors import (
    HOLDOUT_SETTINGS,
    INPUTS,
    Settings,
    feature_importance,
    fit_stacking,
    predict_rows,
    train_and_evaluate,
)
from tidestock.models.store import load_model, save_model
from tidestock.operators import series
from tidestock.operators.augment import Sizes, augmented_table
from tidestock.operators.encoding import encode_with
from tidestock.operators.features import feature_table
from tidestock.operators.forecast import fitted_revenue_monthly, forecast_detail, forecast_features
from tidestock.operators.metrics import (
    compare_models,
    mape_table,
    quality_verdict,
    regression_metrics,
    revenue_gap,
)
from tidestock.operators.outliers import clean, preprocess
from tidestock.operators.splits import holdout_month_split, random_split
from tidestock.plans.planning import run_planning
from tidestock.session import staged

SPLIT_KEY = ("item_id", "invoice_date", "site")
MODEL_TYPE = "stacked_regression"


def staged_features(daily: DataFrame, method: str = "iqr", leak_free: bool = False) -> DataFrame:
    """Cleaned daily facts as a written feature table."""
    return staged(feature_table(staged(clean(daily, method=method), "clean-daily"), leak_free), "features")


def item_codes(features: DataFrame) -> DataFrame:
    return features.select("item_id", "item_code").distinct()


def model_detail(model: PipelineModel, features: DataFrame, codes: DataFrame, months: int = 12) -> DataFrame:
    """Forecast detail of a fitted model; an item without a code takes the first class."""
    future = forecast_features(features, months).join(codes, "item_id", "left").fillna(0, ["item_code"])
    return forecast_detail(predict_rows(model, future))


def holdout_predictions(
    features: DataFrame, year: int | None = None, month: int | None = None, settings: Settings = HOLDOUT_SETTINGS,
    keep_fits: bool = False,
) -> DataFrame:
    """Rows of the held-out month with predictions of a model trained on all other months.

    Item codes are learned on the training rows only; missing inputs count as 0.
    """
    train, test = holdout_month_split(features, year, month)

    def prepared(df: DataFrame) -> DataFrame:
        return encode_with(df.drop("item_code"), train, "item_id", "item_code").fillna(0, INPUTS)

    model = fit_stacking(prepared(train), settings, keep=keep_fits)
    return predict_rows(model, prepared(test)).withColumn("actual", F.col("qty"))


def holdout_validation(
    daily: DataFrame, year: int | None = None, month: int | None = None, settings: Settings = HOLDOUT_SETTINGS,
    leak_free: bool = True, keep_fits: bool = False,
) -> dict[str, DataFrame]:
    """Scores with verdict, and the revenue gap per item, of one held-out month.

    The means among the inputs are those of earlier rows, unless ``leak_free`` is off: means over the whole
    table know the held-out quantities and make every score too good. ``keep_fits`` writes each base model
    for later calls with the same rows and settings.
    """
    features = staged_features(daily, leak_free=leak_free)
    scored = staged(holdout_predictions(features, year, month, settings, keep_fits), "holdout")
    error = one_row(mape_table(scored))["mape_all"]
    scores = regression_metrics(scored).withColumn("mape", error)
    return {"scores": quality_verdict(scores), "revenue_gap": revenue_gap(scored), "rows": scored}


def series_scores(daily: DataFrame, n_test: int = series.N_TEST) -> DataFrame:
    """Back-test metrics of the time-series models on the total series, one row per model."""
    total = series.as_series(daily, by=None)
    models = {
        "arima": series.arima_forecast,
        "seasonal_trend": series.seasonal_trend_forecast,
        "recursive_lag": series.recursive_lag_forecast,
    }
    rows = None
    for name, forecast in models.items():
        part = series.model_backtest(total, forecast, n_test).drop("series_id").withColumn("model", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def full_pipeline(
    daily: DataFrame,
    bom: DataFrame,
    stock_fg: DataFrame,
    stock_comp: DataFrame,
    folder: str,
    settings: Settings = Settings(),
    months: int = 12,
    augment: Sizes | None = None,
    keep_fits: bool = False,
) -> dict[str, DataFrame]:
    """Preprocess, build features, fit and compare models, save the stacked one, forecast and plan.

    ``augment`` adds synthetic rows of these sizes to the training part only. All models, those of
    time series too, see the same treated rows. ``keep_fits`` writes each base model for later calls.
    """
    spark = daily.sparkSession
    seen = preprocess(daily, SPLIT_KEY)
    treated = staged(seen["rows"], "clean-daily")
    features = staged(feature_table(treated), "features")
    train, test = random_split(features, SPLIT_KEY)
    if augment is not None:
        enlarged = augmented_table(staged(train, "train"), augment).drop("item_code", "site_code")
        train = staged(enlarged.join(item_codes(features), "item_id"), "augmented-train")
    models, scores = train_and_evaluate(train, test, settings, keep=keep_fits)
    scores = staged(scores.unionByName(series_scores(treated)), "scores")
    best = compare_models(scores)

    stacking, codes = models["stacking"], item_codes(features)
    metrics = scores.where(F.col("model") == "stacking").first().asDict()
    save_model(
        spark, stacking, folder, MODEL_TYPE, INPUTS, {k: metrics[k] for k in ("r2", "mae", "rmse")}
    )
    codes.write.mode("overwrite").parquet(f"{folder}/item_codes")
    plan = run_planning(model_detail(stacking, features, codes, months), bom, stock_fg, stock_comp, stage=True)
    return {
        **plan,
        "describe": seen["describe"],
        "detectors": seen["detectors"],
        "scores": best,
        "importance": feature_importance(train),
        "fitted_monthly": fitted_revenue_monthly(predict_rows(stacking, features)),
    }


def replan(
    folder: str, daily: DataFrame, bom: DataFrame, stock_fg: DataFrame, stock_comp: DataFrame, months: int = 12
) -> Mapping[str, DataFrame]:
    """Plan fresh sales with a saved model; nothing is trained."""
    spark = daily.sparkSession
    model, _ = load_model(spark, folder)
    codes = spark.read.parquet(f"{folder}/item_codes")
    detail = model_detail(model, staged_features(daily), codes, months)
    return run_planning(detail, bom, stock_fg, stock_comp, stage=True)
