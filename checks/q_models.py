"""Fitted models and the pipelines around them, at their full sizes.

Fitting is what takes the time: each model is fitted by the first query that needs it, alone, and written; later
queries, also of another session with the same shared folder, load it.
"""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from checks.q_features import feature_rows
from checks.registry import query
from checks.testbed import Testbed
from tidestock.models import regressors, store
from tidestock.models.regressors import Settings
from tidestock.operators import metrics, splits
from tidestock.operators.augment import Sizes
from tidestock.plans import modelling
from tidestock.session import new_path, staged

SPLIT_KEY = ["item_id", "invoice_date", "site"]
MODELS = ["linear", "random_forest", "gbt", "gbt_deep", "stacking"]
_SHARED: dict = {}


def _shared(t: Testbed, name: str, build):
    """What ``build`` made the first time in this session for this folder."""
    key = (t.spark.sparkContext.applicationId, t.folder, name)
    if key not in _SHARED:
        _SHARED[key] = build()
    return _SHARED[key]


def _split(t: Testbed):
    rows = _shared(t, "features", lambda: staged(feature_rows(t), "features"))
    return splits.random_split(rows, SPLIT_KEY)


def _vectors(t: Testbed):
    keyed = splits.with_fold(_split(t)[0], SPLIT_KEY, Settings.folds)
    return _shared(t, "vectors", lambda: regressors.training_vectors(keyed, "qty", extra=["fold", *SPLIT_KEY]))


def _out_of_fold(t: Testbed):
    return _shared(t, "out-of-fold", lambda: staged(
        regressors.out_of_fold(_vectors(t), keep=True).select("qty", *SPLIT_KEY, "p_random_forest", "p_gbt", "p_gbt_deep"), "out-of-fold"
    ))


def _base(t: Testbed, name: str):
    return _shared(t, f"base-{name}", lambda: regressors.fit_base(name, _vectors(t), keep=True))


def _linear(t: Testbed):
    return _shared(t, "linear", lambda: regressors.fit_linear(_split(t)[0]))


def _stacking(t: Testbed):
    return _shared(t, "stacking", lambda: regressors.stack(
        _vectors(t), regressors.fit_bases(_vectors(t), keep=True), scored=_out_of_fold(t)
    ))


def _model(t: Testbed, name: str):
    if name in ("linear", "stacking"):
        return _linear(t) if name == "linear" else _stacking(t)
    return regressors.as_pipeline(_base(t, name))


def _scored(t: Testbed):
    """Predictions of all models on the test rows, written once."""
    return _shared(t, "scored", lambda: staged(
        regressors.scored_rows({name: _model(t, name) for name in MODELS}, _split(t)[1]).select("model", *SPLIT_KEY, "actual", "prediction"), "scored"
    ))


def _scores(name: str):
    def build(t: Testbed):
        scored = regressors.predict_rows(_model(t, name), _split(t)[1])
        return metrics.regression_metrics(scored.withColumn("actual", F.col("qty")))

    return build


_U = "('0x' || substr(md5(item_id || '|' || invoice_date || '|' || site || '-split-42'), 1, 13))::BIGINT / 4503599627370496.0"
_TEST_ROWS = f"FROM t_features WHERE {_U} < 0.2"

for _name in MODELS:
    query(f"model_{_name}")(_scores(_name))

_NAMES = ", ".join(f"('{name}')" for name in MODELS)


@query(
    "model_checks",
    f"""SELECT model, n_rows, round(actual, 4) AS actual, true AS is_consistent, true AS is_floored
        FROM (SELECT count(*) AS n_rows, sum(qty) AS actual {_TEST_ROWS}), (VALUES {_NAMES}) m(model)""",
    {"actual": 4},
)
def model_checks(t: Testbed):
    """Every model scores the same test rows; its metrics equal those of its predictions, taken another way."""
    rows = _scored(t)
    error = F.col("actual") - F.col("prediction")
    again = rows.groupBy("model").agg(
        F.count("*").alias("n_rows"), F.sum("actual").alias("actual"), F.min("prediction").alias("least"),
        F.avg(F.abs(error)).alias("own_mae"), F.sqrt(F.avg(error * error)).alias("own_rmse"),
        (1 - F.sum(error * error) / (F.var_pop("actual") * F.count("*"))).alias("own_r2"),
    )
    scores = metrics.regression_metrics(rows, ["model"]).drop("n_rows")
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 1e-6 * (1 + F.abs(F.col(b)))
    good = near("mae", "own_mae") & near("rmse", "own_rmse") & near("r2", "own_r2") & (F.col("mae") <= F.col("rmse")) & (F.col("r2") <= 1)
    return again.join(scores, "model").select(
        "model", "n_rows", "actual", good.alias("is_consistent"), (F.col("least") >= 0).alias("is_floored")
    )


@query(
    "linear_residuals",
    f"""SELECT item_id, count(*) AS n_rows, 0.0::DOUBLE AS residual FROM t_features WHERE NOT {_U} < 0.2 GROUP BY item_id""",
    {"residual": 4},
)
def linear_residuals(t: Testbed):
    """Least squares with item effects leaves residuals that sum to 0 for every item."""
    train, _ = _split(t)
    fitted = _linear(t).transform(train)
    rest = F.sum(F.col("qty") - F.col("raw_prediction"))
    return fitted.groupBy("item_id").agg(F.count("*").alias("n_rows"), rest.alias("residual")).withColumn(
        "residual", F.col("residual") + 0.0
    )


_INPUT_ROWS = ", ".join(f"('{c}')" for c in regressors.NUMERIC_INPUTS)


@query("linear_orthogonal", f"SELECT input, 0.0::DOUBLE AS correlation FROM (VALUES {_INPUT_ROWS}) i(input)", {"correlation": 6})
def linear_orthogonal(t: Testbed):
    """... and that are orthogonal to every input."""
    train, _ = _split(t)
    fitted = _linear(t).transform(train).withColumn("rest", F.col("qty") - F.col("raw_prediction"))
    parts = [
        F.struct(F.lit(c).alias("input"), (F.sum(F.col(c) * F.col("rest")) / F.sqrt(F.sum(F.col(c) * F.col(c)) * F.sum(F.col("qty") * F.col("qty")))).alias("correlation"))
        for c in regressors.NUMERIC_INPUTS
    ]
    return fitted.agg(F.array(*parts).alias("parts")).select(F.explode("parts").alias("p")).select("p.*").withColumn(
        "correlation", F.abs(F.round("correlation", 6))
    )


@query("out_of_fold_rows", f"SELECT item_id, invoice_date, site, 1 AS times FROM t_features WHERE NOT {_U} < 0.2")
def out_of_fold_rows(t: Testbed):
    return _out_of_fold(t).groupBy(*SPLIT_KEY).agg(F.count("p_gbt_deep").cast("int").alias("times"))


@query(
    "feature_importance",
    f"SELECT feature, true AS is_share, 1.0::DOUBLE AS total FROM (VALUES {_INPUT_ROWS}) i(feature)",
    {"total": 6},
)
def feature_importance(t: Testbed):
    weights = staged(regressors.feature_importance(_split(t)[0]), "importance")
    whole = weights.agg(F.sum("importance")).first()[0]
    return weights.select("feature", F.col("importance").between(0, 1).alias("is_share"), F.lit(float(whole)).alias("total"))


@query("feature_importance_rows")
def feature_importance_rows(t: Testbed):
    return regressors.feature_importance(_split(t)[0])


@query("train_and_evaluate")
def train_and_evaluate(t: Testbed):
    return metrics.regression_metrics(_scored(t), ["model"])


@query("predicted_row_check", f"SELECT item_id, invoice_date, site, qty, 1 AS is_floored {_TEST_ROWS}")
def predicted_row_check(t: Testbed):
    _, test = _split(t)
    floored = (F.col("prediction") >= 0).cast("int").alias("is_floored")
    return regressors.predict_rows(_model(t, "random_forest"), test).select(*SPLIT_KEY, "qty", floored)


@query("predict_rows")
def predict_rows(t: Testbed):
    return regressors.predict_rows(_model(t, "random_forest"), _split(t)[1]).select(*SPLIT_KEY, "qty", "prediction")


def _reloaded(t: Testbed, model: PipelineModel, name: str):
    """Test rows and whether the saved and reloaded pipeline predicts the same."""
    _, test = _split(t)
    folder = new_path(t.spark, "model")
    store.save_model(t.spark, model, folder, name, regressors.INPUTS, {"r2": 0.0})
    again, _ = store.load_model(t.spark, folder)
    before = regressors.predict_rows(model, test).select(*SPLIT_KEY, "prediction")
    after = regressors.predict_rows(again, test).select(*SPLIT_KEY, F.col("prediction").alias("reloaded"))
    same = (F.col("prediction") == F.col("reloaded")).cast("int").alias("is_equal")
    return before.join(after, SPLIT_KEY).select(*SPLIT_KEY, same)


_SAME = f"SELECT item_id, invoice_date, site, 1 AS is_equal {_TEST_ROWS}"


@query("model_save_load", _SAME)
def model_save_load(t: Testbed):
    return _reloaded(t, _stacking(t), "stacking")


@query("model_save_load_linear", _SAME)
def model_save_load_linear(t: Testbed):
    """The item-effect model as a stage of a pipeline."""
    return _reloaded(t, PipelineModel([_linear(t)]), "linear")


@query("model_save_load_forest", _SAME)
def model_save_load_forest(t: Testbed):
    return _reloaded(t, _model(t, "random_forest"), "random_forest")


def _holdout(t: Testbed):
    return _shared(t, "holdout", lambda: modelling.holdout_validation(t.daily_table(), keep_fits=True))


@query("holdout_validation")
def holdout_validation(t: Testbed):
    return _holdout(t)["scores"]


_CLEAN = "SELECT s.* FROM t_daily s, (SELECT quantile_cont(qty, 0.25) AS q1, quantile_cont(qty, 0.75) AS q3 FROM t_daily) WHERE qty BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"


@query(
    "holdout_rows",
    f"""SELECT item_id, invoice_date, site, qty AS actual, 1 AS is_floored
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY invoice_date, site) AS place FROM ({_CLEAN}))
        WHERE place > 7 AND last_price IS NOT NULL AND date_trunc('month', invoice_date) = (SELECT date_trunc('month', max(invoice_date)) FROM ({_CLEAN}))""",
)
def holdout_rows(t: Testbed):
    floored = (F.col("prediction") >= 0).cast("int").alias("is_floored")
    return _holdout(t)["rows"].select(*SPLIT_KEY, "actual", floored)


@query("series_model_scores")
def series_model_scores(t: Testbed):
    return metrics.compare_models(modelling.series_scores(t.daily_table()))


def _run(t: Testbed, augment: Sizes | None = None):
    """(folder, tables) of a full run."""
    def build():
        folder = new_path(t.spark, "run")
        return folder, modelling.full_pipeline(
            t.daily_table(), t.bom(), t.stock_fg(), t.stock_comp(), folder, augment=augment, keep_fits=True
        )

    return _shared(t, f"run-{augment}", build)


def _plan_checks(plan):
    """Both plan tables: what is exact whatever the forecast is."""
    parts = None
    for kind in ("fg", "comp"):
        rows = plan[f"final_stock_{kind}"]
        short = F.col("requirement") - F.col("qty_on_hand")
        left = F.col("qty_on_hand") + F.col("purchase") - F.col("requirement")
        near = lambda a, b: F.abs(a - b) <= 1e-6 * (1 + F.abs(b))
        part = rows.select(
            F.lit(kind).alias("kind"), "item_id", F.round("qty_on_hand", 6).alias("qty_on_hand"), "label",
            near(F.col("purchase"), F.greatest(short, F.lit(0.0))).alias("is_net"),
            near(F.col("final_stock"), F.greatest(left, F.lit(0.0))).alias("is_left"),
            (F.col("requirement") >= 0).alias("is_needed"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


_ITEMS = f"""SELECT DISTINCT item_id FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY invoice_date, site) AS place FROM ({_CLEAN}))
             WHERE place > 7 AND last_price IS NOT NULL"""
_PLAN_SQL = f"""
SELECT 'fg' AS kind, i.item_id, coalesce(s.qty_on_hand, 0.0) AS qty_on_hand, s.label, true AS is_net, true AS is_left, true AS is_needed
FROM ({_ITEMS}) i LEFT JOIN t_stock_fg s ON s.item_id = i.item_id
UNION ALL
SELECT 'comp', b.component, coalesce(s.qty_on_hand, 0.0), s.label, true, true, true
FROM (SELECT DISTINCT component FROM t_bom WHERE fg_item IN ({_ITEMS})) b LEFT JOIN t_stock_comp s ON s.item_id = b.component"""


@query("full_pipeline")
def full_pipeline(t: Testbed):
    return _run(t)[1]["final_stock_fg"]


@query("full_pipeline_plan", _PLAN_SQL)
def full_pipeline_plan(t: Testbed):
    return _plan_checks(_run(t)[1])


@query("full_pipeline_augmented_scores")
def full_pipeline_augmented_scores(t: Testbed):
    return _run(t, Sizes())[1]["scores"]


@query("replan_with_saved_model", _PLAN_SQL)
def replan_with_saved_model(t: Testbed):
    """Nothing is trained: the model saved by the full run plans the same sales again."""
    return _plan_checks(modelling.replan(_run(t)[0], t.daily_table(), t.bom(), t.stock_fg(), t.stock_comp()))


@query("replan_rows")
def replan_rows(t: Testbed):
    return modelling.replan(_run(t)[0], t.daily_table(), t.bom(), t.stock_fg(), t.stock_comp())["final_stock_comp"]
