"""Single regressors, the stacked model and their evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.functions.numeric import floor_zero
from tidestock.models.fits import Job, fit_all, fitted, rows_key
from tidestock.models.linear import ItemLinearModel, fit_item_linear
from tidestock.operators.features import FEATURES
from tidestock.operators.metrics import regression_metrics
from tidestock.operators.splits import with_fold
from tidestock.session import staged

# Model inputs (the item enters as its label code) and default settings.
INPUTS = ["item_code" if c == "item_id" else c for c in FEATURES]
NUMERIC_INPUTS = [c for c in INPUTS if c != "item_code"]
ROW_KEY = ("item_id", "invoice_date", "site")
SEED = 42
IMPORTANCE_DEPTH = 5


@dataclass(frozen=True)
class Settings:
    """Sizes of the ensemble models.

    The depth of the forest is bounded because trees are held in memory; ``max_bins`` is how many
    ranges of an input, such as the item code, a split can tell apart. ``parallelism`` models are
    fitted at a time.
    """

    forest_trees: int = 100
    forest_depth: int = 12
    boost_rounds: int = 100
    boost_depth: int = 3
    boost_step: float = 0.1
    deep_rounds: int = 100
    deep_depth: int = 6
    deep_step: float = 0.3
    folds: int = 5
    ridge_alpha: float = 1.0
    scale_meta: bool = True
    max_bins: int = 128
    parallelism: int = 8


HOLDOUT_SETTINGS = Settings(
    forest_trees=200, boost_rounds=200, boost_step=0.05, deep_rounds=300, deep_step=0.05, scale_meta=False
)


def assembler(inputs: Sequence[str] = tuple(INPUTS)) -> VectorAssembler:
    return VectorAssembler(inputCols=list(inputs), outputCol="features")


def base_estimators(s: Settings, label: str = "qty") -> dict[str, object]:
    """Forest, shallow boosting and deep boosting, keyed by model name."""
    forest = RandomForestRegressor(
        labelCol=label, numTrees=s.forest_trees, maxDepth=s.forest_depth, seed=SEED, maxBins=s.max_bins,
        featureSubsetStrategy="all",
    )
    shallow = GBTRegressor(
        labelCol=label, maxIter=s.boost_rounds, maxDepth=s.boost_depth, stepSize=s.boost_step, seed=SEED,
        maxBins=s.max_bins,
    )
    deep = GBTRegressor(
        labelCol=label, maxIter=s.deep_rounds, maxDepth=s.deep_depth, stepSize=s.deep_step, seed=SEED,
        maxBins=s.max_bins,
    )
    models = {"random_forest": forest, "gbt": shallow, "gbt_deep": deep}
    for name, model in models.items():
        model.setPredictionCol(f"p_{name}")
    return models


def fit_linear(train: DataFrame, label: str = "qty") -> ItemLinearModel:
    """Least squares on the numeric inputs with an effect for each item."""
    return fit_item_linear(train, NUMERIC_INPUTS, label)


def _with_prediction(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("prediction", floor_zero(F.col(column)))


def training_vectors(
    train: DataFrame, label: str, key: Sequence[str] = ROW_KEY, extra: Sequence[str] = ()
) -> DataFrame:
    """Staged (label, features, *extra) in an order fixed by the row key.

    Forests draw their samples by partition and row position; with rows placed and sorted by
    key the same training set gives the same model however it was partitioned before. Trees make
    many short passes, so the number of partitions follows the size.
    """
    order = [*key, label]
    rows = assembler().transform(train).select(*dict.fromkeys([*order, "features", *extra]))
    placed = rows.repartition(*key).sortWithinPartitions(*order)
    return staged(placed.select(label, "features", *extra), "training-vectors")


def as_pipeline(fitted, column: str = "raw_prediction") -> PipelineModel:
    """A fitted base model behind the vector of inputs, writing ``column``."""
    return PipelineModel([assembler(), fitted.copy().setPredictionCol(column)])


def fit_single(
    name: str, train: DataFrame, settings: Settings = Settings(), key: Sequence[str] = ROW_KEY, label: str = "qty",
    keep: bool = False,
) -> PipelineModel:
    """One ensemble model as a pipeline that writes ``raw_prediction``."""
    return as_pipeline(fit_base(name, training_vectors(train, label, key), settings, label, keep))


def fit_base(name: str, vectors: DataFrame, settings: Settings = Settings(), label: str = "qty", keep: bool = False):
    """One ensemble model on staged vectors; ``keep`` writes it for later calls (:mod:`fits`)."""
    return fitted(Job(base_estimators(settings, label)[name], vectors, _key(vectors, label, keep)))


def _key(vectors: DataFrame, label: str, keep: bool, fold: int | None = None) -> str | None:
    return f"{rows_key(vectors, [label, 'features'])} without fold {fold}" if keep else None


def out_of_fold(
    vectors: DataFrame, settings: Settings = Settings(), label: str = "qty", keep: bool = False
) -> DataFrame:
    """Base predictions of every row by models that did not see its fold.

    ``vectors`` is a staged table (label, features, fold); each fold's rows are scored by its
    own three models and the parts are united, so every row appears exactly once.
    """
    estimators = list(base_estimators(settings, label).values())
    folds = range(settings.folds)
    others = [vectors.where(F.col("fold") != k) for k in folds]
    keys = [_key(rows, label, keep, k) for k, rows in zip(folds, others)]
    jobs = [Job(e, rows, key) for rows, key in zip(others, keys) for e in estimators]
    models = iter(fit_all(jobs, settings.parallelism))
    united = None
    for fold in folds:
        part = vectors.where(F.col("fold") == fold)
        for _ in estimators:
            part = next(models).transform(part)
        united = part if united is None else united.unionByName(part)
    return united


def fit_ridge(scored: DataFrame, alpha: float, scale: bool, label: str = "qty") -> LinearRegressionModel:
    """Ridge regression on ``meta_features`` with penalty ``alpha`` on the summed squared error.

    Spark divides the penalty by the label deviation and averages the error over the rows,
    hence the factor; scaling the inputs first is its ``standardization``.
    """
    size = scored.agg(F.count("*").alias("n"), F.stddev_samp(label).alias("std")).first()
    ridge = LinearRegression(
        featuresCol="meta_features", labelCol=label, predictionCol="raw_prediction", solver="normal",
        elasticNetParam=0.0, regParam=alpha / size["n"] * (size["std"] or 1.0), standardization=scale,
    )
    return ridge.fit(scored)


def fit_bases(
    vectors: DataFrame, settings: Settings = Settings(), label: str = "qty", keep: bool = False
) -> dict[str, object]:
    """The three base models fitted on all rows of ``vectors``, by name."""
    estimators, key = base_estimators(settings, label), _key(vectors, label, keep)
    models = fit_all([Job(e, vectors, key) for e in estimators.values()], settings.parallelism)
    return dict(zip(estimators, models, strict=True))


def stack(
    vectors: DataFrame, bases: dict[str, object], settings: Settings = Settings(), label: str = "qty",
    scored: DataFrame | None = None, keep: bool = False,
) -> PipelineModel:
    """Stacked model from fitted base models and their out-of-fold predictions on ``vectors``.

    The result is an ordinary pipeline: inputs -> vector -> three base models -> vector of
    their predictions -> ridge, writing ``raw_prediction``. ``scored`` gives the out-of-fold
    predictions where the caller has them already.
    """
    meta_inputs = VectorAssembler(inputCols=[f"p_{name}" for name in bases], outputCol="meta_features")
    scored = out_of_fold(vectors, settings, label, keep) if scored is None else scored
    meta = staged(meta_inputs.transform(scored).select(label, "meta_features"), "out-of-fold")
    ridge = fit_ridge(meta, settings.ridge_alpha, settings.scale_meta, label)
    return PipelineModel([assembler(), *bases.values(), meta_inputs, ridge])


def folded_vectors(train: DataFrame, settings: Settings, key: Sequence[str] = ROW_KEY, label: str = "qty") -> DataFrame:
    return training_vectors(with_fold(train, key, settings.folds), label, key, ["fold"])


def fit_stacking(
    train: DataFrame, settings: Settings = Settings(), key: Sequence[str] = ROW_KEY, label: str = "qty", keep: bool = False
) -> PipelineModel:
    """Stacked model: out-of-fold base predictions feed a ridge regression. ``keep``: see :mod:`fits`."""
    vectors = folded_vectors(train, settings, key, label)
    return stack(vectors, fit_bases(vectors, settings, label, keep), settings, label, keep=keep)


def predict_rows(model: PipelineModel | ItemLinearModel, rows: DataFrame) -> DataFrame:
    """Rows with ``prediction``, not below 0; helper columns of the model are dropped."""
    scored = model.transform(rows)
    return _with_prediction(scored, "raw_prediction").select(*rows.columns, "prediction")


def feature_importance(train: DataFrame, label: str = "qty", inputs: Sequence[str] = tuple(NUMERIC_INPUTS)) -> DataFrame:
    """Importance of each numeric input in a shallow tree, largest first."""
    vectors = staged(assembler(inputs).transform(train).select(label, "features"), "importance-vectors")
    tree = DecisionTreeRegressor(labelCol=label, maxDepth=IMPORTANCE_DEPTH, seed=SEED).fit(vectors)
    weights = tree.featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(inputs, weights, strict=True)]
    return train.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def fit_models(
    train: DataFrame, settings: Settings = Settings(), label: str = "qty", keep: bool = False
) -> dict[str, object]:
    """Linear, the three ensemble models and the stacked one on one training set; each base is fitted once."""
    vectors = folded_vectors(train, settings, label=label)
    bases = fit_bases(vectors, settings, label, keep)
    return {
        "linear": fit_linear(train, label),
        **{name: as_pipeline(fitted) for name, fitted in bases.items()},
        "stacking": stack(vectors, bases, settings, label, keep=keep),
    }


def scored_rows(models: dict[str, object], test: DataFrame, label: str = "qty") -> DataFrame:
    """(model, actual, prediction, *columns of the test rows) of every model."""
    rows = None
    for name, model in models.items():
        part = predict_rows(model, test).withColumns({"model": F.lit(name), "actual": F.col(label)})
        rows = part if rows is None else rows.unionByName(part)
    return rows


def train_and_evaluate(
    train: DataFrame, test: DataFrame, settings: Settings = Settings(), label: str = "qty", keep: bool = False
) -> tuple[dict[str, object], DataFrame]:
    """(fitted models, metrics of the five models on one split, one row per model)."""
    models = fit_models(train, settings, label, keep)
    return models, regression_metrics(scored_rows(models, test, label), ["model"])
