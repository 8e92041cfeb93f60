"""Least squares with one effect per item.

Regression on numbers and a full set of item dummies has the same fit as regression on columns
centred per item. So the fit needs one aggregate for the item means, a join and the sums of products
of the centred columns; the item effects are a table, however many items there are.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.session import staged

SHAPE = "inputs array<string>, weights array<double>, label string, item string, average double"


class ItemLinearModel(Model, MLReadable, MLWritable):
    """Weights of the inputs and ``effects`` (item, effect); an unknown item takes the average effect.

    A Spark ML model: it can be a stage of a pipeline, and is saved with its table of effects.
    """

    def __init__(
        self, inputs: Sequence[str], weights: Sequence[float], label: str, item: str, average: float, effects: DataFrame
    ):
        super().__init__()
        self.inputs, self.weights, self.label = list(inputs), list(weights), label
        self.item, self.average, self.effects = item, average, effects

    def _transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``raw_prediction``."""
        effects = self.effects.select(F.col(self.item).alias("_item"), F.col("effect").alias("_effect"))
        joined = rows.join(effects, F.col(self.item) == F.col("_item"), "left")
        value = F.coalesce("_effect", F.lit(self.average))
        for name, weight in zip(self.inputs, self.weights, strict=True):
            value = value + F.col(name) * F.lit(weight)
        return joined.withColumn("raw_prediction", value).drop("_item", "_effect")

    def write(self) -> MLWriter:
        return _ItemLinearWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ItemLinearReader()


class _ItemLinearWriter(MLWriter):
    def __init__(self, model: ItemLinearModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model, spark = self.model, self.model.effects.sparkSession
        DefaultParamsWriter.saveMetadata(model, path, spark)
        row = (model.inputs, model.weights, model.label, model.item, model.average)
        spark.createDataFrame([row], SHAPE).write.parquet(f"{path}/weights")
        model.effects.write.parquet(f"{path}/effects")


class _ItemLinearReader(MLReader):
    def load(self, path: str) -> ItemLinearModel:
        spark = self.sparkSession
        row = spark.read.schema(SHAPE).parquet(f"{path}/weights").first()
        return ItemLinearModel(**row.asDict(), effects=spark.read.parquet(f"{path}/effects"))


def fit_item_linear(train: DataFrame, inputs: Sequence[str], label: str = "qty", item: str = "item_id") -> ItemLinearModel:
    """Fit on ``train``; inputs that don't vary within items get the least-norm solution."""
    columns = [*inputs, label]
    means = staged(
        train.groupBy(item).agg(*[F.avg(c).alias(f"_{c}") for c in columns], F.count("*").alias("_n")), "item-means"
    )
    centred = train.select(item, *columns).join(means.withColumnRenamed(item, "_item"), F.col(item) == F.col("_item")).select(
        *[(F.col(c) - F.col(f"_{c}")).alias(c) for c in columns]
    )
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    sums = centred.agg(*[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0.0)).alias(f"s{k}") for k, (a, b) in enumerate(pairs)]).first()
    gram = np.zeros((len(columns), len(columns)))
    for k, (a, b) in enumerate(pairs):
        i, j = columns.index(a), columns.index(b)
        gram[i, j] = gram[j, i] = sums[f"s{k}"]
    scale = np.sqrt(np.maximum(np.diag(gram)[:-1], 1e-300))
    weights = np.linalg.lstsq(gram[:-1, :-1] / np.outer(scale, scale), gram[:-1, -1] / scale, rcond=1e-10)[0] / scale
    effect = F.col(f"_{label}")
    for name, weight in zip(inputs, weights.tolist(), strict=True):
        effect = effect - F.col(f"_{name}") * F.lit(weight)
    effects = staged(means.select(item, effect.alias("effect"), "_n"), "item-effects")
    average = effects.agg(F.sum(F.col("effect") * F.col("_n")) / F.sum("_n")).first()[0] or 0.0
    return ItemLinearModel(list(inputs), weights.tolist(), label, item, float(average), effects.select(item, "effect"))
