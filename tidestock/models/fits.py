"""Fits that are written once and found again by their rows and settings.

A fit that takes minutes outlives the session that made it: each model is written by its own writer in the shared
folder as soon as it is fitted, under a key of the training rows and of all parameters. A later call with equal
rows and parameters loads it, so that a run that was cut short goes on where it stopped.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestock.session import shared_folder


class Job(NamedTuple):
    """An estimator, its rows, and the key of these rows; without a key the fit is not kept."""

    estimator: Estimator
    rows: DataFrame
    key: str | None = None


def rows_key(rows: DataFrame, columns: Sequence[str] | None = None) -> str:
    """Key of the rows' content, whatever their order and partitions."""
    whole = F.xxhash64(*(columns or rows.columns))
    seen = rows.agg(
        F.count("*").alias("n"), F.sum(whole.cast("decimal(38,0)")).alias("total"), F.bit_xor(whole).alias("mixed")
    ).first()
    return f"{seen['n']}-{seen['total']}-{seen['mixed']}"


def _settings(estimator: Estimator) -> str:
    values = {p.name: v for p, v in estimator.extractParamMap().items()}
    return f"{type(estimator).__name__} {sorted(values.items())}"


def kept(spark: SparkSession, key: str, fit: Callable[[], object]):
    """The model written under ``key``, or else the one that ``fit`` makes, written for the next time.

    A model is written beside its place and then moved there, so nobody loads half of one; of two that are
    fitted at the same time either may stay.
    """
    place = f"{shared_folder(spark)}/tidestock/fits/{hashlib.sha256(key.encode()).hexdigest()}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(place).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(path(place)):
        beside = f"{place}.{uuid.uuid4().hex}"
        model = fit()
        model.write().save(beside)
        files.rename(path(beside), path(place))
        return model
    return DefaultParamsReader.loadParamsInstance(place, spark)


def fitted(job: Job):
    if job.key is None:
        return job.estimator.fit(job.rows)
    key = f"{job.key} {_settings(job.estimator)}"
    return kept(job.rows.sparkSession, key, lambda: job.estimator.fit(job.rows))


def fit_all(jobs: Sequence[Job], parallelism: int) -> list:
    """Fitted models of all jobs, some at a time."""
    if not jobs:
        return []
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(inheritable_thread_target(jobs[0].rows.sparkSession)(fitted), jobs))
