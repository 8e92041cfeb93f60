"""Session settings and the shared folder used for staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CLUSTER_CONF = {
    # Let AQE size partitions, split hot keys and choose broadcasts from measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "tidestock", conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the cluster defaults above; ``conf`` entries win."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**CLUSTER_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, the context's checkpoint folder,
    or the session's warehouse.

    A ``file:`` folder is accepted only where driver and executors run on one machine; elsewhere
    a part written there would be lost with its machine, so it is an error.
    """
    context = spark.sparkContext
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    if not context.master.startswith("local") and folder.startswith("file:"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """Fresh path in the shared folder; never reuses or clears an older one."""
    return f"{shared_folder(spark)}/tidestock/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where one expensive frame feeds many consumers: lineage is cut, later jobs scan
    only the columns they need, and a lost executor costs a re-read, not a recompute.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_lean(df: DataFrame, name: str) -> DataFrame:
    """:func:`staged`, and the shuffle files of this one step are dropped once it is written.

    For steps whose shuffles are large against the input; what is written is read again, never the frame.
    """
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return staged(df, name)
    finally:
        conf.set(key, before)
