"""Reading raw tables: JDBC or files, positional renaming, typed columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_jdbc(
    spark: SparkSession,
    table: str,
    options: Mapping[str, str],
    *,
    split_on: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    splits: int | None = None,
) -> DataFrame:
    """Read a database table or ``(subquery) alias``.

    Connection options (url, user, password, driver) come from the caller, never from code.
    ``split_on`` with bounds reads in parallel ranges; without it one connection reads all.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if split_on is not None:
        if None in (lower, upper, splits):
            raise ValueError("split_on needs lower, upper and splits")
        reader = (
            reader.option("partitionColumn", split_on)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", splits)
        )
    return reader.load()


def read_files(spark: SparkSession, path: str, layout: StructType, fmt: str = "parquet") -> DataFrame:
    """Read files under a fixed layout; nothing is inferred."""
    reader = spark.read.format(fmt).schema(layout)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def rename_positional(df: DataFrame, layout: StructType) -> DataFrame:
    """Give the columns the layout's names by position and cast them to its types."""
    if len(df.columns) != len(layout):
        raise ValueError(f"expected {len(layout)} columns, found {len(df.columns)}")
    named = df.toDF(*layout.names)
    return named.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in layout])
