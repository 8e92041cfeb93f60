"""Global order positions without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidestock.session import staged

ROW_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def ordered_codes(df: DataFrame, column: str, code: str) -> DataFrame:
    """Dictionary (column, code): 0-based position of every distinct non-null value.

    A window without PARTITION BY would sort all values in one task. The distinct values are
    range-partitioned and sorted instead, each value keeps its partition and place, and the
    result is written once, so both stay fixed for every reader. A value's code is its place
    plus the number of values in earlier partitions; only those totals, one row per
    partition, meet in one task. The dictionary is written too: its size is then known before
    it is joined, so that a small one is broadcast and the coded rows need not be shuffled.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    serial = F.monotonically_increasing_id()
    placed = staged(
        values.repartitionByRange(column).sortWithinPartitions(column).select(
            column,
            F.shiftright(serial, ROW_BITS).alias("_part"),
            serial.bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_place"),
        ),
        f"codes-{code}",
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_size")).select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")
    )
    coded = placed.join(F.broadcast(offsets), "_part").select(
        column, (F.col("_before") + F.col("_place")).cast("int").alias(code)
    )
    return staged(coded, f"dictionary-{code}")
