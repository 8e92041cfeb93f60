"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, range partitions.

Records are laid out in key order and cut into fine ranges; consecutive ranges form a shard, so
every shard is one key interval and all shards have nearly the same number of bytes.

1. Records are drawn with a chance in proportion to their size; the draw depends on the record
   alone. Weighted quantiles of the drawn keys are the splitters.
2. Every record finds its range by binary search; true range sizes are aggregated.
3. Ranges above twice the wanted size are subdivided by a finer draw inside them, and again,
   until none is overfull or it holds one record.
4. Ranges are dealt to shards at the boundary nearest to each equal share of the bytes. A
   record's slot is the number of records in the shard's earlier ranges plus its place in its own.

Only splitters and range totals reach the driver; their number depends on ``shards`` and
``ranges_per_shard``, not on the data. A key shared by many records is no obstacle: the key is
made unique with the number of the staged record, so ranges can cut through equal keys.

Defined results: a null key sorts first; repeated rows are separate records; an empty table gives
an empty result; fewer records than shards leave shards empty.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestock.session import staged

#: Sampled points for each wanted range.
OVERSAMPLE = 8
LOWEST = -(1 << 63)


def _drawn(records: DataFrame, grain: float, salt: int) -> list[tuple[int, int, float]]:
    """Size-weighted sample as sorted ``(key, rid, weight)``: about one point per ``grain`` bytes."""
    uniform = F.pmod(F.xxhash64("_key", "_rid", F.lit(salt)), F.lit(1 << 53)) / float(1 << 53)
    points = records.where(uniform * grain < F.col("_size")).select(
        "_key", "_rid", F.greatest(F.col("_size").cast("double"), F.lit(grain)).alias("w")
    )
    return sorted((r["_key"], r["_rid"], r["w"]) for r in points.collect())


def _quantiles(points: list[tuple[int, int, float]], width: float) -> list[tuple[int, int]]:
    """Keys at which the sampled weight has grown by ``width`` since the last one."""
    cuts, filled = [], 0.0
    for key, rid, weight in points:
        if filled >= width:
            cuts.append((key, rid))
            filled = 0.0
        filled += weight
    return cuts


def _with_range(records: DataFrame, cuts: list[tuple[int, int]]) -> DataFrame:
    @F.pandas_udf(T.IntegerType())
    def find(key: pd.Series, rid: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(cuts, pair) for pair in zip(key.tolist(), rid.tolist())], dtype="int32")

    return records.withColumn("_range", find("_key", "_rid"))


def _totals(ranged: DataFrame) -> dict[int, tuple[int, int]]:
    rows = ranged.groupBy("_range").agg(F.sum("_size").alias("size"), F.count("*").alias("n")).collect()
    return {r["_range"]: (r["size"], r["n"]) for r in rows}


def dealt(totals: list[tuple[int, int]], shards: int) -> list[tuple[int, int]]:
    """``(shard, first slot)`` of each consecutive range from its ``(size, rows)``."""
    whole = sum(size for size, _ in totals) or 1
    out, shard, slot, before = [], 0, 0, 0
    for size, rows in totals:
        # the range goes on to the next shard if more than half of it lies beyond this one's share
        while shard < shards - 1 and (before + size / 2) * shards > whole * (shard + 1):
            shard, slot = shard + 1, 0
        out.append((shard, slot))
        slot += rows
        before += size
    return out


def range_shards(
    records: DataFrame, key: str, size: str, shards: int = 8, ranges_per_shard: int = 256,
) -> DataFrame:
    """``records`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (0, 1, ... in key order).

    ``key`` is a whole number and ``size`` a positive number of bytes. ``records`` should hold the
    columns to keep only, not the texts: it is staged and one shuffle carries all of it.
    """
    marked = records.withColumns({
        "_key": F.coalesce(F.col(key).cast("long"), F.lit(LOWEST)),
        "_size": F.col(size).cast("long"),
        "_rid": F.monotonically_increasing_id(),
    })
    base = staged(marked, "shard-records")
    slim = base.select("_key", "_rid", "_size")
    total = slim.agg(F.sum("_size")).first()[0] or 0
    grain = max(1.0, total / (shards * ranges_per_shard))
    cuts = _quantiles(_drawn(slim, grain / OVERSAMPLE, 0), grain)
    totals = _totals(_with_range(slim, cuts))
    finer = grain
    while over := {k for k, (held, n) in totals.items() if held > 2 * grain and n > 1}:
        finer /= 2
        inside = _with_range(slim, cuts).where(F.col("_range").isin(sorted(over)))
        points = _drawn(inside, finer / OVERSAMPLE, 1)
        edges = [(LOWEST, -1), *cuts, ((1 << 63) - 1, 1 << 63)]
        added = []
        for k in over:
            own = [p for p in points if edges[k] <= p[:2] < edges[k + 1]]
            added += _quantiles(own, grain)
            added += [p[:2] for p in own if p[2] > grain]  # a record above the grain opens a range
        cuts = sorted({*cuts, *added})
        totals = _totals(_with_range(slim, cuts))

    order = sorted(totals)
    places = [(k, s, slot) for k, (s, slot) in zip(order, dealt([totals[k] for k in order], shards))]
    spark = records.sparkSession
    table = spark.createDataFrame(places, "_range int, shard int, _first long")
    within = Window.partitionBy("_range").orderBy("_key", "_rid")
    return (
        _with_range(base, cuts).join(F.broadcast(table), "_range")
        .withColumn("slot", F.col("_first") + F.row_number().over(within) - 1)
        .select(*records.columns, "shard", "slot")
    )
