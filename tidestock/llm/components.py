"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.session import staged


def _with_least(edges: DataFrame) -> DataFrame:
    """Adds ``m``, the least of ``u`` and its neighbours ``v``; aggregated before it is joined back."""
    least = edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``u``, ``v`` of an orderable type); root is the least node.

    Alternates the large-star and small-star steps (Kiveris et al., 2014): both replace edges by
    edges to the least neighbour and keep components as they are; when nothing changes, every node
    is joined to its root. Each round is written and read back, so lost executors cost one round.
    """
    frame = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = frame.select("u", "v").union(frame.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        starred = _with_least(staged(large, "edges"))
        pairs = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = starred.select(F.explode(pairs).alias("e")).select("e.*").where("u <> v").distinct()
        frame = staged(small, "edges")
        state = frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark:
            break
        mark = state
    roots = frame.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return frame.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
