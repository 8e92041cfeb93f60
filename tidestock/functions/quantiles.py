"""Exact linear-interpolation quantiles for columns of any size.

The built-in exact ``percentile`` keeps every distinct value in one task's memory. Here equal values are counted
and written once. Up to ``HELD`` distinct values are then ranked on the driver; more are cut into ``BUCKETS``
ranges of about equally many distinct values, whose totals tell which ranges hold a wanted rank. Only those are
looked at again, in the same way, so a range is never larger than what may be held, whatever the column's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.functions.search import with_place
from tidestock.session import staged

#: Distinct values that the driver ranks (16 MB), and ranges that larger sets are cut into.
HELD, BUCKETS = 1 << 20, 1 << 10


def _at_ranks(values: np.ndarray, sizes: np.ndarray, ranks: Iterable[int], before: int) -> dict[int, float]:
    order = np.argsort(values, kind="stable")  # NaN last, as in Spark
    ends = before + np.cumsum(sizes[order])
    ranks = list(ranks)
    return dict(zip(ranks, values[order][np.searchsorted(ends, ranks, side="right")].tolist()))


def _held(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Values and sizes if there are at most so many."""
    rows = counts.limit(most + 1).toArrow()
    return None if rows.num_rows > most else _arrays(rows)


def _arrays(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return rows["_value"].to_numpy(), rows["_n"].to_numpy()


def _values_at(counts: DataFrame, ranks: set[int], before: int, held: int, buckets: int) -> dict[int, float]:
    """Values at the given ranks (from 0) of a table of distinct values and sizes that follows ``before`` rows."""
    small = _held(counts, held)
    if small is not None:
        return _at_ranks(*small, ranks, before)
    shares = [k / buckets for k in range(1, buckets)]
    fences = sorted(set(counts.agg(F.percentile_approx("_value", shares, 4 * buckets)).first()[0]))
    marked = with_place(counts, "_value", fences, "_bucket", or_equal=True)
    totals = sorted(tuple(r) for r in marked.groupBy("_bucket").agg(F.sum("_n"), F.count("*")).collect())
    wanted: dict[int, tuple[set[int], int, int]] = {}
    for bucket, size, distinct in totals:
        own = {r for r in ranks if before <= r < before + size}
        if own:
            wanted[bucket] = own, before, distinct
        before += size
    found: dict[int, float] = {}
    if sum(distinct for _, _, distinct in wanted.values()) <= held:
        rows = marked.where(F.col("_bucket").isin(list(wanted))).select("_value", "_n", "_bucket").toArrow()
        for bucket, (own, start, _) in wanted.items():
            found |= _at_ranks(*_arrays(rows.filter(pc.equal(rows["_bucket"], bucket))), own, start)
    else:
        for bucket, (own, start, _) in wanted.items():
            inside = marked.where(F.col("_bucket") == bucket).select("_value", "_n")
            found |= _values_at(inside, own, start, held, buckets)
    return found


def exact_quantiles(
    df: DataFrame, column: str, wanted: Mapping[str, float], held: int = HELD, buckets: int = BUCKETS
) -> DataFrame:
    """One row with one column per entry of ``wanted`` (name -> probability); NULLs are skipped.

    Runs when called, like the built-in approximate quantiles. All columns are null for an empty table.
    """
    values = df.select(F.col(column).cast("double").alias("_value")).where(F.col("_value").isNotNull())
    counts = staged(values.groupBy("_value").agg(F.count("*").alias("_n")), "value-counts")
    small = _held(counts, held)
    total = int(small[1].sum()) if small is not None else counts.agg(F.sum("_n")).first()[0]
    places = {name: p * (total - 1) for name, p in wanted.items()}
    found: dict[int, float] = {}
    if total:
        ranks = {r for x in places.values() for r in (math.floor(x), math.ceil(x))}
        found = _at_ranks(*small, ranks, 0) if small is not None else _values_at(counts, ranks, 0, held, buckets)

    def between(x: float) -> float | None:
        if not found:
            return None
        below, above = found[math.floor(x)], found[math.ceil(x)]
        return below + (above - below) * (x - math.floor(x))

    one = df.sparkSession.range(1)
    return one.select(*[F.lit(between(x)).cast("double").alias(name) for name, x in places.items()])
