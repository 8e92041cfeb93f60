"""Places of values among sorted numbers that a plan carries as a constant."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def constant_array(values: Sequence[float]) -> Column:
    """Array column of fixed numbers, one expression however many there are."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<double>")


def with_place(df: DataFrame, value: str, edges: Sequence[float], name: str, or_equal: bool) -> DataFrame:
    """Add ``name``: how many of the sorted ``edges`` are below the value (``or_equal``: at or below it).

    A binary search in generated code, a column for each halving; a probe past the end reads NULL and
    counts as above. Null values get null.
    """
    array, step = constant_array(edges), 1 << max(len(edges) - 1, 0).bit_length()
    located = df.withColumn(name, F.when(F.col(value).isNotNull(), F.lit(0)))
    while step:
        probe = F.get(array, F.col(name) + F.lit(step - 1))
        forward = probe <= F.col(value) if or_equal else probe < F.col(value)
        located = located.withColumn(name, F.col(name) + F.when(forward, F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    return located
