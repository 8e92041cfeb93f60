"""Reproducible pseudo-random numbers derived from row keys.

The same key and salt give the same number on every run, engine and partitioning, so a
retried task or a re-read table never changes a sample.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 13  # 52 bits: exactly representable in a double
SCALE = float(2**52)


def row_key(columns: Sequence[str]) -> Column:
    """Text key of a row; dates are rendered as yyyy-mm-dd."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def uniform(key: Column, salt: str) -> Column:
    """Uniform number in [0, 1)."""
    digest = F.md5(F.concat(key, F.lit("-" + salt)))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("bigint") / F.lit(SCALE)


def gaussian(key: Column, salt: str) -> Column:
    """Standard normal number by the Box-Muller transform."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - uniform(key, salt + "-r")))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(key, salt + "-a"))
