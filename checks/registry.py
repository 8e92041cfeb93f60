"""Query register and the composition of SQL texts from shared table expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.testbed import Testbed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TABLES: dict[str, str] = {}


def tables(**expressions: str) -> None:
    """Declare named table expressions, usable by name in any SQL text."""
    TABLES.update(expressions)


def _needed(text: str, found: list[str]) -> list[str]:
    for name in TABLES:
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(TABLES[name], found)
            if name not in found:
                found.append(name)
    return found


def compose(body: str) -> str:
    """Prefix ``body`` with the table expressions it uses, dependencies first."""
    names = _needed(body, [])
    if not names:
        return body
    parts = ",\n".join(f"{n} AS ({TABLES[n].strip()})" for n in names)
    return f"WITH {parts}\n{body.strip()}"


def cell(expression: str, decimals: int) -> str:
    """SQL of :func:`to_cell`."""
    return f"floor(({expression}) * 1e{decimals} + 1.0::DOUBLE / 3) / 1e{decimals}"


def to_cell(column: str, decimals: int):
    """Quantise with boundaries off the decimal grid.

    Sums of doubles differ in their last bits with the order of addition. Amounts with few
    decimals often lie exactly on a rounding tie, where those bits would decide; here a tie
    would need a value at one third of a step, which no short decimal is.
    """
    scale = F.lit(10.0**decimals)
    return F.floor(F.col(column) * scale + F.lit(1.0 / 3)) / scale


def query(
    name: str,
    sql: str | None = None,
    rounding: Mapping[str, int] | None = None,
    cells: Mapping[str, int] | None = None,
):
    """Register a function of a :class:`Testbed`.

    ``rounding`` and ``cells`` give decimals per column for ordinary rounding and for
    :func:`to_cell`.
    """

    def wrap(build: Callable[[Testbed], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            result = build(Testbed(spark, folder))
            result = rounded(result, rounding or {})
            return result.withColumns({c: to_cell(c, d) for c, d in (cells or {}).items()})

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = compose(sql)
        return build

    return wrap


def rounded(df: DataFrame, decimals: Mapping[str, int]) -> DataFrame:
    return df.select(*[
        F.round(c, decimals[c]).alias(c) if c in decimals else F.col(c) for c in df.columns
    ])
