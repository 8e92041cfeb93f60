"""Writing results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

PLAN_TABLES = ("monthly_revenue", "final_stock_fg", "final_stock_comp")


def write_csv(df: DataFrame, path: str) -> str:
    """CSV directory with headers; one file per partition, nothing is funnelled into one task."""
    df.write.option("header", True).csv(path)
    return path


def write_plan_tables(plan: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """One directory per exported planning table."""
    paths = {}
    for name in PLAN_TABLES:
        paths[name] = f"{folder}/{name}"
        writer = plan[name].write.format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(paths[name])
    return paths
