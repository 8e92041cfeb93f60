"""From raw invoice tables to daily facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.functions.numeric import total
from tidestock.operators.facts import (
    attach_last_price,
    daily_purchases,
    daily_sales,
    day_order,
    last_price,
    with_keys,
)
from tidestock.schemas import DAILY_PURCHASES, SALES_LINES
from tidestock.session import new_path, staged_lean
from tidestock.sources.invoices import purchase_lines
from tidestock.sources.readers import read_files, rename_positional
from tidestock.sources.sinks import write_csv


def load_sales(raw: DataFrame, tie_break: Sequence[str] = ("invoice_no",)) -> DataFrame:
    """Raw 13-column invoice table -> daily sales with last price."""
    lines = rename_positional(raw, SALES_LINES)
    return attach_last_price(daily_sales(lines), last_price(lines, tie_break))


def load_purchases(
    header: DataFrame, detail: DataFrame, tie_break: Sequence[str] = (), csv_path: str | None = None
) -> DataFrame:
    """Purchase header and lines -> daily purchases with last price, written as CSV and read back."""
    lines = purchase_lines(header, detail, extra=tie_break)
    daily = attach_last_price(daily_purchases(lines), last_price(lines, tie_break))
    path = write_csv(daily, csv_path or new_path(daily.sparkSession, "daily-purchases"))
    return read_files(daily.sparkSession, path, DAILY_PURCHASES, "csv")


def staged_daily(lines: DataFrame, sequence: str) -> DataFrame:
    """Daily sales with last price as a written table, for pipelines that read it many times.

    The raw lines are scanned and shuffled once: each (date, site, item) group keeps its
    quantity and the price of its newest priced line, and the price list is reduced from
    those groups. ``sequence`` is a numeric column ordering the lines of a day; with plain
    numbers in every buffer the aggregation over the lines stays hash-based.
    """
    keys = ["invoice_date", "site", "item_id"]
    newest = F.when(F.col("unit_price").isNotNull(), F.col(sequence))
    groups = staged_lean(
        with_keys(lines, ["item_id"]).groupBy(*keys).agg(
            total(F.col("qty")).alias("qty"),
            F.max(newest).alias("newest"),
            F.max_by("unit_price", newest).alias("price"),
        ),
        "daily-groups",
    )
    price = with_keys(groups, ["newest"]).groupBy("item_id").agg(
        F.max_by("price", day_order(groups, "invoice_date", "newest")).alias("last_price")
    )
    daily = with_keys(groups, keys).drop("newest", "price")
    return staged_lean(attach_last_price(daily, price), "daily-sales")
