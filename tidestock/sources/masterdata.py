"""Bill of materials and stock snapshots."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.functions.numeric import number_or_zero

# Codes of the source tables.
ACTIVE = 1
PHYSICAL = 1
NOT_FROZEN = 0

BOM_KEY = ["item_id", "alt", "bom_type"]


def active_bom(header: DataFrame, line: DataFrame, as_of: date) -> DataFrame:
    """Edges (fg_item, component, qty) of bills valid on ``as_of``, one level deep.

    Alternative bills of one product stay separate edges and add up downstream.
    """
    day = F.lit(as_of)
    open_header = header.where(
        (F.col("status") == ACTIVE)
        & (F.col("valid_from").isNull() | (F.col("valid_from") <= day))
        & (F.col("valid_to").isNull() | (F.col("valid_to") >= day))
    ).select(*BOM_KEY)
    used = line.where((F.col("comp_status") == ACTIVE) & (F.col("qty") > 0))
    return used.join(open_header, BOM_KEY, "inner").select(
        F.col("item_id").alias("fg_item"), "component", "qty"
    )


def bom_components(header: DataFrame, line: DataFrame) -> DataFrame:
    """Items used by an active bill; bill type, validity and line status do not matter here."""
    active = header.where(F.col("status") == ACTIVE).select("item_id", "alt").distinct()
    return line.join(active, ["item_id", "alt"], "left_semi").select(
        F.col("component").alias("item_id")
    ).distinct()


def not_a_component(items: DataFrame, header: DataFrame, line: DataFrame) -> DataFrame:
    """Rows of ``items`` whose item is not a component of an active bill."""
    return items.join(bom_components(header, line), "item_id", "left_anti")


def made_or_ordered(items: DataFrame, header: DataFrame, sales_order: DataFrame) -> DataFrame:
    """Rows of ``items`` whose item has an active bill or a customer order."""
    made = header.where(F.col("status") == ACTIVE).select("item_id")
    ordered = sales_order.where(F.col("order_no").isNotNull()).select("item_id")
    return items.join(made.union(ordered).distinct(), "item_id", "left_semi")


def stock_on_hand(stock: DataFrame, item_master: DataFrame, site: str | None = None) -> DataFrame:
    """Usable physical stock of active items: (item_id, label, qty_on_hand).

    Movements are summed per item before the join, so an item with very many movements is
    reduced map-side and never travels as single rows.
    """
    usable = stock.where((F.col("is_physical") == PHYSICAL) & (F.col("is_frozen") == NOT_FROZEN))
    if site is not None:
        usable = usable.where(F.col("site") == site)
    per_item = usable.where(F.col("item_id").isNotNull()).groupBy("item_id").agg(
        F.sum(number_or_zero(F.col("qty"))).alias("qty_on_hand")
    )
    active = item_master.where(F.col("status") == ACTIVE).select("item_id", "label")
    return per_item.join(active, "item_id", "inner").groupBy("item_id", "label").agg(
        F.sum("qty_on_hand").alias("qty_on_hand")
    )


def stock_components(stock: DataFrame, item_master: DataFrame, site: str | None = None) -> DataFrame:
    """Stock against which component requirements are netted: every active item."""
    return stock_on_hand(stock, item_master, site)


def stock_finished_goods(
    stock: DataFrame,
    item_master: DataFrame,
    header: DataFrame,
    line: DataFrame,
    sales_order: DataFrame,
    site: str | None = None,
) -> DataFrame:
    """Stock of items that are no component and are made in-house or ordered by customers."""
    on_hand = stock_on_hand(stock, item_master, site)
    return made_or_ordered(not_a_component(on_hand, header, line), header, sales_order)


def require_unique_items(stock: DataFrame) -> DataFrame:
    """Fail at run time when one item carries two labels, which would double plan rows."""
    labels = stock.groupBy("item_id").agg(F.count("*").alias("_labels"), *[
        F.first(c).alias(c) for c in stock.columns if c != "item_id"
    ])
    checked = F.when(
        F.col("_labels") > 1,
        F.raise_error(F.concat(F.lit("several labels for item "), F.col("item_id"))).cast("string"),
    ).otherwise(F.col("item_id"))
    return labels.withColumn("item_id", checked).select(*stock.columns)
