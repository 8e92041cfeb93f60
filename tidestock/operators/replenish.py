"""Requirements, purchases, coverage and final stock.

Netting is one bucket over the whole horizon and the bill of materials is one level deep.
Every table has one row per item or component; no step orders, collects or repeats rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestock.functions.numeric import floor_zero, total

# Coverage classes are right-closed at these percentages.
SHORT_UP_TO = 25
LOW_UP_TO = 75
FULL = 100
STATUS = ("stockout_risk", "low_stock", "sufficient")


def fg_requirements(detail: DataFrame) -> DataFrame:
    """Forecast quantity and revenue per item over the horizon."""
    return detail.dropna(subset=["item_id"]).groupBy("item_id").agg(
        total(F.col("qty_forecast")).alias("requirement"),
        total(F.col("revenue_forecast")).alias("revenue"),
    )


def net_stock(requirements: DataFrame, stock: DataFrame) -> DataFrame:
    """Requirements with stock on hand; an item without stock has 0.

    The left join keeps items that are not stocked at all.
    """
    joined = requirements.join(stock, "item_id", "left")
    return joined.withColumn("qty_on_hand", F.coalesce("qty_on_hand", F.lit(0.0)))


def coverage_pct(requirement: Column, on_hand: Column) -> Column:
    """Stock as a percentage of the requirement, at most 100; 100 when nothing is required."""
    ratio = F.when(requirement > 0, on_hand / requirement * 100.0).otherwise(F.lit(100.0))
    return F.least(ratio, F.lit(100.0))


def coverage_status(coverage: Column) -> Column:
    """Class of a coverage percentage; NULL at -1 and below."""
    return (
        F.when((coverage > -1) & (coverage <= SHORT_UP_TO), STATUS[0])
        .when((coverage > SHORT_UP_TO) & (coverage <= LOW_UP_TO), STATUS[1])
        .when((coverage > LOW_UP_TO) & (coverage <= FULL), STATUS[2])
    )


def coverage_band(coverage: Column) -> Column:
    """Chart colour classes, which are left-closed: below 25, below 75, the rest."""
    return (
        F.when(coverage < SHORT_UP_TO, STATUS[0])
        .when(coverage < LOW_UP_TO, STATUS[1])
        .when(coverage.isNotNull(), STATUS[2])
    )


def purchases(requirements: DataFrame, stock: DataFrame) -> DataFrame:
    """Net requirements against stock: purchase, coverage and status per item."""
    netted = net_stock(requirements, stock)
    coverage = coverage_pct(F.col("requirement"), F.col("qty_on_hand"))
    return netted.withColumns({
        "purchase": floor_zero(F.col("requirement") - F.col("qty_on_hand")),
        "coverage_pct": coverage,
        "status": coverage_status(coverage),
    })


def bom_explode(bom: DataFrame, fg_purchases: DataFrame) -> DataFrame:
    """Component need of every (finished good, component) edge; goods without a bill vanish."""
    bought = fg_purchases.select(
        F.col("item_id").alias("fg_item"), F.coalesce("purchase", F.lit(0.0)).alias("purchase")
    )
    return bom.join(bought, "fg_item", "inner").withColumn("need", F.col("purchase") * F.col("qty"))


def component_requirements(exploded: DataFrame) -> DataFrame:
    """Total need and number of finished goods per component, keyed as ``item_id``."""
    return exploded.groupBy(F.col("component").alias("item_id")).agg(
        total(F.col("need")).alias("requirement"),
        F.countDistinct("fg_item").alias("n_products"),
    )


def final_stock(plan: DataFrame) -> DataFrame:
    """Simulated stock after purchases and consumption, not below 0."""
    left = F.col("qty_on_hand") + F.col("purchase") - F.col("requirement")
    return plan.withColumn("final_stock", floor_zero(left))


def plan_kpis(plan: DataFrame) -> DataFrame:
    """One row of counts and totals of a plan with final stock."""
    return plan.agg(
        F.count("*").alias("n_items"),
        F.count_if(F.col("purchase") > 0).alias("n_to_buy"),
        F.count_if(F.col("purchase") == 0).alias("n_covered"),
        F.count_if(F.col("status") == STATUS[0]).alias("n_stockout_risk"),
        total(F.col("requirement")).alias("requirement"),
        total(F.col("qty_on_hand")).alias("qty_on_hand"),
        total(F.col("purchase")).alias("purchase"),
        total(F.col("final_stock")).alias("final_stock"),
    )


def plan_sorted(plan: DataFrame) -> DataFrame:
    return plan.orderBy(F.desc("purchase"), "item_id")


def to_buy(plan: DataFrame) -> DataFrame:
    """Items with a purchase, largest first."""
    return plan_sorted(plan.where(F.col("purchase") > 0))


def plan_with_total(plan: DataFrame) -> DataFrame:
    """Item rows and one TOTAL row."""
    return plan.rollup("item_id").agg(
        total(F.col("requirement")).alias("requirement"),
        total(F.col("qty_on_hand")).alias("qty_on_hand"),
        total(F.col("purchase")).alias("purchase"),
        F.grouping("item_id").cast("int").alias("is_total"),
    ).withColumn("item_id", F.coalesce("item_id", F.lit("TOTAL")))
