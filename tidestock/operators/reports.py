"""Tables behind the charts: distributions, rankings, shares and comparisons."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidestock.functions.dates import month_label
from tidestock.functions.numeric import divide_or, one_row
from tidestock.functions.quantiles import exact_quantiles
from tidestock.operators.replenish import coverage_band

# List lengths and tolerances of the reports.
TOP_REQUIREMENTS = 20
LOWEST_COVERAGE = 20
TOP_PURCHASES = 10
LOWEST_STOCK = 15
TARGET_R2 = 0.70
GAP_TOLERANCE_PCT = 10.0


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last bin closed on both sides; empty bins stay."""
    value = F.col(column).cast("double")
    limits = one_row(df.agg(F.min(value).alias("low"), F.max(value).alias("high")))
    low, width = limits["low"], (limits["high"] - limits["low"]) / F.lit(float(bins))
    place = F.coalesce(F.try_divide(value - low, width), F.lit(0.0))
    bin_no = F.least(F.floor(place), F.lit(bins - 1)).cast("int")
    counted = df.where(value.isNotNull()).groupBy(bin_no.alias("bin")).agg(F.count("*").alias("n_rows"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return edges.join(counted, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_from"),
        (low + (F.col("bin") + 1) * width).alias("bin_to"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )


def boxplot_stats(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the most extreme values within ``reach`` IQR, and points beyond."""
    q = one_row(exact_quantiles(df, column, {"q1": 0.25, "median": 0.50, "q3": 0.75}))
    value, spread = F.col(column), q["q3"] - q["q1"]
    inside = value.between(q["q1"] - reach * spread, q["q3"] + reach * spread)
    whiskers = df.agg(
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )
    return whiskers.select(
        q["q1"].alias("q1"), q["median"].alias("median"), q["q3"].alias("q3"),
        "whisker_low", "whisker_high", "n_outliers",
    )


def qq_points(df: DataFrame, column: str, points: int = 99) -> DataFrame:
    """Sample quantiles at an even grid of probabilities against normal quantiles."""
    grid = [i / (points + 1) for i in range(1, points + 1)]
    row = exact_quantiles(df, column, {f"q{i}": p for i, p in enumerate(grid)})
    pairs = F.array(*[
        F.struct(
            F.lit(p).alias("probability"),
            F.lit(NormalDist().inv_cdf(p)).alias("normal_quantile"),
            F.col(f"q{i}").alias("sample_quantile"),
        )
        for i, p in enumerate(grid)
    ])
    return row.select(F.inline(pairs))


def monthly_label_series(monthly: DataFrame) -> DataFrame:
    """Monthly totals under a "YYYY-MM" label."""
    return monthly.select(month_label(F.col("year"), F.col("month")).alias("label"), "revenue", "qty")


def status_share(plan: DataFrame) -> DataFrame:
    """Items and percentage per status; the window spans the few status rows only."""
    counted = plan.where(F.col("status").isNotNull()).groupBy("status").agg(F.count("*").alias("n_items"))
    everything = F.sum("n_items").over(Window.partitionBy())
    return counted.withColumn("share_pct", F.col("n_items") * 100.0 / everything)


def top_requirements(plan: DataFrame, n: int = TOP_REQUIREMENTS) -> DataFrame:
    return plan.orderBy(F.desc("requirement"), "item_id").limit(n).select(
        "item_id", "requirement", "qty_on_hand", "purchase"
    )


def lowest_coverage(plan: DataFrame, n: int = LOWEST_COVERAGE) -> DataFrame:
    """Items with the lowest coverage and their chart class."""
    return plan.orderBy("coverage_pct", "item_id").limit(n).select(
        "item_id", "coverage_pct", coverage_band(F.col("coverage_pct")).alias("band")
    )


def top_purchases(plan: DataFrame, n: int) -> DataFrame:
    """Largest purchases among the items that need one."""
    return plan.where(F.col("purchase") > 0).orderBy(F.desc("purchase"), "item_id").limit(n).select(
        "item_id", "requirement", "qty_on_hand", "purchase"
    )


def top10_purchases(fg_plan: DataFrame, comp_plan: DataFrame, n: int = TOP_PURCHASES) -> DataFrame:
    """Ten largest purchases of finished goods and of components."""
    fg = top_purchases(fg_plan, n).withColumn("kind", F.lit("fg"))
    return fg.unionByName(top_purchases(comp_plan, n).withColumn("kind", F.lit("comp")))


def stock_before_after(plan: DataFrame, n: int | None = None) -> DataFrame:
    """Stock now and after the plan, lowest final stock first; ``n`` keeps a leading part."""
    rows = plan.select(
        "item_id", F.col("qty_on_hand").alias("stock_before"), F.col("final_stock").alias("stock_after")
    ).orderBy("stock_after", "item_id")
    return rows if n is None else rows.limit(n)


def lowest_final_stock(fg_plan: DataFrame, comp_plan: DataFrame, n: int = LOWEST_STOCK) -> DataFrame:
    fg = stock_before_after(fg_plan, n).withColumn("kind", F.lit("fg"))
    return fg.unionByName(stock_before_after(comp_plan, n).withColumn("kind", F.lit("comp")))


def model_comparison(scores: DataFrame, target: float = TARGET_R2) -> DataFrame:
    """R2 and MAE per model with the distance to the target line."""
    return scores.select("model", "r2", "mae", (F.col("r2") - F.lit(target)).alias("r2_to_target"))


def validation_table(gaps: DataFrame, tolerance: float = GAP_TOLERANCE_PCT) -> DataFrame:
    """Actual and predicted revenue per item, flagged outside the tolerance band."""
    return gaps.select(
        "item_id", "qty_actual", "qty_predicted", "revenue_actual", "revenue_predicted", "gap_pct",
        (F.abs("gap_pct") > tolerance).cast("int").alias("is_outside"),
    )


def growth(original: DataFrame, grown: DataFrame) -> DataFrame:
    """Row counts of two tables and the growth in percent."""
    before = one_row(original.agg(F.count("*").alias("n")))["n"]
    return grown.agg(F.count("*").alias("n_after")).select(
        before.alias("n_before"),
        "n_after",
        divide_or((F.col("n_after") - before) * 100.0, before, 0.0).alias("growth_pct"),
    )
