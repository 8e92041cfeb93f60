"""Aggregations and the price join."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.testbed import TIE_BREAK, Testbed
from tidestock.operators import facts
from tidestock.plans.planning import baseline_detail


def _revenue_rows(t: Testbed):
    return t.daily().select(
        F.year("invoice_date").alias("year"),
        F.month("invoice_date").alias("month"),
        "qty",
        (F.col("qty") * F.col("last_price")).alias("revenue"),
    )


@query("daily_sales", "SELECT invoice_date, site, item_id, sum(qty) AS qty FROM t_lines GROUP BY ALL")
def daily_sales(t: Testbed):
    return facts.daily_sales(t.sales_lines())


@query("daily_purchases", "SELECT invoice_date, supplier, item_id, sum(qty) AS qty FROM t_purchase_lines GROUP BY ALL")
def daily_purchases(t: Testbed):
    return facts.daily_purchases(t.purchase_lines())


@query(
    "last_price",
    """SELECT item_id, arg_max(unit_price, row(invoice_date, line_seq)) AS last_price
       FROM t_lines GROUP BY item_id""",
)
def last_price(t: Testbed):
    return facts.last_price(t.sales_lines(), TIE_BREAK)


@query("attach_last_price", "SELECT * FROM t_daily")
def attach_last_price(t: Testbed):
    return t.daily()


@query(
    "describe_qty",
    """SELECT count(qty) AS n, round(avg(qty), 6) AS mean, round(stddev_samp(qty), 6) AS std, min(qty) AS min,
              quantile_cont(qty, 0.25) AS p25, quantile_cont(qty, 0.5) AS p50, quantile_cont(qty, 0.75) AS p75, max(qty) AS max
       FROM t_spiked""",
    {"mean": 6, "std": 6},
)
def describe_qty(t: Testbed):
    return facts.describe(t.daily_table(spiked=True), "qty")


@query(
    "describe_price",
    """SELECT count(unit_price) AS n, round(avg(unit_price), 6) AS mean, round(stddev_samp(unit_price), 6) AS std,
              min(unit_price) AS min, round(quantile_cont(unit_price, 0.25), 6) AS p25,
              round(quantile_cont(unit_price, 0.5), 6) AS p50, round(quantile_cont(unit_price, 0.75), 6) AS p75,
              max(unit_price) AS max FROM t_lines""",
    {"mean": 6, "std": 6, "p25": 6, "p50": 6, "p75": 6},
)
def describe_price(t: Testbed):
    return facts.describe(t.sales_lines(), "unit_price")


@query(
    "dataset_profile",
    """SELECT count(*) AS n_rows, count(DISTINCT item_id) AS n_item_id, min(invoice_date) AS first_date,
              max(invoice_date) AS last_date FROM t_daily""",
)
def dataset_profile(t: Testbed):
    return facts.dataset_profile(t.daily(), ["item_id"], date="invoice_date")


@query(
    "bom_profile",
    """SELECT count(*) AS n_rows, count(DISTINCT fg_item) AS n_fg_item, count(DISTINCT component) AS n_component FROM t_bom""",
)
def bom_profile(t: Testbed):
    return facts.dataset_profile(t.bom(), ["fg_item", "component"])


@query("stock_profile", "SELECT count(*) AS n_rows, sum(qty_on_hand) AS total_qty_on_hand FROM t_stock_fg")
def stock_profile(t: Testbed):
    return facts.dataset_profile(t.stock_fg(), [], amount="qty_on_hand")


@query("daily_total_series", "SELECT invoice_date, sum(qty) AS qty FROM t_lines GROUP BY invoice_date")
def daily_total_series(t: Testbed):
    return facts.daily_total_series(t.sales_lines())


@query("daily_item_series", "SELECT item_id, invoice_date, sum(qty) AS qty FROM t_lines GROUP BY ALL")
def daily_item_series(t: Testbed):
    return facts.daily_total_series(t.sales_lines(), by=["item_id"])


@query(
    "daily_total_measures",
    """SELECT invoice_date, qty, round(discount, 4) AS discount, round(net_amount, 4) AS net_amount FROM t_totals""",
    {"discount": 4, "net_amount": 4},
)
def daily_total_measures(t: Testbed):
    return facts.daily_total_series(t.sales_lines(), measures=["qty", "discount", "net_amount"])


@query(
    "mean_qty_by_item",
    "SELECT item_id, round(avg(qty), 6) AS mean_qty FROM t_daily GROUP BY item_id ORDER BY 2 DESC, 1",
    {"mean_qty": 6},
)
def mean_qty_by_item(t: Testbed):
    return facts.mean_qty_by_item(t.daily())


@query(
    "item_stats",
    "SELECT item_id, round(qty_mean_item, 6) AS qty_mean_item, qty_last, last_price FROM t_item_stats",
    {"qty_mean_item": 6},
)
def item_stats(t: Testbed):
    return facts.item_stats(t.daily())


@query(
    "monthly_revenue",
    """SELECT CAST(year(invoice_date) AS INTEGER) AS year, CAST(month(invoice_date) AS INTEGER) AS month,
              round(sum(qty * last_price), 2) AS revenue, sum(qty) AS qty
       FROM t_daily GROUP BY 1, 2 ORDER BY 1, 2""",
    {"revenue": 2},
)
def monthly_revenue(t: Testbed):
    return facts.monthly_revenue(_revenue_rows(t), "qty", "revenue")


@query(
    "revenue_total", "SELECT round(sum(qty * last_price), 2) AS revenue_total FROM t_daily", {"revenue_total": 2}
)
def revenue_total(t: Testbed):
    return facts.revenue_total(_revenue_rows(t), "revenue")


@query(
    "quantile_bounds",
    """SELECT p AS probability, CASE p WHEN 0.10 THEN a WHEN 0.25 THEN b WHEN 0.75 THEN c WHEN 0.90 THEN d ELSE e END AS value
       FROM (SELECT quantile_cont(qty, 0.10) AS a, quantile_cont(qty, 0.25) AS b, quantile_cont(qty, 0.75) AS c,
                    quantile_cont(qty, 0.90) AS d, quantile_cont(qty, 0.99) AS e FROM t_spiked),
            (VALUES (0.10::DOUBLE), (0.25::DOUBLE), (0.75::DOUBLE), (0.90::DOUBLE), (0.99::DOUBLE)) v(p)""",
)
def quantile_bounds(t: Testbed):
    return facts.quantile_table(t.daily_table(spiked=True), "qty", [0.10, 0.25, 0.75, 0.90, 0.99])


@query(
    "value_counts_month",
    "SELECT CAST(month(invoice_date) AS INTEGER) AS month, count(*) AS n_rows FROM t_daily GROUP BY 1",
)
def value_counts_month(t: Testbed):
    return facts.value_counts(t.daily().select(F.month("invoice_date").alias("month")), "month")


@query(
    "value_counts",
    "SELECT item_id, count(*) AS n_rows FROM t_daily GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def value_counts_item(t: Testbed):
    return facts.value_counts(t.daily(), "item_id", top=10)


@query(
    "forecast_month_counts",
    "SELECT month, count(*) AS n_rows FROM t_detail GROUP BY 1",
)
def forecast_month_counts(t: Testbed):
    return facts.value_counts(baseline_detail(t.daily_table()), "month")
