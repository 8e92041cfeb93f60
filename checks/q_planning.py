"""Forecast grids, revenue forecast and replenishment planning."""

from pyspark.sql import functions as F

from checks.registry import cell, query
from checks.testbed import Testbed
from tidestock.operators import facts, forecast, replenish
from tidestock.plans.planning import baseline_detail, run_planning


def _plan(t: Testbed, stage: bool = False):
    return run_planning(baseline_detail(t.daily_table()), t.bom(), t.stock_fg(), t.stock_comp(), stage)


_PLAN = """item_id, round(requirement, 4) AS requirement, {extra}, label, qty_on_hand, round(purchase, 4) AS purchase,
 round(coverage_pct, 4) AS coverage_pct, status"""
_CELLS = {"revenue": 2}
_FG = _PLAN.format(extra=cell("revenue", 2) + " AS revenue")
_COMP = _PLAN.format(extra="n_products")
_ROUND = {"requirement": 4, "purchase": 4, "coverage_pct": 4, "final_stock": 4}


@query(
    "future_grid",
    "SELECT item_id, round(qty_mean_item, 6) AS qty_mean_item, qty_last, last_price, months_ahead, forecast_date FROM t_grid",
    {"qty_mean_item": 6},
)
def future_grid(t: Testbed):
    daily = t.daily_table()
    return forecast.future_grid(facts.item_stats(daily), 12, forecast.last_date(daily))


@query(
    "seasonal_mean_lookup",
    """SELECT item_id, months_ahead, month, round(qty_mean_item_month, 6) AS qty_mean_item_month FROM t_future""",
    {"qty_mean_item_month": 6},
)
def seasonal_mean_lookup(t: Testbed):
    return forecast.forecast_features(t.daily_table()).select("item_id", "months_ahead", "month", "qty_mean_item_month")


@query(
    "forecast_features",
    """SELECT item_id, round(qty_mean_item, 6) AS qty_mean_item, last_price, months_ahead, forecast_date, month, quarter,
              year, day, weekday, qty_lag_1, qty_lag_7, round(qty_mean_item_month, 6) AS qty_mean_item_month FROM t_future""",
    {"qty_mean_item": 6, "qty_mean_item_month": 6},
)
def forecast_features(t: Testbed):
    return forecast.forecast_features(t.daily_table())


@query(
    "forecast_detail",
    "SELECT item_id, year, month, qty_forecast, revenue_forecast FROM t_detail",
)
def forecast_detail(t: Testbed):
    return baseline_detail(t.daily_table())


@query(
    "forecast_monthly",
    "SELECT year, month, round(revenue, 2) AS revenue, round(qty, 4) AS qty FROM t_monthly",
    {"revenue": 2, "qty": 4},
)
def forecast_monthly(t: Testbed):
    return forecast.forecast_monthly(baseline_detail(t.daily_table()))


@query(
    "fitted_revenue_monthly",
    """SELECT CAST(year(d.invoice_date) AS INTEGER) AS year, CAST(month(d.invoice_date) AS INTEGER) AS month,
              round(sum(m.qty_mean_item_month * d.last_price), 2) AS revenue, round(sum(m.qty_mean_item_month), 4) AS qty
       FROM t_daily d JOIN t_month_means m ON d.item_id = m.item_id AND month(d.invoice_date) = m.month GROUP BY 1, 2""",
    {"revenue": 2, "qty": 4},
)
def fitted_revenue_monthly(t: Testbed):
    daily = t.daily_table()
    rows = daily.withColumn("month", F.month("invoice_date"))
    fitted = rows.join(forecast.month_means(daily), ["item_id", "month"], "left")
    return forecast.fitted_revenue_monthly(forecast.baseline_prediction(fitted))


@query(
    "forecast_rollup",
    """SELECT coalesce(year_month, 'TOTAL') AS year_month, coalesce(item_id, 'TOTAL') AS item_id,
              CASE WHEN grouping(item_id) = 0 THEN sum(qty_forecast) ELSE round(sum(qty_forecast), 4) END AS qty_forecast,
              CASE WHEN grouping(item_id) = 0 THEN sum(revenue_forecast) ELSE round(sum(revenue_forecast), 2) END AS revenue_forecast,
              CAST(grouping(year_month) * 2 + grouping(item_id) AS INTEGER) AS level
       FROM (SELECT *, printf('%d-%02d', year, month) AS year_month FROM t_detail)
       GROUP BY ROLLUP (year_month, item_id)""",
)
def forecast_rollup(t: Testbed):
    rows = forecast.forecast_rollup(baseline_detail(t.daily_table()))
    digits = {"qty_forecast": 4, "revenue_forecast": 2}
    return rows.withColumns({
        c: F.when(F.col("level") == 0, F.col(c)).otherwise(F.round(c, d)) for c, d in digits.items()
    })


@query(
    "fg_requirements",
    f"SELECT item_id, round(requirement, 4) AS requirement, {cell('revenue', 2)} AS revenue FROM t_fg_req",
    {"requirement": 4},
    _CELLS,
)
def fg_requirements(t: Testbed):
    return replenish.fg_requirements(baseline_detail(t.daily_table()))


@query(
    "net_fg_stock_join",
    f"""SELECT r.item_id, round(r.requirement, 4) AS requirement, {cell('r.revenue', 2)} AS revenue, s.label,
               coalesce(s.qty_on_hand, 0.0) AS qty_on_hand FROM t_fg_req r LEFT JOIN t_stock_fg s ON r.item_id = s.item_id""",
    {"requirement": 4},
    _CELLS,
)
def net_fg_stock_join(t: Testbed):
    return replenish.net_stock(replenish.fg_requirements(baseline_detail(t.daily_table())), t.stock_fg())


@query("fg_purchases", f"SELECT {_FG} FROM t_fg_plan", _ROUND, _CELLS)
def fg_purchases(t: Testbed):
    return _plan(t)["purchases_fg"]


@query(
    "coverage",
    "SELECT item_id, round(coverage_pct, 4) AS coverage_pct FROM t_fg_plan",
    {"coverage_pct": 4},
)
def coverage(t: Testbed):
    return _plan(t)["purchases_fg"].select("item_id", "coverage_pct")


@query("coverage_status", "SELECT item_id, status FROM t_fg_plan")
def coverage_status(t: Testbed):
    return _plan(t)["purchases_fg"].select("item_id", "status")


@query(
    "bom_explode",
    """SELECT fg_item, component, qty, round(purchase, 4) AS purchase, round(need, 4) AS need FROM t_edges""",
    {"purchase": 4, "need": 4},
)
def bom_explode(t: Testbed):
    return replenish.bom_explode(t.bom(), _plan(t)["purchases_fg"])


@query(
    "comp_requirements",
    "SELECT item_id, round(requirement, 4) AS requirement, n_products FROM t_comp_req",
    {"requirement": 4},
)
def comp_requirements(t: Testbed):
    return _plan(t)["requirements_comp"]


@query(
    "comp_requirements_plan",
    """SELECT count(*) AS n_components, round(sum(requirement), 4) AS requirement, max(n_products) AS max_products
       FROM t_comp_req""",
    {"requirement": 4},
)
def comp_requirements_plan(t: Testbed):
    return _plan(t)["requirements_comp"].agg(
        F.count("*").alias("n_components"),
        F.sum("requirement").alias("requirement"),
        F.max("n_products").alias("max_products"),
    )


@query(
    "net_comp_stock_join",
    """SELECT r.item_id, round(r.requirement, 4) AS requirement, r.n_products, s.label,
              coalesce(s.qty_on_hand, 0.0) AS qty_on_hand FROM t_comp_req r LEFT JOIN t_stock_comp s ON r.item_id = s.item_id""",
    {"requirement": 4},
)
def net_comp_stock_join(t: Testbed):
    return replenish.net_stock(_plan(t)["requirements_comp"], t.stock_comp())


@query("comp_purchases", f"SELECT {_COMP} FROM t_comp_plan", _ROUND)
def comp_purchases(t: Testbed):
    return _plan(t)["purchases_comp"]


@query(
    "final_stock",
    """SELECT 'fg' AS kind, item_id, round(final_stock, 4) AS final_stock FROM t_fg_plan
       UNION ALL SELECT 'comp', item_id, round(final_stock, 4) FROM t_comp_plan""",
    _ROUND,
)
def final_stock(t: Testbed):
    plan = _plan(t, stage=True)
    parts = [
        plan[f"final_stock_{kind}"].select(F.lit(kind).alias("kind"), "item_id", "final_stock")
        for kind in ("fg", "comp")
    ]
    return parts[0].unionByName(parts[1])


_PIPE = """item_id, round(requirement, 4) AS requirement, qty_on_hand, round(purchase, 4) AS purchase,
 round(coverage_pct, 4) AS coverage_pct, status, round(final_stock, 4) AS final_stock"""


@query(
    "plan_pipeline",
    f"SELECT 'fg' AS kind, {_PIPE} FROM t_fg_plan UNION ALL SELECT 'comp', {_PIPE} FROM t_comp_plan",
    _ROUND,
)
def plan_pipeline(t: Testbed):
    plan = run_planning(baseline_detail(t.daily_table()), t.bom(), t.stock_fg(), t.stock_comp(), stage=True)
    columns = ["item_id", "requirement", "qty_on_hand", "purchase", "coverage_pct", "status", "final_stock"]
    parts = [
        plan[f"final_stock_{kind}"].select(F.lit(kind).alias("kind"), *columns) for kind in ("fg", "comp")
    ]
    return parts[0].unionByName(parts[1])


_KPI = """SELECT '{kind}' AS kind, count(*) AS n_items, count(*) FILTER (purchase > 0) AS n_to_buy,
 count(*) FILTER (purchase = 0) AS n_covered, count(*) FILTER (status = 'stockout_risk') AS n_stockout_risk,
 round(sum(requirement), 4) AS requirement, sum(qty_on_hand) AS qty_on_hand, round(sum(purchase), 4) AS purchase,
 round(sum(final_stock), 4) AS final_stock FROM {table}"""


@query(
    "plan_kpis",
    _KPI.format(kind="fg", table="t_fg_plan") + " UNION ALL " + _KPI.format(kind="comp", table="t_comp_plan"),
    {"requirement": 4, "purchase": 4, "final_stock": 4},
)
def plan_kpis(t: Testbed):
    plan = _plan(t, stage=True)
    parts = [
        replenish.plan_kpis(plan[f"final_stock_{kind}"]).select(F.lit(kind).alias("kind"), "*")
        for kind in ("fg", "comp")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "plan_with_total",
    """SELECT coalesce(item_id, 'TOTAL') AS item_id, round(sum(requirement), 4) AS requirement,
              sum(qty_on_hand) AS qty_on_hand, round(sum(purchase), 4) AS purchase,
              CAST(grouping(item_id) AS INTEGER) AS is_total
       FROM t_fg_plan GROUP BY ROLLUP (item_id)""",
    {"requirement": 4, "purchase": 4},
)
def plan_with_total(t: Testbed):
    return replenish.plan_with_total(_plan(t)["purchases_fg"])


@query("plan_sorted", f"SELECT {_FG} FROM t_fg_plan ORDER BY purchase DESC, item_id", _ROUND, _CELLS)
def plan_sorted(t: Testbed):
    return replenish.plan_sorted(_plan(t)["purchases_fg"])


@query(
    "to_buy_filter",
    f"SELECT {_COMP} FROM t_comp_plan WHERE purchase > 0 ORDER BY purchase DESC, item_id",
    _ROUND,
)
def to_buy_filter(t: Testbed):
    return replenish.to_buy(_plan(t)["purchases_comp"])
