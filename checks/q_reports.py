"""Report tables: rankings, shares, distributions, comparisons."""

from pyspark.sql import functions as F

from checks.registry import cell, query
from checks.testbed import Testbed
from tidestock.operators import facts, forecast, metrics, outliers, reports, splits
from tidestock.plans.planning import baseline_detail, run_planning

_TOP = "item_id, round(requirement, 4) AS requirement, qty_on_hand, round(purchase, 4) AS purchase"
_ROUND = {"requirement": 4, "purchase": 4, "coverage_pct": 4, "stock_after": 4}
_BAND = """CASE WHEN coverage_pct < 25 THEN 'stockout_risk' WHEN coverage_pct < 75 THEN 'low_stock' ELSE 'sufficient' END AS band"""


def _plan(t: Testbed, stage: bool = False):
    return run_planning(baseline_detail(t.daily_table()), t.bom(), t.stock_fg(), t.stock_comp(), stage)


@query("top_requirements", f"SELECT {_TOP} FROM t_fg_plan ORDER BY t_fg_plan.requirement DESC, item_id LIMIT 20", _ROUND)
def top_requirements(t: Testbed):
    return reports.top_requirements(_plan(t)["purchases_fg"])


@query(
    "lowest_coverage_fg",
    f"""SELECT item_id, round(coverage_pct, 4) AS coverage_pct, {_BAND} FROM t_fg_plan
        ORDER BY t_fg_plan.coverage_pct, item_id LIMIT 20""",
    _ROUND,
)
def lowest_coverage_fg(t: Testbed):
    return reports.lowest_coverage(_plan(t)["purchases_fg"])


@query(
    "lowest_coverage_comp",
    f"""SELECT item_id, round(coverage_pct, 4) AS coverage_pct, {_BAND} FROM t_comp_plan
        ORDER BY t_comp_plan.coverage_pct, item_id LIMIT 20""",
    _ROUND,
)
def lowest_coverage_comp(t: Testbed):
    return reports.lowest_coverage(_plan(t)["purchases_comp"])


@query(
    "top_comp_purchases",
    f"SELECT {_TOP} FROM t_comp_plan WHERE purchase > 0 ORDER BY t_comp_plan.purchase DESC, item_id LIMIT 20",
    _ROUND,
)
def top_comp_purchases(t: Testbed):
    return reports.top_purchases(_plan(t)["purchases_comp"], 20)


@query(
    "top10_purchases",
    f"""SELECT * FROM (SELECT {_TOP}, 'fg' AS kind FROM t_fg_plan WHERE purchase > 0
                       ORDER BY t_fg_plan.purchase DESC, item_id LIMIT 10)
        UNION ALL SELECT * FROM (SELECT {_TOP}, 'comp' AS kind FROM t_comp_plan WHERE purchase > 0
                                 ORDER BY t_comp_plan.purchase DESC, item_id LIMIT 10)""",
    _ROUND,
)
def top10_purchases(t: Testbed):
    plan = _plan(t, stage=True)
    return reports.top10_purchases(plan["purchases_fg"], plan["purchases_comp"])


_STOCK = "item_id, qty_on_hand AS stock_before, round(final_stock, 4) AS stock_after"


@query(
    "lowest_final_stock",
    f"""SELECT * FROM (SELECT {_STOCK}, 'fg' AS kind FROM t_fg_plan ORDER BY final_stock, item_id LIMIT 15)
        UNION ALL SELECT * FROM (SELECT {_STOCK}, 'comp' AS kind FROM t_comp_plan ORDER BY final_stock, item_id LIMIT 15)""",
    _ROUND,
)
def lowest_final_stock(t: Testbed):
    plan = _plan(t, stage=True)
    return reports.lowest_final_stock(plan["final_stock_fg"], plan["final_stock_comp"])


@query("stock_before_after", f"SELECT {_STOCK} FROM t_comp_plan", _ROUND)
def stock_before_after(t: Testbed):
    return reports.stock_before_after(_plan(t)["final_stock_comp"])


@query(
    "status_share",
    """SELECT status, count(*) AS n_items, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct
       FROM t_fg_plan WHERE status IS NOT NULL GROUP BY status""",
    {"share_pct": 6},
)
def status_share(t: Testbed):
    return reports.status_share(_plan(t)["purchases_fg"])


@query(
    "monthly_label_series",
    "SELECT printf('%d-%02d', year, month) AS label, round(revenue, 2) AS revenue, round(qty, 4) AS qty FROM t_monthly",
    {"revenue": 2, "qty": 4},
)
def monthly_label_series(t: Testbed):
    return reports.monthly_label_series(_plan(t)["monthly_revenue"])


def _histogram_sql(table: str, column: str, bins: int) -> str:
    return f"""
SELECT CAST(b AS INTEGER) AS bin, round(lo + b * w, 6) AS bin_from, round(lo + (b + 1) * w, 6) AS bin_to,
       count(x) AS n_rows
FROM (SELECT min({column}) AS lo, (max({column}) - min({column})) / {bins} AS w FROM {table}) l
CROSS JOIN range({bins}) r(b)
LEFT JOIN (SELECT {column} AS x FROM {table}) s
  ON least(floor((x - lo) / w), {bins - 1}) = b GROUP BY b, lo, w"""


@query("histogram", _histogram_sql("t_spiked", "qty", 50), {"bin_from": 6, "bin_to": 6})
def histogram(t: Testbed):
    return reports.histogram(t.daily_table(spiked=True), "qty", 50)


@query("histogram_prices", _histogram_sql("t_daily", "last_price", 40), {"bin_from": 6, "bin_to": 6})
def histogram_prices(t: Testbed):
    return reports.histogram(t.daily_table(), "last_price", 40)


@query(
    "boxplot_stats",
    """SELECT q1, median, q3, min(qty) FILTER (qty BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
              max(qty) FILTER (qty BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
              count(*) FILTER (NOT (qty BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers
       FROM t_spiked, (SELECT quantile_cont(qty, 0.25) AS q1, quantile_cont(qty, 0.5) AS median, quantile_cont(qty, 0.75) AS q3 FROM t_spiked)
       GROUP BY q1, median, q3""",
)
def boxplot_stats(t: Testbed):
    return reports.boxplot_stats(t.daily_table(spiked=True), "qty")


@query(
    "qq_points",
    """SELECT unnest(range(1, 100)) / 100.0 AS probability,
              round(unnest(quantile_cont(qty, list_transform(range(1, 100), lambda i: i / 100.0))), 6) AS sample_quantile
       FROM t_spiked""".replace("/ 100.0 AS probability", "::DOUBLE / 100 AS probability"),
    {"sample_quantile": 6},
)
def qq_points(t: Testbed):
    return reports.qq_points(t.daily_table(spiked=True), "qty").drop("normal_quantile")


# --- evaluation on deterministic predictors ---------------------------------------------

_SCORED = """SELECT d.*, avg(qty) OVER (PARTITION BY item_id, month) AS seasonal,
 avg(qty) OVER (PARTITION BY item_id) AS item_mean FROM t_dated d"""
_LONG = f"""SELECT 'seasonal_mean' AS model, qty AS actual, seasonal AS prediction FROM ({_SCORED})
 UNION ALL SELECT 'item_mean', qty, item_mean FROM ({_SCORED})"""
_METRICS = f"""SELECT model, count(*) AS n_rows, 1 - sum((actual - prediction) ** 2) / (var_pop(actual) * count(*)) AS r2,
 avg(abs(actual - prediction)) AS mae, sqrt(avg((actual - prediction) ** 2)) AS rmse FROM ({_LONG}) GROUP BY model"""
_M_ROUND = {"r2": 6, "mae": 6, "rmse": 6, "mape_all": 6, "mape_positive": 6, "mape": 6, "r2_to_target": 6}


def scored_long(t: Testbed):
    """Actual and two deterministic predictions per daily row, one row per model."""
    from tidestock.operators.windows import group_means

    rows = t.daily_table().withColumn("month", F.month("invoice_date"))
    means = group_means(rows, "item_id", "month", "qty", "item_mean", "seasonal_mean")
    models = F.map_from_arrays(
        F.array(F.lit("seasonal_mean"), F.lit("item_mean")), F.array("seasonal_mean", "item_mean")
    )
    return means.select(
        "item_id", "invoice_date", "last_price", F.col("qty").alias("actual"),
        F.explode(models).alias("model", "prediction"),
    )


@query(
    "baseline_seasonal_mean",
    f"""SELECT item_id, invoice_date, site, qty, round(seasonal, 6) AS prediction FROM ({_SCORED})""",
    {"prediction": 6},
)
def baseline_seasonal_mean(t: Testbed):
    daily = t.daily_table()
    rows = daily.withColumn("month", F.month("invoice_date"))
    fitted = forecast.baseline_prediction(rows.join(forecast.month_means(daily), ["item_id", "month"], "left"))
    return fitted.select("item_id", "invoice_date", "site", "qty", "prediction")


@query(
    "metrics",
    f"SELECT model, n_rows, round(r2, 6) AS r2, round(mae, 6) AS mae, round(rmse, 6) AS rmse FROM ({_METRICS})",
    _M_ROUND,
)
def metric_table(t: Testbed):
    return metrics.regression_metrics(scored_long(t), ["model"])


_MAPE = """round(avg(abs((actual - prediction) / CASE WHEN actual = 0 THEN 1 ELSE actual END)) * 100, 6)"""


@query(
    "mape_variants",
    f"""SELECT model, {_MAPE} AS mape_all,
               round(avg(CASE WHEN actual > 0 THEN abs((actual - prediction) / actual) END) * 100, 6) AS mape_positive
        FROM (SELECT model, actual - 20 AS actual, prediction - 20 AS prediction FROM ({_LONG})) GROUP BY model""",
    _M_ROUND,
)
def mape_variants(t: Testbed):
    shifted = scored_long(t).withColumns({"actual": F.col("actual") - 20, "prediction": F.col("prediction") - 20})
    return metrics.mape_table(shifted, ["model"])


@query(
    "quality_verdict",
    f"""SELECT model, r2_ok, mape_class FROM (
          SELECT model, 1 - sum((actual - prediction) ** 2) / (var_pop(actual) * count(*)) >= 0.85 AS r2_ok,
                 CASE WHEN {_MAPE} < 15 THEN 'good' WHEN {_MAPE} < 25 THEN 'acceptable' ELSE 'high' END AS mape_class
          FROM ({_LONG}) GROUP BY model)""",
)
def quality_verdict(t: Testbed):
    rows = scored_long(t)
    scores = metrics.regression_metrics(rows, ["model"]).join(metrics.mape_table(rows, ["model"]), "model")
    verdict = metrics.quality_verdict(scores.withColumn("mape", F.col("mape_all")))
    return verdict.select("model", "r2_ok", "mape_class")


@query(
    "compare_models",
    f"""SELECT model, n_rows, round(r2, 6) AS r2, round(mae, 6) AS mae, round(rmse, 6) AS rmse,
               CAST(model = arg_max(model, r2) OVER () AS INTEGER) AS is_best FROM ({_METRICS})""",
    _M_ROUND,
)
def compare_models(t: Testbed):
    return metrics.compare_models(metrics.regression_metrics(scored_long(t), ["model"]))


@query(
    "model_comparison_table",
    f"SELECT model, round(r2, 6) AS r2, round(mae, 6) AS mae, round(r2 - 0.7, 6) AS r2_to_target FROM ({_METRICS})",
    _M_ROUND,
)
def model_comparison_table(t: Testbed):
    return reports.model_comparison(metrics.regression_metrics(scored_long(t), ["model"]))


_GAP = f"""SELECT item_id, sum(qty) AS qty_actual, sum(seasonal) AS qty_predicted, avg(last_price) AS mean_price,
 sum(qty * last_price) AS revenue_actual, sum(seasonal * last_price) AS revenue_predicted
 FROM ({_SCORED}) WHERE date_trunc('month', invoice_date) = (SELECT date_trunc('month', max(invoice_date)) FROM t_daily) GROUP BY item_id"""
_GAP_PCT = "CASE WHEN {a} = 0 THEN 0 ELSE ({p} - {a}) * 100 / {a} END"
_G_CELLS = {"qty_predicted": 4, "mean_price": 4, "revenue_actual": 3, "revenue_predicted": 3, "gap_pct": 4}
_G = {name: f"{cell(name, digits)} AS {name}" for name, digits in _G_CELLS.items()}
_V_CELLS = {name: digits for name, digits in _G_CELLS.items() if name != "mean_price"}


def month_gap(t: Testbed):
    rows = scored_long(t).where(F.col("model") == "seasonal_mean")
    return metrics.revenue_gap(splits.holdout_month_split(rows)[1])


@query(
    "holdout_revenue_gap",
    f"""SELECT item_id, qty_actual, {', '.join(_G.values())}
        FROM (SELECT *, {_GAP_PCT.format(a='revenue_actual', p='revenue_predicted')} AS gap_pct FROM ({_GAP}))""",
    cells=_G_CELLS,
)
def holdout_revenue_gap(t: Testbed):
    return month_gap(t)


@query(
    "holdout_revenue_gap_total",
    f"""SELECT qty_actual, round(qty_predicted, 4) AS qty_predicted, round(revenue_actual, 2) AS revenue_actual,
               round(revenue_predicted, 2) AS revenue_predicted,
               round({_GAP_PCT.format(a='revenue_actual', p='revenue_predicted')}, 4) AS gap_pct
        FROM (SELECT sum(qty_actual) AS qty_actual, sum(qty_predicted) AS qty_predicted, sum(revenue_actual) AS revenue_actual,
                     sum(revenue_predicted) AS revenue_predicted FROM ({_GAP}))""",
    {"qty_predicted": 4, "revenue_actual": 2, "revenue_predicted": 2, "gap_pct": 4},
)
def holdout_revenue_gap_total(t: Testbed):
    return metrics.revenue_gap_total(month_gap(t))


@query(
    "validation_table",
    f"""SELECT item_id, qty_actual, {', '.join(_G[name] for name in _V_CELLS)}, CAST(abs(gap_pct) > 10 AS INTEGER) AS is_outside
        FROM (SELECT *, {_GAP_PCT.format(a='revenue_actual', p='revenue_predicted')} AS gap_pct FROM ({_GAP}))""",
    cells=_V_CELLS,
)
def validation_table(t: Testbed):
    return reports.validation_table(month_gap(t))


@query(
    "cleaning_growth",
    """SELECT (SELECT count(*) FROM t_spiked) AS n_before, count(*) AS n_after,
              round((count(*) - (SELECT count(*) FROM t_spiked)) * 100.0 / (SELECT count(*) FROM t_spiked), 6) AS growth_pct
       FROM t_spiked, t_bounds WHERE qty BETWEEN lower_bound AND upper_bound""",
    {"growth_pct": 6},
)
def cleaning_growth(t: Testbed):
    daily = t.daily_table(spiked=True)
    return reports.growth(daily, outliers.clean(daily))


@query("value_counts_status", "SELECT status, count(*) AS n_rows FROM t_fg_plan WHERE status IS NOT NULL GROUP BY 1")
def value_counts_status(t: Testbed):
    return facts.value_counts(_plan(t)["purchases_fg"], "status")
