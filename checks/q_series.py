"""Time-series operators and the isolation forest."""

from pyspark.sql import functions as F

from checks.registry import query, tables
from checks.testbed import Testbed
from tidestock.models.isolation import isolation_forest
from tidestock.operators import facts, features, outliers, series, windows
from tidestock.session import staged

tables(
    t_item_days="SELECT item_id AS series_id, invoice_date, sum(qty) AS qty FROM t_lines GROUP BY ALL",
    t_item_filled="""
SELECT s.series_id, CAST(d AS DATE) AS invoice_date, coalesce(i.qty, 0.0) AS qty
FROM (SELECT series_id, unnest(generate_series(min(invoice_date), max(invoice_date), INTERVAL 1 DAY)) AS d
      FROM t_item_days GROUP BY series_id) s
LEFT JOIN t_item_days i ON i.series_id = s.series_id AND i.invoice_date = CAST(d AS DATE)""",
)


def _unit_root(source: str) -> str:
    return f"""
SELECT series_id, CAST(n AS INTEGER) AS n_changes, round(t, 6) AS t_stat,
       CASE WHEN t IS NULL THEN NULL WHEN t < -2.86 THEN 0 ELSE 1 END AS d
FROM (SELECT series_id, n, CASE WHEN n >= 3 AND sxx > 1e-12 * ss AND syy - slope * sxy > 1e-12 * ss
             THEN slope / sqrt((syy - slope * sxy) / (n - 2) / sxx) END AS t
      FROM (SELECT series_id, count(before) AS n, sum(z * z) AS ss, regr_slope(z - before, before) AS slope,
                   regr_sxx(z - before, before) AS sxx, regr_sxy(z - before, before) AS sxy, regr_syy(z - before, before) AS syy
            FROM (SELECT *, lag(z) OVER (PARTITION BY series_id ORDER BY invoice_date) AS before
                  FROM (SELECT *, qty - avg(qty) OVER (PARTITION BY series_id) AS z FROM {source}))
            GROUP BY series_id))"""


def _items(t: Testbed):
    return series.as_series(t.sales_lines())


def _total(t: Testbed):
    return series.as_series(t.sales_lines(), by=None)


@query("stationarity_d", _unit_root("t_item_filled"), {"t_stat": 6})
def stationarity_d(t: Testbed):
    return series.stationarity(_items(t))


@query(
    "stationarity_total",
    _unit_root("(SELECT 'TOTAL' AS series_id, invoice_date, qty FROM t_filled)"),
    {"t_stat": 6},
)
def stationarity_total(t: Testbed):
    return series.stationarity(_total(t))


@query(
    "stationarity_lag_1",
    """
SELECT series_id, CAST(n AS INTEGER) AS n_changes, 1 AS lags, round(b / sqrt((syy - b * sxy - c * swy) / (n - 3) * sww / det), 6) AS t_stat
FROM (SELECT *, (sww * sxy - sxw * swy) / det AS b, (sxx * swy - sxw * sxy) / det AS c
      FROM (SELECT *, sxx * sww - sxw * sxw AS det
            FROM (SELECT series_id, count(*) AS n, var_pop(x) * n AS sxx, var_pop(w) * n AS sww, covar_pop(x, w) * n AS sxw,
                         covar_pop(x, y) * n AS sxy, covar_pop(w, y) * n AS swy, var_pop(y) * n AS syy
                  FROM (SELECT series_id, lag(z) OVER p AS x, lag(z) OVER p - lag(z, 2) OVER p AS w, z - lag(z) OVER p AS y
                        FROM (SELECT *, qty - avg(qty) OVER (PARTITION BY series_id) AS z,
                                     count(*) OVER (PARTITION BY series_id) AS days FROM t_item_filled) WHERE days >= 30
                        WINDOW p AS (PARTITION BY series_id ORDER BY invoice_date))
                  WHERE w IS NOT NULL GROUP BY series_id)))""",
    {"t_stat": 6},
)
def stationarity_lag_1(t: Testbed):
    """One lagged change, on series of 30 days at least (shorter ones may have no residual variance)."""
    tested = series.augmented_stationarity(_items(t), 1, False)
    return tested.where("n_changes >= 28").select("series_id", "n_changes", "lags", "t_stat")


@query("stationarity_augmented")
def stationarity_augmented(t: Testbed):
    """Lagged changes chosen by AIC, with p-values."""
    return series.augmented_stationarity(_items(t))


@query(
    "difference_series",
    "SELECT invoice_date, qty, qty - lag(qty) OVER (ORDER BY invoice_date) AS change FROM t_filled",
)
def difference_series(t: Testbed):
    filled = features.gap_fill_daily(facts.daily_total_series(t.sales_lines()))
    return windows.difference(filled, "qty", "change")


@query(
    "future_days",
    """SELECT series_id, CAST(k AS INTEGER) AS step, CAST(max(invoice_date) + CAST(k AS INTEGER) AS DATE) AS forecast_date
       FROM t_item_days, range(1, 31) r(k) GROUP BY series_id, k""",
)
def future_days(t: Testbed):
    return series.future_days(_items(t), 30)


_TEST_DAYS = """
 (SELECT l.series_id, coalesce(a.qty, 0.0) AS a, coalesce(p.qty, 0.0) AS p
  FROM (SELECT series_id, max(invoice_date) AS last, CAST(k AS INTEGER) AS j FROM t_item_days, range(0, 30) r(k) GROUP BY series_id, k) l
  LEFT JOIN t_item_days a ON a.series_id = l.series_id AND a.invoice_date = l.last - 29 + l.j
  LEFT JOIN t_item_days p ON p.series_id = l.series_id AND p.invoice_date = l.last - 36 + (l.j % 7))"""


@query(
    "series_backtest",
    f"""SELECT series_id, count(*) AS n_rows, round(1 - sum((a - p) ** 2) / nullif(var_pop(a) * count(*), 0), 6) AS r2,
              round(avg(abs(a - p)), 6) AS mae, round(sqrt(avg((a - p) ** 2)), 6) AS rmse
       FROM {_TEST_DAYS} GROUP BY series_id""",
    {"r2": 6, "mae": 6, "rmse": 6},
)
def series_backtest(t: Testbed):
    return series.naive_backtest(_items(t))


HORIZON, MULTIPLE = 360, 5.0
FORECASTERS = {
    "arima": series.arima_forecast, "seasonal_trend": series.seasonal_trend_forecast, "recursive_lag": series.recursive_lag_forecast,
}


def _distinct_steps():
    """Number of different steps of 1 to ``HORIZON``, as bits of a few numbers: partial counts are a row for each series."""
    place, words = F.col("step") - 1, -(-HORIZON // 63)
    inside = F.col("step").between(1, HORIZON)
    bit = F.expr("shiftleft(1L, (step - 1) % 63)")
    masks = [F.bit_or(F.when(inside & (F.floor(place / 63) == w), bit).otherwise(F.lit(0).cast("long"))) for w in range(words)]
    return sum((F.bit_count(m).cast("long") for m in masks), F.count_if(~inside))


def forecast_contract(items, forecast):
    """Per series: steps, dates, and how many rows are finite, not negative and within a multiple of the history.

    The rows are summed up where they are made, not shuffled. All sound rows of a series are within the multiple if
    the highest is; only the series where it is not are forecast again, and their rows compared one by one.
    """
    highest = items.groupBy("series_id").agg((MULTIPLE * F.max("qty")).alias("most"))
    qty = F.col("qty_forecast")

    def sound(rows):
        good = ~F.isnan(qty) & (qty >= 0)
        if "qty_lower" in rows.columns:
            good = good & (F.col("qty_lower") <= qty) & (qty <= F.col("qty_upper"))
        return good

    rows = forecast(items, HORIZON)
    sums = rows.groupBy("series_id").agg(
        F.count("*").alias("n_rows"), _distinct_steps().alias("n_steps"), F.min("forecast_date").alias("first_date"),
        F.max("forecast_date").alias("last_date"), F.sum(sound(rows).cast("long")).alias("n_good"),
        F.max(F.when(sound(rows), qty)).alias("top"),
    )
    sums = staged(sums.join(highest, "series_id"), "contract")
    above = sums.where(F.col("top") > F.col("most")).select("series_id", "most")
    if not above.isEmpty():
        again = forecast(items.join(above, "series_id", "left_semi"), HORIZON).join(above, "series_id")
        within = again.groupBy("series_id").agg(F.sum((sound(again) & (qty <= F.col("most"))).cast("long")).alias("n_within"))
        sums = sums.join(within, "series_id", "left").withColumn("n_good", F.coalesce("n_within", "n_good"))
    return sums.select("series_id", "n_rows", "n_steps", "first_date", "last_date", "n_good")


def _contract(name: str):
    return lambda t: forecast_contract(staged(_items(t), "item-series"), FORECASTERS[name])


for _name, _query in (
    ("arima", "arima_bounds"), ("seasonal_trend", "seasonal_trend_contract"), ("recursive_lag", "recursive_contract"),
):
    query(_query, """
SELECT series_id, 360 AS n_rows, 360 AS n_steps, CAST(max(invoice_date) + 1 AS DATE) AS first_date,
       CAST(max(invoice_date) + 360 AS DATE) AS last_date, 360 AS n_good FROM t_item_days GROUP BY series_id""")(_contract(_name))


@query(
    "degenerate_forecasts",
    """SELECT model, series_id, CAST(k AS INTEGER) AS step, CAST(max(invoice_date) + CAST(k AS INTEGER) AS DATE) AS forecast_date,
              max(qty) AS qty_forecast, false AS fitted
       FROM (SELECT item_id || '|' || strftime(invoice_date, '%Y-%m') AS series_id, invoice_date, sum(qty) AS qty FROM t_lines GROUP BY ALL),
            range(1, 6) r(k), (VALUES ('arima'), ('seasonal_trend'), ('recursive_lag')) m(model)
       GROUP BY model, series_id, k
       HAVING min(qty) = max(qty) AND count(*) = date_diff('day', min(invoice_date), max(invoice_date)) + 1""",
)
def degenerate_forecasts(t: Testbed):
    """Items by month: many series of one day or without variation, which go on as they are."""
    lines = t.sales_lines().withColumn("item_month", F.concat_ws("|", "item_id", F.date_format("invoice_date", "yyyy-MM")))
    every = series.as_series(lines, by="item_month")
    days = F.datediff(F.max("invoice_date"), F.min("invoice_date")) + 1
    flat = every.groupBy("series_id").agg(
        (F.min("qty") == F.max("qty")).alias("even"), (F.count("*") == days).alias("whole")
    ).where("even and whole")
    rows = staged(every.join(flat, "series_id", "left_semi"), "flat-series")
    out = None
    for name, forecast in FORECASTERS.items():
        part = forecast(rows, 5).select(
            F.lit(name).alias("model"), "series_id", "step", "forecast_date", "qty_forecast", "fitted"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "series_model_backtest",
    """SELECT model, series_id, 30 AS n_rows, true AS is_consistent
       FROM (SELECT DISTINCT series_id FROM t_item_days), (VALUES ('arima'), ('seasonal_trend'), ('recursive_lag')) m(model)""",
)
def series_model_backtest(t: Testbed):
    """Every item's back-test of every fitted model: a row each, with errors in their order."""
    return _item_scores(t).select(
        "model", "series_id", "n_rows",
        ((F.col("mae") >= 0) & (F.col("mae") <= F.col("rmse") + 1e-9) & (F.coalesce("r2", F.lit(0.0)) <= 1)).alias("is_consistent"),
    )


def _item_scores(t: Testbed):
    items, out = staged(_items(t), "item-series"), None
    for name, forecast in FORECASTERS.items():
        part = series.model_backtest(items, forecast).withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query("series_model_backtest_rows")
def series_model_backtest_rows(t: Testbed):
    return _item_scores(t)


@query("arima_forecast")
def arima_forecast(t: Testbed):
    return series.arima_forecast(_items(t), HORIZON)


@query("arima_forecast_total")
def arima_forecast_total(t: Testbed):
    return series.arima_forecast(_total(t), HORIZON)


@query("seasonal_trend_forecast")
def seasonal_trend_forecast(t: Testbed):
    return series.seasonal_trend_forecast(_items(t), HORIZON)


@query("seasonal_trend_forecast_total")
def seasonal_trend_forecast_total(t: Testbed):
    return series.seasonal_trend_forecast(_total(t), HORIZON)


@query("recursive_lag_forecast")
def recursive_lag_forecast(t: Testbed):
    return series.recursive_lag_forecast(_items(t), HORIZON)


@query("recursive_lag_forecast_total")
def recursive_lag_forecast_total(t: Testbed):
    return series.recursive_lag_forecast(_total(t), HORIZON)


@query("isolation_forest")
def isolation(t: Testbed):
    return isolation_forest(t.daily_table(spiked=True), "qty", ["item_id", "invoice_date", "site"])


@query(
    "isolation_contract",
    """SELECT item_id, invoice_date, site, qty, 1 AS n_rows, true AS is_score, true AS is_equal, true AS is_flag, true AS is_share
       FROM t_spiked""",
)
def isolation_contract(t: Testbed):
    """Each row once, scores in (0, 1) and equal for equal values, -1 exactly above the 95 % quantile, at most 5 % of the rows."""
    rows = staged(isolation(t), "forest")
    whole = rows.agg(
        F.percentile("score", 0.95).alias("cut"), (F.count_if(F.col("anomaly") == -1) <= 0.05 * F.count("*")).alias("is_share")
    ).first()
    flagged = F.col("anomaly") == -1
    same = rows.groupBy("qty").agg(
        (F.min("score") == F.max("score")).alias("is_equal"), (F.count_distinct("anomaly") == 1).alias("is_one_flag")
    )
    keyed = rows.groupBy("item_id", "invoice_date", "site", "qty").agg(
        F.count("*").cast("int").alias("n_rows"), F.min("score").alias("score"), F.min("anomaly").alias("anomaly")
    )
    return keyed.join(same, "qty").select(
        "item_id", "invoice_date", "site", "qty", "n_rows", F.col("score").between(1e-9, 1 - 1e-9).alias("is_score"),
        F.col("is_equal"), (F.col("is_one_flag") & (flagged == (F.col("score") > F.lit(whole["cut"]) + 1e-12))).alias("is_flag"),
        F.lit(whole["is_share"]).alias("is_share"),
    )


@query("outlier_labels_with_forest")
def outlier_labels_with_forest(t: Testbed):
    labelled = outliers.outlier_labels(t.daily_table(spiked=True))
    return isolation_forest(labelled, "qty", ["item_id", "invoice_date", "site"])


@query("isolation_forest_share")
def isolation_share(t: Testbed):
    flagged = isolation_forest(t.daily_table(spiked=True), "qty", ["item_id", "invoice_date", "site"])
    return flagged.groupBy("anomaly").agg(
        F.count("*").alias("n_rows"), F.min("score").alias("min_score"), F.max("score").alias("max_score")
    )


@query(
    "describe_after_cleaning",
    """SELECT count(qty) AS n, round(avg(qty), 6) AS mean, round(stddev_samp(qty), 6) AS std, min(qty) AS min,
              quantile_cont(qty, 0.25) AS p25, quantile_cont(qty, 0.5) AS p50, quantile_cont(qty, 0.75) AS p75, max(qty) AS max
       FROM t_spiked, t_bounds WHERE qty BETWEEN lower_bound AND upper_bound""",
    {"mean": 6, "std": 6},
)
def describe_after_cleaning(t: Testbed):
    return facts.describe(outliers.clean(t.daily_table(spiked=True)), "qty")
