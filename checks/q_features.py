"""Filters, splits, windows, encodings, features and outliers."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.testbed import EVENT_NAMES, Testbed
from tidestock.functions.numeric import floor_zero, one_row
from tidestock.operators import encoding, facts, features, outliers, splits, windows


def _series(t: Testbed):
    return features.gap_fill_daily(facts.daily_total_series(t.sales_lines()))


def feature_rows(t: Testbed):
    """Feature table built from a staged daily fact."""
    return features.feature_table(t.daily_table())


# --- projections, filters, splits -------------------------------------------------------


@query("filter_item", "SELECT * FROM t_daily WHERE item_id = 'ART00000007'")
def filter_item(t: Testbed):
    return splits.filter_item(t.daily(), "ART00000007")


@query(
    "select_available_features",
    """SELECT CAST(day(invoice_date) AS INTEGER) AS day, CAST(year(invoice_date) AS INTEGER) AS year,
              CAST(isodow(invoice_date) - 1 AS INTEGER) AS weekday, item_id, CAST(month(invoice_date) AS INTEGER) AS month,
              CAST(quarter(invoice_date) AS INTEGER) AS quarter, qty FROM t_daily""",
)
def select_available_features(t: Testbed):
    return features.select_features(features.date_features(t.daily()))


@query(
    "drop_incomplete",
    """SELECT * FROM (SELECT *, lag(qty, 7) OVER (PARTITION BY item_id ORDER BY invoice_date, site) AS qty_lag_7,
                             lag(qty, 1) OVER (PARTITION BY item_id ORDER BY invoice_date, site) AS qty_lag_1 FROM t_daily)
       WHERE qty_lag_7 IS NOT NULL AND qty_lag_1 IS NOT NULL AND last_price IS NOT NULL""",
)
def drop_incomplete(t: Testbed):
    return features.drop_incomplete(features.lag_features(t.daily_table()))


@query(
    "clip_nonneg",
    "SELECT item_id, invoice_date, site, greatest(qty - 25, 0) AS qty FROM t_daily",
)
def clip_nonneg(t: Testbed):
    return t.daily().select("item_id", "invoice_date", "site", floor_zero(F.col("qty") - 25).alias("qty"))


@query(
    "holdout_month_split",
    """SELECT CASE WHEN date_trunc('month', invoice_date) = (SELECT date_trunc('month', max(invoice_date)) FROM t_daily)
                   THEN 'test' ELSE 'train' END AS side, count(*) AS n_rows, sum(qty) AS qty FROM t_daily GROUP BY 1""",
)
def holdout_month_split(t: Testbed):
    train, test = splits.holdout_month_split(t.daily_table())
    parts = [
        side.agg(F.count("*").alias("n_rows"), F.sum("qty").alias("qty")).select(F.lit(tag).alias("side"), "*")
        for tag, side in (("train", train), ("test", test))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "holdout_given_month",
    "SELECT * FROM t_daily WHERE year(invoice_date) = 1999 AND month(invoice_date) = 5",
)
def holdout_given_month(t: Testbed):
    return splits.holdout_month_split(t.daily_table(), 1999, 5)[1]


@query(
    "tail_split",
    """SELECT item_id, invoice_date, qty,
              CASE WHEN row_number() OVER (PARTITION BY item_id ORDER BY invoice_date DESC) <= 5 THEN 'test' ELSE 'train' END AS side
       FROM (SELECT item_id, invoice_date, sum(qty) AS qty FROM t_lines GROUP BY ALL)""",
)
def tail_split(t: Testbed):
    train, test = splits.tail_split(facts.daily_total_series(t.sales_lines(), by=["item_id"]), 5, ["item_id"])
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


_U = "('0x' || substr(md5(item_id || '|' || invoice_date || '|' || site || '-{salt}'), 1, 13))::BIGINT / 4503599627370496.0"


@query(
    "random_split",
    f"""SELECT item_id, invoice_date, site, qty, CASE WHEN {_U.format(salt='split-42')} < 0.2 THEN 'test' ELSE 'train' END AS side
        FROM t_daily""",
)
def random_split(t: Testbed):
    train, test = splits.random_split(t.daily_table().drop("last_price"), ["item_id", "invoice_date", "site"])
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


# --- joins and windows ------------------------------------------------------------------


@query(
    "calendar_event_flags",
    "SELECT invoice_date, qty, is_fast, is_feast_1, is_feast_2, is_summer FROM t_flagged",
)
def calendar_event_flags(t: Testbed):
    return features.event_flags(_series(t), t.calendar_events(), EVENT_NAMES)


@query(
    "adjacent_row_pair",
    """SELECT * FROM (SELECT item_id, invoice_date, site, qty,
                             lead(invoice_date) OVER w AS next_date, lead(qty) OVER w AS next_qty
                      FROM t_daily WINDOW w AS (PARTITION BY item_id ORDER BY invoice_date, site))
       WHERE next_date IS NOT NULL""",
)
def adjacent_row_pair(t: Testbed):
    pairs = windows.adjacent_rows(t.daily_table().drop("last_price"), ["invoice_date", "qty"])
    return pairs.select(
        "item_id", "invoice_date", "site", "qty",
        F.col("next_row.invoice_date").alias("next_date"), F.col("next_row.qty").alias("next_qty"),
    )


@query(
    "mean_by_item",
    """SELECT item_id, invoice_date, site, qty, round(avg(qty) OVER (PARTITION BY item_id), 6) AS qty_mean_item FROM t_daily""",
    {"qty_mean_item": 6},
)
def mean_by_item(t: Testbed):
    return windows.mean_by(t.daily_table().drop("last_price"), ["item_id"], "qty", "qty_mean_item")


@query(
    "mean_by_item_month",
    """SELECT item_id, invoice_date, site, qty, CAST(month(invoice_date) AS INTEGER) AS month,
              round(avg(qty) OVER (PARTITION BY item_id, month(invoice_date)), 6) AS qty_mean_item_month FROM t_daily""",
    {"qty_mean_item_month": 6},
)
def mean_by_item_month(t: Testbed):
    rows = t.daily_table().drop("last_price").withColumn("month", F.month("invoice_date"))
    return windows.mean_by(rows, ["item_id", "month"], "qty", "qty_mean_item_month")


@query(
    "mean_by_item_past",
    """SELECT item_id, invoice_date, site, qty, round(avg(qty) OVER (PARTITION BY item_id ORDER BY invoice_date, site
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS qty_mean_item FROM t_daily""",
    {"qty_mean_item": 6},
)
def mean_by_item_past(t: Testbed):
    return _past_means(t).drop("month", "qty_mean_item_month")


@query(
    "mean_by_item_month_past",
    """SELECT item_id, invoice_date, site, qty, CAST(month(invoice_date) AS INTEGER) AS month,
              round(avg(qty) OVER (PARTITION BY item_id, month(invoice_date) ORDER BY invoice_date, site
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS qty_mean_item_month FROM t_daily""",
    {"qty_mean_item_month": 6},
)
def mean_by_item_month_past(t: Testbed):
    return _past_means(t).drop("qty_mean_item")


def _past_means(t: Testbed):
    rows = t.daily_table().drop("last_price").withColumn("month", F.month("invoice_date"))
    return features.mean_features(rows, leak_free=True)


@query(
    "feature_table_past",
    """SELECT item_id, invoice_date, site, qty, qty_lag_7, round(coalesce(
                  avg(qty) OVER (PARTITION BY item_id, month ORDER BY invoice_date, site ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                  avg(qty) OVER (PARTITION BY item_id ORDER BY invoice_date, site ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 6)
              AS qty_mean_item_month
       FROM (SELECT *, lag(qty, 7) OVER (PARTITION BY item_id ORDER BY invoice_date, site) AS qty_lag_7 FROM t_dated)
       QUALIFY qty_lag_7 IS NOT NULL AND last_price IS NOT NULL""",
    {"qty_mean_item_month": 6},
)
def feature_table_past(t: Testbed):
    """Feature rows whose means know nothing of the row itself or of later ones."""
    return features.feature_table(t.daily_table(), leak_free=True).select(
        "item_id", "invoice_date", "site", "qty", "qty_lag_7", "qty_mean_item_month"
    )


@query(
    "lag_features",
    """SELECT item_id, invoice_date, site, qty, lag(qty, 1) OVER w AS qty_lag_1, lag(qty, 7) OVER w AS qty_lag_7
       FROM t_daily WINDOW w AS (PARTITION BY item_id ORDER BY invoice_date, site)""",
)
def lag_features(t: Testbed):
    return features.lag_features(t.daily_table().drop("last_price"))


@query(
    "seq_univariate",
    """SELECT invoice_date, qty, array_to_string(past, ',') AS past
       FROM (SELECT invoice_date, qty, list(CAST(qty AS BIGINT)) OVER (ORDER BY invoice_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS past
             FROM t_filled) WHERE len(past) = 30""",
)
def seq_univariate(t: Testbed):
    rows = windows.previous_values(_series(t), 30, F.col("qty").cast("bigint"), "past")
    return rows.withColumn("past", F.array_join(F.transform("past", lambda x: x.cast("string")), ","))


@query(
    "minmax_scale",
    """SELECT invoice_date, qty, (qty - min(qty) OVER ()) / (max(qty) OVER () - min(qty) OVER ()) AS qty_scaled FROM t_filled""",
)
def minmax_scale(t: Testbed):
    return encoding.minmax_scale(_series(t), ["qty"])


@query("minmax_restore", "SELECT invoice_date, round(qty, 6) AS qty FROM t_filled", {"qty": 6})
def minmax_restore(t: Testbed):
    series = _series(t)
    scaled = encoding.minmax_scale(series, ["qty"])
    back = encoding.minmax_restore(scaled, "qty", "qty_scaled", series, "restored")
    return back.select("invoice_date", F.col("restored").alias("qty"))


@query(
    "minmax_scale_by_item",
    """SELECT item_id, invoice_date, site, qty,
              CASE WHEN hi = lo THEN 0.0 ELSE (qty - lo) / (hi - lo) END AS qty_scaled
       FROM (SELECT *, min(qty) OVER (PARTITION BY item_id) AS lo, max(qty) OVER (PARTITION BY item_id) AS hi FROM t_daily)""",
)
def minmax_scale_by_item(t: Testbed):
    return encoding.minmax_scale(t.daily_table().drop("last_price"), ["qty"], by=["item_id"])


@query(
    "label_encode",
    """SELECT item_id, invoice_date, site, CAST(dense_rank() OVER (ORDER BY site) - 1 AS INTEGER) AS site_code,
              CAST(dense_rank() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_code,
              CAST(dense_rank() OVER (ORDER BY invoice_date) - 1 AS INTEGER) AS date_code FROM t_daily""",
)
def label_encode(t: Testbed):
    return features.encode_labels(t.daily_table().select("item_id", "invoice_date", "site"))


@query(
    "label_encode_unseen",
    """SELECT d.item_id, d.invoice_date, d.site, coalesce(c.code, 0) AS item_code
       FROM t_daily d LEFT JOIN (SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) - 1 AS INTEGER) AS code
                                 FROM (SELECT DISTINCT item_id FROM t_daily WHERE invoice_date < DATE '1995-06-01')) c
       ON d.item_id = c.item_id WHERE d.invoice_date >= DATE '1995-06-01'""",
)
def label_encode_unseen(t: Testbed):
    rows = t.daily_table().select("item_id", "invoice_date", "site")
    cut = F.lit("1995-06-01").cast("date")
    train, test = rows.where(F.col("invoice_date") < cut), rows.where(F.col("invoice_date") >= cut)
    return encoding.encode_with(test, train, "item_id", "item_code")


# --- features ---------------------------------------------------------------------------


@query("date_features", "SELECT * FROM t_dated")
def date_features(t: Testbed):
    return features.date_features(t.daily())


@query("gap_fill_daily", "SELECT invoice_date, qty FROM t_filled")
def gap_fill_daily(t: Testbed):
    return _series(t)


@query(
    "gap_fill_daily_by_item",
    """SELECT item_id, max(invoice_date) - min(invoice_date) + 1 AS n_days, sum(qty) AS qty,
              max(invoice_date) - min(invoice_date) + 1 - count(DISTINCT invoice_date) AS n_empty
       FROM t_daily GROUP BY item_id""",
)
def gap_fill_daily_by_item(t: Testbed):
    series = facts.daily_total_series(t.sales_lines(), by=["item_id"])
    filled = features.gap_fill_daily(series, by=["item_id"])
    return filled.groupBy("item_id").agg(
        F.count("*").alias("n_days"), F.sum("qty").alias("qty"), F.count_if(F.col("qty") == 0).alias("n_empty")
    )


@query(
    "cyclic_features",
    """SELECT invoice_date, qty, round(sin(2 * pi() * month(invoice_date) / 12), 9) + 0.0 AS month_sin,
              round(cos(2 * pi() * month(invoice_date) / 12), 9) + 0.0 AS month_cos,
              round(sin(2 * pi() * (isodow(invoice_date) - 1) / 7), 9) + 0.0 AS weekday_sin,
              round(cos(2 * pi() * (isodow(invoice_date) - 1) / 7), 9) + 0.0 AS weekday_cos FROM t_filled""",
    {"month_sin": 9, "month_cos": 9, "weekday_sin": 9, "weekday_cos": 9},
)
def cyclic_features(t: Testbed):
    return features.cyclic_features(_series(t))


@query(
    "discount_pct",
    """SELECT invoice_no, line_no, line_ref, item_id,
              round(CASE WHEN net_amount + abs(discount) = 0 THEN 0 ELSE abs(discount) * 100 / (net_amount + abs(discount)) END, 6) AS discount_pct
       FROM t_lines""",
    {"discount_pct": 6},
)
def discount_pct(t: Testbed):
    share = features.discount_pct(F.col("discount"), F.col("net_amount"))
    return t.sales_lines().select("invoice_no", "line_no", "line_ref", "item_id", share.alias("discount_pct"))


@query(
    "standard_scale",
    """SELECT item_id, invoice_date, site, round((qty - avg(qty) OVER ()) / stddev_pop(qty) OVER (), 6) AS qty_scaled,
              round((last_price - avg(last_price) OVER ()) / stddev_pop(last_price) OVER (), 6) AS last_price_scaled FROM t_daily""",
    {"qty_scaled": 6, "last_price_scaled": 6},
)
def standard_scale(t: Testbed):
    return encoding.standard_scale(t.daily_table(), ["qty", "last_price"]).drop("qty", "last_price")


@query(
    "one_hot_item",
    """SELECT d.item_id, d.invoice_date, d.site, CAST((SELECT count(DISTINCT item_id) FROM known) AS INTEGER) AS width, c.code AS position
       FROM t_daily d LEFT JOIN (SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) - 1 AS INTEGER) AS code
                                 FROM (SELECT DISTINCT item_id FROM known)) c ON d.item_id = c.item_id""".replace(
        "known", "(SELECT item_id FROM t_daily WHERE invoice_date < DATE '1995-06-01') k"
    ),
)
def one_hot_item(t: Testbed):
    rows = t.daily_table().select("item_id", "invoice_date", "site")
    coded = encoding.one_hot_item(rows, rows.where(F.col("invoice_date") < "1995-06-01"))
    vector = F.unwrap_udt("item_vector")
    return coded.select(
        "item_id", "invoice_date", "site",
        vector["size"].alias("width"), F.get(vector["indices"], F.lit(0)).alias("position"),
    )


_FEATURES = """invoice_date, site, item_id, qty, last_price, month, quarter, year, day, weekday, is_month_end, site_code,
 item_code, date_code, round(qty_mean_item, 6) AS qty_mean_item, round(qty_mean_item_month, 6) AS qty_mean_item_month,
 qty_lag_1, qty_lag_7"""


@query("feature_table", f"SELECT {_FEATURES} FROM t_features", {"qty_mean_item": 6, "qty_mean_item_month": 6})
def feature_table(t: Testbed):
    return feature_rows(t)


_CYCLES = ", ".join(
    f"round({f}(2 * pi() * {x}), 9) + 0.0 AS {n}"
    for f, x, n in (
        ("sin", "month(invoice_date) / 12", "month_sin"),
        ("cos", "month(invoice_date) / 12", "month_cos"),
        ("sin", "(isodow(invoice_date) - 1) / 7", "weekday_sin"),
        ("cos", "(isodow(invoice_date) - 1) / 7", "weekday_cos"),
    )
)
_CAPPED = """CASE WHEN is_fast = 0 AND is_feast_1 = 0 THEN least(qty,
  (SELECT quantile_cont(qty, 0.99) FROM t_flagged WHERE is_fast = 0 AND is_feast_1 = 0)) ELSE qty END"""


@query(
    "event_feature_table",
    f"""SELECT invoice_date, round({_CAPPED}, 6) AS qty, round(discount, 4) AS discount, round(net_amount, 4) AS net_amount, is_fast, is_feast_1,
               is_feast_2, is_summer, {_CYCLES},
               round(CASE WHEN net_amount + abs(discount) = 0 THEN 0 ELSE abs(discount) * 100 / (net_amount + abs(discount)) END, 6) AS discount_pct
        FROM t_flagged""",
    {"qty": 6, "discount": 4, "net_amount": 4, "discount_pct": 6, "month_sin": 9, "month_cos": 9, "weekday_sin": 9, "weekday_cos": 9},
)
def event_feature_table(t: Testbed):
    totals = facts.daily_total_series(t.sales_lines(), measures=["qty", "discount", "net_amount"])
    normal = (F.col("is_fast") == 0) & (F.col("is_feast_1") == 0)
    return features.event_feature_table(totals, t.calendar_events(), EVENT_NAMES, normal)


_SEQ = {
    "qty": _CAPPED,
    "discount_pct": "CASE WHEN net_amount + abs(discount) = 0 THEN 0 ELSE abs(discount) * 100 / (net_amount + abs(discount)) END",
    "is_fast": "is_fast", "is_feast_1": "is_feast_1", "is_feast_2": "is_feast_2", "is_summer": "is_summer",
    "month_sin": "sin(2 * pi() * month(invoice_date) / 12)", "month_cos": "cos(2 * pi() * month(invoice_date) / 12)",
    "weekday_sin": "sin(2 * pi() * (isodow(invoice_date) - 1) / 7)",
    "weekday_cos": "cos(2 * pi() * (isodow(invoice_date) - 1) / 7)",
}
_SEQ_RAW = ", ".join(f"{expr} AS x{i}" for i, expr in enumerate(_SEQ.values()))
_SEQ_TEXT = " || ':' || ".join(
    f"CAST(CAST(round((x{i} - min(x{i}) OVER ()) / (max(x{i}) OVER () - min(x{i}) OVER ()) * 10000) AS BIGINT) AS VARCHAR)"
    for i in range(len(_SEQ))
)


@query(
    "seq_multivariate",
    f"""SELECT invoice_date, split_part(step, ':', 1) AS target, array_to_string(past, ',') AS past
        FROM (SELECT invoice_date, step, list(step) OVER (ORDER BY invoice_date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS past
              FROM (SELECT invoice_date, {_SEQ_TEXT} AS step FROM (SELECT invoice_date, {_SEQ_RAW} FROM t_flagged)))
        WHERE len(past) = 14""",
)
def seq_multivariate(t: Testbed):
    columns = features.EVENT_FEATURES
    table = encoding.minmax_scale(event_feature_table(t), columns)
    step = F.array(*[F.round(F.col(f"{c}_scaled") * 10000).cast("bigint").cast("string") for c in columns])
    rows = windows.previous_values(table, 14, step, "past")
    text = F.transform("past", lambda s: F.array_join(s, ":"))
    return rows.select("invoice_date", step[0].alias("target"), F.array_join(text, ",").alias("past"))


# --- outliers ---------------------------------------------------------------------------


@query("iqr_bounds", "SELECT * FROM t_bounds")
def iqr_bounds(t: Testbed):
    return outliers.iqr_bounds(t.daily_table(spiked=True))


@query(
    "iqr_outliers",
    "SELECT s.* FROM t_spiked s, t_bounds b WHERE s.qty < b.lower_bound OR s.qty > b.upper_bound",
)
def iqr_outliers(t: Testbed):
    daily = t.daily_table(spiked=True)
    return outliers.iqr_outliers(daily, outliers.iqr_bounds(daily))


@query(
    "iqr_outlier_share",
    """SELECT count(*) AS n_rows, count(*) FILTER (qty < lower_bound OR qty > upper_bound) AS n_outliers,
              round(count(*) FILTER (qty < lower_bound OR qty > upper_bound) * 100.0 / count(*), 6) AS share_pct
       FROM t_spiked, t_bounds""",
    {"share_pct": 6},
)
def iqr_outlier_share(t: Testbed):
    daily = t.daily_table(spiked=True)
    return outliers.iqr_outlier_share(daily, outliers.iqr_bounds(daily))


@query("iqr_clean", "SELECT s.* FROM t_spiked s, t_bounds b WHERE s.qty BETWEEN b.lower_bound AND b.upper_bound")
def iqr_clean(t: Testbed):
    daily = t.daily_table(spiked=True)
    return outliers.iqr_clean(daily, outliers.iqr_bounds(daily))


@query(
    "winsorize",
    """SELECT invoice_date, site, item_id, least(greatest(qty, lower_bound), upper_bound) AS qty, last_price
       FROM t_spiked, t_bounds""",
)
def winsorize(t: Testbed):
    daily = t.daily_table(spiked=True)
    return outliers.winsorize(daily, outliers.iqr_bounds(daily))


@query(
    "zscore_outliers",
    """SELECT * FROM t_spiked
       WHERE abs(qty - (SELECT avg(qty) FROM t_spiked)) / (SELECT nullif(stddev_pop(qty), 0) FROM t_spiked) > 3""",
)
def zscore_outliers(t: Testbed):
    return outliers.zscore_outliers(t.daily_table(spiked=True))


@query(
    "zscore_outlier_share",
    """SELECT count(*) AS n_rows, count(*) FILTER (z > 3) AS n_outliers,
              round(count(*) FILTER (z > 3) * 100.0 / count(*), 6) AS share_pct
       FROM (SELECT abs(qty - avg(qty) OVER ()) / stddev_pop(qty) OVER () AS z FROM t_spiked)""",
    {"share_pct": 6},
)
def zscore_outlier_share(t: Testbed):
    return outliers.zscore_outlier_share(t.daily_table(spiked=True))


_KEY = ["item_id", "invoice_date", "site"]


@query(
    "preprocess_pipeline",
    """SELECT detector, n_rows, n_outliers, n_rows - n_removed AS n_kept FROM
       (SELECT count(*) AS n_rows, count(*) FILTER (qty < lower_bound OR qty > upper_bound) AS n_removed FROM t_spiked, t_bounds),
       (SELECT 'iqr' AS detector, count(*) AS n_outliers FROM t_spiked, t_bounds WHERE qty < lower_bound OR qty > upper_bound
        UNION ALL SELECT 'zscore', count(*) FILTER (z > 3)
        FROM (SELECT abs(qty - avg(qty) OVER ()) / stddev_pop(qty) OVER () AS z FROM t_spiked))""",
)
def preprocess_pipeline(t: Testbed):
    """The exact detectors beside what is kept; the forest's row is checked by ``preprocess_forest_share``."""
    seen = outliers.preprocess(t.daily_table(spiked=True), _KEY)
    kept = seen["rows"].agg(F.count("*").alias("n_kept"))
    rows = seen["detectors"].where("detector <> 'isolation_forest'").drop("share_pct")
    return rows.withColumn("n_kept", one_row(kept)["n_kept"])


@query("preprocess_forest_share", "SELECT count(*) AS n_rows, true AS is_small_share FROM t_spiked")
def preprocess_forest_share(t: Testbed):
    seen = outliers.preprocess(t.daily_table(spiked=True), _KEY)
    return seen["detectors"].where("detector = 'isolation_forest'").select("n_rows", (F.col("share_pct") <= 5).alias("is_small_share"))


@query(
    "preprocess_winsor",
    """SELECT round(avg(least(greatest(qty, lower_bound), upper_bound)), 6) AS mean_after, count(*) AS n_after,
              round((SELECT avg(qty) FROM t_spiked), 6) AS mean_before FROM t_spiked, t_bounds""",
    {"mean_after": 6, "mean_before": 6},
)
def preprocess_winsor(t: Testbed):
    seen = outliers.preprocess(t.daily_table(spiked=True), _KEY, method="winsor")
    before = one_row(seen["describe"])["mean"]
    after = seen["rows"].agg(F.avg("qty").alias("mean_after"), F.count("*").alias("n_after"))
    return after.withColumn("mean_before", before)


@query("masked_p99_cap", f"SELECT invoice_date, round({_CAPPED}, 6) AS qty FROM t_flagged", {"qty": 6})
def masked_p99_cap(t: Testbed):
    flagged = features.event_flags(_series(t), t.calendar_events(), EVENT_NAMES)
    normal = (F.col("is_fast") == 0) & (F.col("is_feast_1") == 0)
    return outliers.masked_cap(flagged, normal).select("invoice_date", "qty")


@query(
    "outlier_labels",
    """SELECT invoice_date, site, item_id, qty, last_price,
              CAST(qty < lower_bound OR qty > upper_bound AS INTEGER) AS is_iqr_outlier, round(z, 6) AS z_score,
              CAST(abs(z) > 3 AS INTEGER) AS is_z_outlier
       FROM (SELECT *, (qty - avg(qty) OVER ()) / stddev_pop(qty) OVER () AS z FROM t_spiked), t_bounds""",
    {"z_score": 6},
)
def outlier_labels(t: Testbed):
    return outliers.outlier_labels(t.daily_table(spiked=True))


@query(
    "before_after_compare",
    """SELECT 'before' AS stage, count(*) AS n_rows, round(avg(qty), 6) AS mean, round(stddev_samp(qty), 6) AS std,
              min(qty) AS min, max(qty) AS max FROM t_spiked
       UNION ALL SELECT 'after', count(*), round(avg(qty), 6), round(stddev_samp(qty), 6), min(qty), max(qty)
       FROM t_spiked, t_bounds WHERE qty BETWEEN lower_bound AND upper_bound""",
    {"mean": 6, "std": 6},
)
def before_after_compare(t: Testbed):
    daily = t.daily_table(spiked=True)
    return outliers.before_after(daily, outliers.clean(daily))
