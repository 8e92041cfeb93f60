"""Data augmentation over the feature table."""

from pyspark.sql import functions as F

from checks.q_features import feature_rows
from checks.registry import query, tables
from checks.testbed import Testbed
from tidestock.operators import augment, facts, reports
from tidestock.session import staged_lean

_KEY = "(item_id || '|' || invoice_date || '|' || site)"
_COLUMNS = ["qty", "qty_mean_item", "qty_mean_item_month", "qty_lag_1", "qty_lag_7"]


def _u(salt: str, key: str = _KEY) -> str:
    return f"(('0x' || substr(md5({key} || '-{salt}'), 1, 13))::BIGINT / 4503599627370496.0)"


def _n(salt: str) -> str:
    return f"(sqrt(-2 * ln(1 - {_u(salt + '-r')})) * cos(2 * pi() * {_u(salt + '-a')}))"


_KEPT = """site, item_id, last_price, day, site_code, item_code"""
_RECALENDAR = """CAST(month(new_date) AS INTEGER) AS month, CAST(quarter(new_date) AS INTEGER) AS quarter,
 CAST(year(new_date) AS INTEGER) AS year, CAST(isodow(new_date) - 1 AS INTEGER) AS weekday,
 CAST(new_date = last_day(new_date) AS INTEGER) AS is_month_end"""
_CALENDAR = "month, quarter, year, weekday, is_month_end"

tables(
    t_noise=f"""
SELECT invoice_date, {_KEPT}, {_CALENDAR}, CAST(date_code AS BIGINT) AS date_code, 'gaussian_noise' AS source, """
    + ", ".join(
        f"greatest({c} + 0.02 * (SELECT stddev_samp({c}) FROM t_features) * {_n('noise-' + c)}, 0) AS {c}" for c in _COLUMNS
    )
    + " FROM t_features",
    t_pairs="""
SELECT *, lead(invoice_date) OVER w AS next_date, """
    + ", ".join(f"lead({c}) OVER w AS next_{c}" for c in _COLUMNS)
    + " FROM t_features WINDOW w AS (PARTITION BY item_id ORDER BY invoice_date, site)",
    t_interpolated=f"""
SELECT new_date AS invoice_date, {_KEPT}, {_RECALENDAR}, CAST(date_code AS BIGINT) AS date_code, 'interpolation' AS source, """
    + ", ".join(f"w * {c} + (1 - w) * next_{c} AS {c}" for c in _COLUMNS)
    + f"""
FROM (SELECT *, CAST(invoice_date + CAST(floor(w * (next_date - invoice_date)) AS INTEGER) AS DATE) AS new_date
      FROM (SELECT *, 0.2::DOUBLE + 0.6::DOUBLE * {_u('interpolate-weight')} AS w FROM t_pairs WHERE next_date IS NOT NULL
            ORDER BY {_u('interpolate-pick')} LIMIT 300))""",
    t_jitter=f"""
SELECT new_date AS invoice_date, {_KEPT}, {_RECALENDAR}, (new_date - DATE '1970-01-01') * 86400 AS date_code,
       'seasonal_jitter' AS source, greatest(qty * scale, 0) AS qty, qty_mean_item, qty_mean_item_month, qty_lag_1, qty_lag_7
FROM (SELECT *, CAST(invoice_date + CAST(floor({_u('jitter-shift')} * 60) - 30 AS INTEGER) AS DATE) AS new_date,
             0.95::DOUBLE + 0.10::DOUBLE * {_u('jitter-scale')} AS scale
      FROM t_features ORDER BY {_u('jitter-pick')} LIMIT 300)""",
    t_pool="""
SELECT * FROM t_features WHERE qty <= (SELECT quantile_cont(qty, 0.10) FROM t_features)
   OR qty >= (SELECT quantile_cont(qty, 0.90) FROM t_features)""",
    t_rare=f"""
SELECT a.invoice_date, {', '.join('a.' + c for c in _KEPT.split(', '))}, {', '.join('a.' + c for c in _CALENDAR.split(', '))},
       CAST(a.date_code AS BIGINT) AS date_code, 'rare_mix' AS source, """
    + ", ".join(f"greatest(a.w * a.{c} + (1 - a.w) * b.{c}, 0) AS {c}" for c in _COLUMNS)
    + f"""
FROM (SELECT *, row_number() OVER (ORDER BY {_u('rare-first')}) AS r, 0.3::DOUBLE + 0.4::DOUBLE * {_u('rare-weight')} AS w FROM t_pool) a
JOIN (SELECT *, row_number() OVER (ORDER BY {_u('rare-second')}) AS r FROM t_pool) b ON a.r = b.r
WHERE a.r <= 200""",
    t_original=f"""
SELECT invoice_date, {_KEPT}, {_CALENDAR}, CAST(date_code AS BIGINT) AS date_code, 'original' AS source, {', '.join(_COLUMNS)}
FROM t_features""",
    t_union="""
SELECT * FROM t_original UNION ALL BY NAME SELECT * FROM t_noise UNION ALL BY NAME SELECT * FROM t_interpolated
UNION ALL BY NAME SELECT * FROM t_jitter UNION ALL BY NAME SELECT * FROM t_rare""",
)

_R = ", ".join(f"round({c}, 6) AS {c}" for c in _COLUMNS)
_ROUND = dict.fromkeys(_COLUMNS, 6)
_OUT = f"invoice_date, {_KEPT}, {_CALENDAR}, date_code, source, {_R}"


def _rows(t: Testbed):
    return staged_lean(feature_rows(t), "features")


def _wide_code(df):
    return df.withColumn("date_code", F.col("date_code").cast("bigint"))


@query("aug_gaussian", f"SELECT {_OUT} FROM t_noise", _ROUND)
def aug_gaussian(t: Testbed):
    return _wide_code(augment.gaussian_noise(_rows(t)))


@query("aug_interpolate", f"SELECT {_OUT} FROM t_interpolated", _ROUND)
def aug_interpolate(t: Testbed):
    return _wide_code(augment.interpolate_rows(_rows(t)))


@query("aug_seasonal_jitter", f"SELECT {_OUT} FROM t_jitter", _ROUND)
def aug_seasonal_jitter(t: Testbed):
    return _wide_code(augment.seasonal_jitter(_rows(t)))


@query("aug_rare", f"SELECT {_OUT} FROM t_rare", _ROUND)
def aug_rare(t: Testbed):
    return _wide_code(augment.rare_mix(_rows(t)))


@query("union_augmented", f"SELECT {_OUT} FROM t_union", _ROUND)
def union_augmented(t: Testbed):
    return augment.union_augmented(_rows(t))


@query("dedupe_rows", "SELECT DISTINCT item_id, site, qty FROM t_daily")
def dedupe_rows(t: Testbed):
    return augment.dedupe_rows(t.daily().select("item_id", "site", "qty"))


@query("augment_pipeline", f"""SELECT DISTINCT {_OUT} FROM (SELECT * REPLACE (CAST(dense_rank() OVER (ORDER BY site) - 1 AS INTEGER) AS site_code,
         CAST(dense_rank() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_code) FROM t_union)""", _ROUND)
def augment_pipeline(t: Testbed):
    return augment.augmented_table(_rows(t))


@query("augment_source_counts", "SELECT source, count(*) AS n_rows FROM t_union GROUP BY source")
def augment_source_counts(t: Testbed):
    return facts.value_counts(augment.union_augmented(_rows(t)), "source")


@query(
    "augment_growth",
    """SELECT (SELECT count(*) FROM t_features) AS n_before, count(*) AS n_after,
              round((count(*) - (SELECT count(*) FROM t_features)) * 100.0 / (SELECT count(*) FROM t_features), 6) AS growth_pct
       FROM (SELECT DISTINCT * FROM t_union)""",
    {"growth_pct": 6},
)
def augment_growth(t: Testbed):
    rows = _rows(t)
    return reports.growth(rows, augment.augmented_table(rows))
