"""SQL table expressions that mirror the derived tables of the testbed."""

from checks.registry import tables
from checks.testbed import AS_OF, event_spans

_EVENT_ROWS = ", ".join(f"('{n}', DATE '{a}', DATE '{b}')" for n, a, b in event_spans())


def _lines(qty: str) -> str:
    return f"""
SELECT 'C1' AS company, CAST(l_orderkey AS VARCHAR) AS invoice_no, CAST(l_shipdate AS DATE) AS invoice_date,
       CAST(o_custkey AS VARCHAR) AS customer, CAST(o_custkey % 20 AS VARCHAR) AS sales_rep,
       printf('ART%08d', l_partkey) AS item_id, {qty} AS qty, l_extendedprice / l_quantity AS unit_price,
       l_extendedprice * l_discount AS discount, l_extendedprice * (1 - l_discount) AS net_amount,
       l_extendedprice * (1 - l_discount) * l_tax AS tax_amount,
       l_extendedprice * (1 - l_discount) + l_extendedprice * (1 - l_discount) * l_tax AS gross_amount,
       printf('SITE%02d', s_nationkey) AS site, l_linenumber AS line_no, l_suppkey AS line_ref,
       (l_orderkey * 10 + l_linenumber) * 1048576 + l_suppkey AS line_seq
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
WHERE l_returnflag <> 'R'"""


def _daily(lines: str) -> str:
    return f"""
SELECT d.invoice_date, d.site, d.item_id, d.qty, p.last_price
FROM (SELECT invoice_date, site, item_id, sum(qty) AS qty FROM {lines} GROUP BY ALL) d
LEFT JOIN (SELECT item_id, arg_max(unit_price, row(invoice_date, line_seq)) AS last_price
           FROM {lines} GROUP BY item_id) p ON d.item_id = p.item_id"""


_STATUS = """CASE WHEN coverage_pct > -1 AND coverage_pct <= 25 THEN 'stockout_risk'
 WHEN coverage_pct > 25 AND coverage_pct <= 75 THEN 'low_stock'
 WHEN coverage_pct > 75 AND coverage_pct <= 100 THEN 'sufficient' END AS status"""


def _plan(requirements: str, stock: str, extra: str) -> str:
    return f"""
SELECT *, greatest(qty_on_hand + purchase - requirement, 0) AS final_stock, {_STATUS}
FROM (SELECT r.item_id, r.requirement, {extra}, s.label, coalesce(s.qty_on_hand, 0.0) AS qty_on_hand,
             greatest(r.requirement - coalesce(s.qty_on_hand, 0.0), 0.0) AS purchase,
             least(CASE WHEN r.requirement > 0 THEN coalesce(s.qty_on_hand, 0.0) / r.requirement * 100 ELSE 100 END, 100.0) AS coverage_pct
      FROM {requirements} r LEFT JOIN {stock} s ON r.item_id = s.item_id)"""


tables(
    t_lines=_lines("l_quantity"),
    t_spiked_lines=_lines(
        "CASE WHEN (l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 61 = 0 THEN l_quantity * 12 ELSE l_quantity END"
    ),
    t_daily=_daily("t_lines"),
    t_spiked=_daily("t_spiked_lines"),
    t_purchase_lines="""
SELECT 'C1' AS company, 'F' || CAST(o_custkey % 5 AS VARCHAR) AS site, CAST(o_orderdate AS DATE) AS invoice_date,
       s_name AS supplier, 'EUR' AS currency, o_orderstatus AS status, printf('ART%08d', l_partkey) AS item_id,
       l_quantity AS qty, l_extendedprice / l_quantity AS unit_price, l_extendedprice AS net_amount,
       CAST(l_orderkey AS VARCHAR) AS invoice_no, l_linenumber AS line_no, l_suppkey AS line_ref,
       (l_orderkey * 10 + l_linenumber) * 1048576 + l_suppkey AS line_seq
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
WHERE l_returnflag = 'A'""",
    t_daily_purchases="""
SELECT d.invoice_date, d.supplier, d.item_id, d.qty, p.last_price
FROM (SELECT invoice_date, supplier, item_id, sum(qty) AS qty FROM t_purchase_lines GROUP BY ALL) d
LEFT JOIN (SELECT item_id, arg_max(unit_price, row(invoice_date, line_seq)) AS last_price
           FROM t_purchase_lines GROUP BY item_id) p ON d.item_id = p.item_id""",
    t_bom_header="""
SELECT printf('ART%08d', p_partkey) AS item_id, 1 AS alt, 1 AS bom_type,
       CASE WHEN p_size % 10 = 0 THEN 2 ELSE 1 END AS status,
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE DATE '1998-01-01' + CAST(p_partkey % 1500 AS INTEGER) END AS valid_from,
       CASE WHEN p_size % 7 = 0 THEN DATE '1999-01-01' END AS valid_to
FROM part WHERE p_partkey % 4 = 0""",
    t_bom_line="""
SELECT printf('ART%08d', p_partkey) AS item_id, 1 AS alt, 1 AS bom_type,
       printf('ART%08d', base + CASE WHEN base % 4 = 0 THEN 1 ELSE 0 END) AS component,
       CAST((p_size + j) % 5 AS DOUBLE) AS qty, CASE WHEN (p_partkey + j) % 11 = 0 THEN 2 ELSE 1 END AS comp_status
FROM (SELECT *, (p_partkey * 3 + j * 7) % ((SELECT count(*) FROM part) // 5) AS base
      FROM part, (VALUES (1), (2), (3)) v(j) WHERE p_partkey % 4 = 0)""",
    t_bom=f"""
SELECT l.item_id AS fg_item, l.component, l.qty
FROM t_bom_line l JOIN t_bom_header h ON l.item_id = h.item_id AND l.alt = h.alt AND l.bom_type = h.bom_type
WHERE h.status = 1 AND (h.valid_from IS NULL OR h.valid_from <= DATE '{AS_OF}')
  AND (h.valid_to IS NULL OR h.valid_to >= DATE '{AS_OF}') AND l.comp_status = 1 AND l.qty > 0""",
    t_stock="""
SELECT printf('ART%08d', l_partkey) AS item_id, printf('SITE%02d', s_nationkey) AS site, l_quantity AS qty,
       CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS is_physical, 0 AS is_frozen
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'R'""",
    t_item_master="""
SELECT printf('ART%08d', p_partkey) AS item_id, p_name AS label, CASE WHEN p_size % 25 = 0 THEN 2 ELSE 1 END AS status
FROM part""",
    t_sales_order="""
SELECT CAST(o_orderkey AS VARCHAR) AS order_no, printf('ART%08d', l_partkey) AS item_id
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O'""",
    t_stock_comp="""
SELECT s.item_id, i.label, sum(s.qty) AS qty_on_hand
FROM t_stock s JOIN t_item_master i ON s.item_id = i.item_id
WHERE i.status = 1 AND s.is_physical = 1 AND s.is_frozen = 0 GROUP BY ALL""",
    t_stock_fg="""
SELECT c.* FROM t_stock_comp c
WHERE NOT EXISTS (SELECT 1 FROM t_bom_line l JOIN t_bom_header h ON h.item_id = l.item_id AND h.alt = l.alt
                  WHERE l.component = c.item_id AND h.status = 1)
  AND (EXISTS (SELECT 1 FROM t_bom_header h WHERE h.item_id = c.item_id AND h.status = 1)
       OR EXISTS (SELECT 1 FROM t_sales_order o WHERE o.item_id = c.item_id AND o.order_no IS NOT NULL))""",
    t_events=f"SELECT * FROM (VALUES {_EVENT_ROWS}) e(name, start_date, end_date)",
    t_item_stats="""
SELECT item_id, avg(qty) AS qty_mean_item, arg_max(qty, row(invoice_date, site)) AS qty_last,
       arg_max(last_price, row(invoice_date, site)) AS last_price
FROM t_daily GROUP BY item_id""",
    t_month_means="""
SELECT item_id, CAST(month(invoice_date) AS INTEGER) AS month, avg(qty) AS qty_mean_item_month
FROM t_daily GROUP BY ALL""",
    t_grid="""
SELECT i.*, CAST(k AS INTEGER) AS months_ahead,
       CAST((SELECT max(invoice_date) FROM t_daily) + to_months(CAST(k AS INTEGER)) AS DATE) AS forecast_date
FROM t_item_stats i, range(1, 13) r(k)""",
    t_future="""
SELECT g.item_id, g.qty_mean_item, g.last_price, g.months_ahead, g.forecast_date,
       CAST(month(forecast_date) AS INTEGER) AS month, CAST(quarter(forecast_date) AS INTEGER) AS quarter,
       CAST(year(forecast_date) AS INTEGER) AS year, 15 AS day, CAST(isodow(forecast_date) - 1 AS INTEGER) AS weekday,
       g.qty_last AS qty_lag_1, g.qty_last AS qty_lag_7,
       coalesce(m.qty_mean_item_month, g.qty_mean_item) AS qty_mean_item_month
FROM t_grid g LEFT JOIN t_month_means m ON g.item_id = m.item_id AND month(g.forecast_date) = m.month""",
    t_detail="""
SELECT item_id, year, month, greatest(qty_mean_item_month, 0) AS qty_forecast,
       greatest(qty_mean_item_month, 0) * last_price AS revenue_forecast
FROM t_future""",
    t_fg_req="""
SELECT item_id, sum(qty_forecast) AS requirement, sum(revenue_forecast) AS revenue FROM t_detail GROUP BY item_id""",
    t_fg_plan=_plan("t_fg_req", "t_stock_fg", "r.revenue"),
    t_edges="""
SELECT b.fg_item, b.component, b.qty, p.purchase, p.purchase * b.qty AS need
FROM t_bom b JOIN t_fg_plan p ON b.fg_item = p.item_id""",
    t_comp_req="""
SELECT component AS item_id, sum(need) AS requirement, count(DISTINCT fg_item) AS n_products
FROM t_edges GROUP BY component""",
    t_comp_plan=_plan("t_comp_req", "t_stock_comp", "r.n_products"),
    t_monthly="""
SELECT year, month, sum(revenue_forecast) AS revenue, sum(qty_forecast) AS qty FROM t_detail GROUP BY year, month""",
    t_dated="""
SELECT *, CAST(month(invoice_date) AS INTEGER) AS month, CAST(quarter(invoice_date) AS INTEGER) AS quarter,
       CAST(year(invoice_date) AS INTEGER) AS year, CAST(day(invoice_date) AS INTEGER) AS day,
       CAST(isodow(invoice_date) - 1 AS INTEGER) AS weekday,
       CAST(invoice_date = last_day(invoice_date) AS INTEGER) AS is_month_end
FROM t_daily""",
    t_features="""
SELECT * FROM (
  SELECT *, CAST(dense_rank() OVER (ORDER BY site) - 1 AS INTEGER) AS site_code,
         CAST(dense_rank() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_code,
         CAST(dense_rank() OVER (ORDER BY invoice_date) - 1 AS INTEGER) AS date_code,
         avg(qty) OVER (PARTITION BY item_id) AS qty_mean_item,
         avg(qty) OVER (PARTITION BY item_id, month) AS qty_mean_item_month,
         lag(qty, 1) OVER (PARTITION BY item_id ORDER BY invoice_date, site) AS qty_lag_1,
         lag(qty, 7) OVER (PARTITION BY item_id ORDER BY invoice_date, site) AS qty_lag_7
  FROM t_dated)
WHERE qty_lag_7 IS NOT NULL AND last_price IS NOT NULL""",
    t_bounds="""
SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
FROM (SELECT quantile_cont(qty, 0.25) AS q1, quantile_cont(qty, 0.75) AS q3 FROM t_spiked)""",
    t_totals="""
SELECT invoice_date, sum(qty) AS qty, sum(discount) AS discount, sum(net_amount) AS net_amount
FROM t_lines GROUP BY invoice_date""",
    t_calendar="""
SELECT CAST(unnest(generate_series(min(invoice_date), max(invoice_date), INTERVAL 1 DAY)) AS DATE) AS invoice_date
FROM t_daily""",
    t_filled="""
SELECT c.invoice_date, coalesce(t.qty, 0.0) AS qty, coalesce(t.discount, 0.0) AS discount,
       coalesce(t.net_amount, 0.0) AS net_amount
FROM t_calendar c LEFT JOIN t_totals t ON c.invoice_date = t.invoice_date""",
    t_flagged="""
SELECT f.*,
       CAST(EXISTS (SELECT 1 FROM t_events e WHERE e.name = 'fast' AND f.invoice_date BETWEEN e.start_date AND e.end_date) AS INTEGER) AS is_fast,
       CAST(EXISTS (SELECT 1 FROM t_events e WHERE e.name = 'feast_1' AND f.invoice_date BETWEEN e.start_date AND e.end_date) AS INTEGER) AS is_feast_1,
       CAST(EXISTS (SELECT 1 FROM t_events e WHERE e.name = 'feast_2' AND f.invoice_date BETWEEN e.start_date AND e.end_date) AS INTEGER) AS is_feast_2,
       CAST(EXISTS (SELECT 1 FROM t_events e WHERE e.name = 'summer' AND f.invoice_date BETWEEN e.start_date AND e.end_date) AS INTEGER) AS is_summer
FROM t_filled f""",
)
