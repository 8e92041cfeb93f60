"""Sources, pipelines to daily facts, and sinks."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.testbed import AS_OF, DISCOUNTS, TIE_BREAK, Testbed
from tidestock.functions.numeric import number_or_zero
from tidestock.operators import forecast
from tidestock.plans.loading import load_purchases, load_sales
from tidestock.plans.planning import baseline_detail, run_planning
from tidestock.schemas import DAILY_PURCHASES, PURCHASE_LINES, SALES_LINES
from tidestock.session import new_path
from tidestock.sources import masterdata
from tidestock.sources.invoices import discount_total, sales_lines
from tidestock.sources.readers import read_files, rename_positional
from tidestock.sources.sinks import PLAN_TABLES, write_csv, write_plan_tables

_SALES = """company, invoice_no, invoice_date, customer, sales_rep, item_id, qty, unit_price, {discount} AS discount,
 net_amount, tax_amount, gross_amount, site"""
_PURCHASE = "company, site, invoice_date, supplier, currency, status, item_id, qty, unit_price, net_amount"


@query(
    "src_sales_lines",
    f"SELECT {_SALES.format(discount='round(CASE WHEN line_no <> 7 THEN discount END, 6)')}, line_no FROM t_lines",
    {"discount": 6},
)
def src_sales_lines(t: Testbed):
    return sales_lines(t.invoice_details(), DISCOUNTS, extra=["line_no"])


@query("rename_positional", f"SELECT {_SALES.format(discount='discount')} FROM t_lines")
def rename(t: Testbed):
    raw = t.sales_lines().drop("line_no", "line_ref", "line_seq")
    return rename_positional(raw.toDF(*[f"c{i}" for i in range(len(SALES_LINES))]), SALES_LINES)


@query(
    "discount_total",
    """SELECT invoice_no, line_no, line_ref, item_id, CASE WHEN line_no <> 7 THEN round(discount, 6) END AS discount
       FROM t_lines""",
    {"discount": 6},
)
def discounts(t: Testbed):
    return t.invoice_details().select(
        "invoice_no", "line_no", "line_ref", "item_id", discount_total(DISCOUNTS).alias("discount")
    )


@query("src_purchase_lines", f"SELECT {_PURCHASE}, invoice_no, line_no, line_ref, line_seq FROM t_purchase_lines")
def src_purchase_lines(t: Testbed):
    return t.purchase_lines()


@query("rename_positional_purchases", f"SELECT {_PURCHASE} FROM t_purchase_lines")
def rename_purchases(t: Testbed):
    raw = t.purchase_lines().select(*PURCHASE_LINES.names)
    return rename_positional(raw.toDF(*[f"c{i}" for i in range(len(PURCHASE_LINES))]), PURCHASE_LINES)


@query("src_bom", "SELECT fg_item, component, qty FROM t_bom")
def src_bom(t: Testbed):
    return masterdata.active_bom(t.bom_header(), t.bom_line(), AS_OF)


@query("src_stock_fg", "SELECT item_id, label, qty_on_hand FROM t_stock_fg")
def src_stock_fg(t: Testbed):
    return t.stock_fg()


@query(
    "src_stock_fg_one_site",
    """SELECT s.item_id, f.label, sum(s.qty) AS qty_on_hand FROM t_stock s JOIN t_stock_fg f ON f.item_id = s.item_id
       WHERE s.site = 'SITE03' AND s.is_physical = 1 AND s.is_frozen = 0 GROUP BY ALL""",
)
def src_stock_fg_one_site(t: Testbed):
    return masterdata.stock_finished_goods(
        t.stock(), t.item_master(), t.bom_header(), t.bom_line(), t.sales_order(), site="SITE03"
    )


@query("src_stock_comp", "SELECT item_id, label, qty_on_hand FROM t_stock_comp")
def src_stock_comp(t: Testbed):
    return t.stock_comp()


@query(
    "not_a_component",
    """SELECT i.* FROM t_item_master i
       WHERE NOT EXISTS (SELECT 1 FROM t_bom_line l JOIN t_bom_header h ON h.item_id = l.item_id AND h.alt = l.alt
                         WHERE l.component = i.item_id AND h.status = 1)""",
)
def not_a_component(t: Testbed):
    return masterdata.not_a_component(t.item_master(), t.bom_header(), t.bom_line())


@query(
    "made_or_ordered",
    """SELECT i.* FROM t_item_master i
       WHERE EXISTS (SELECT 1 FROM t_bom_header h WHERE h.item_id = i.item_id AND h.status = 1)
          OR EXISTS (SELECT 1 FROM t_sales_order o WHERE o.item_id = i.item_id AND o.order_no IS NOT NULL)""",
)
def made_or_ordered(t: Testbed):
    return masterdata.made_or_ordered(t.item_master(), t.bom_header(), t.sales_order())


@query(
    "coerce_numeric",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              coalesce(TRY_CAST(CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS DOUBLE), 0) AS qty
       FROM lineitem""",
)
def coerce_numeric(t: Testbed):
    text = F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.col("l_quantity").cast("string"))
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", number_or_zero(text).alias("qty")
    )


@query("sink_csv", "SELECT * FROM t_daily_purchases")
def sink_csv(t: Testbed):
    path = write_csv(t.daily_purchases(), new_path(t.spark, "purchases-csv"))
    return read_files(t.spark, path, DAILY_PURCHASES, "csv")


@query(
    "sink_plan_tables",
    """SELECT 'final_stock_comp' AS table_name, count(*) AS n_rows, round(sum(final_stock), 4) AS total FROM t_comp_plan
       UNION ALL SELECT 'final_stock_fg', count(*), round(sum(final_stock), 4) FROM t_fg_plan
       UNION ALL SELECT 'monthly_revenue', count(*), round(sum(qty), 4) FROM t_monthly""",
    {"total": 4},
)
def sink_plan_tables(t: Testbed):
    plan = run_planning(baseline_detail(t.daily_table()), t.bom(), t.stock_fg(), t.stock_comp())
    paths = write_plan_tables(plan, new_path(t.spark, "plan"))
    amounts = dict(zip(PLAN_TABLES, ("qty", "final_stock", "final_stock"), strict=True))
    parts = [
        t.spark.read.parquet(path).agg(F.count("*").alias("n_rows"), F.sum(amounts[name]).alias("total"))
        .select(F.lit(name).alias("table_name"), "n_rows", "total")
        for name, path in paths.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("load_sales_pipeline", """
SELECT d.invoice_date, d.site, d.item_id, d.qty, p.last_price
FROM (SELECT invoice_date, site, item_id, sum(qty) AS qty FROM t_lines GROUP BY ALL) d
LEFT JOIN (SELECT item_id, arg_max(unit_price, row(invoice_date, invoice_no, unit_price)) AS last_price
           FROM t_lines GROUP BY item_id) p ON d.item_id = p.item_id""")
def load_sales_pipeline(t: Testbed):
    raw = t.sales_lines().drop("line_no", "line_ref", "line_seq")
    return load_sales(raw.toDF(*[f"c{i}" for i in range(len(SALES_LINES))]), ["invoice_no", "unit_price"])


@query("load_purchases_pipeline", "SELECT * FROM t_daily_purchases")
def load_purchases_pipeline(t: Testbed):
    return load_purchases(t.purchase_header(), t.purchase_detail(), TIE_BREAK)


@query(
    "forecast_monthly_total",
    "SELECT round(sum(revenue_forecast), 2) AS revenue_total FROM t_detail",
    {"revenue_total": 2},
)
def forecast_monthly_total(t: Testbed):
    return forecast.forecast_total(baseline_detail(t.daily_table()))
