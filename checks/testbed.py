"""Deterministic mapping of the given star-schema tables onto invoice, BOM and stock tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestock.operators.facts import attach_last_price, daily_purchases, daily_sales, last_price
from tidestock.plans.loading import staged_daily
from tidestock.schemas import CALENDAR_EVENTS
from tidestock.sources import masterdata
from tidestock.sources.invoices import purchase_lines, sales_lines

AS_OF = date(2001, 12, 31)
TIE_BREAK = ["line_seq"]
DISCOUNTS = [f"discount_{i}" for i in range(1, 10)]

# Event calendar of the test tables (inclusive spans, one overlapping pair).
EVENT_NAMES = ["fast", "feast_1", "feast_2", "summer"]
FASTS = ["1995-02-01", "1996-01-22", "1997-01-10", "1998-12-20", "1999-12-09", "2000-11-27", "2001-11-17"]
FEASTS = ["1995-05-10", "1996-04-28", "1997-04-18", "1998-04-07", "1999-03-28", "2000-03-16", "2001-07-05"]
SUMMERS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]
OVERLAP = ("summer", "1998-08-15", "1998-09-05")


class Testbed:
    """Lazy derived tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def invoice_details(self, spiked: bool = False) -> DataFrame:
        """Invoice rows before the discount columns are summed; nine equal parts each."""
        line = self.table("lineitem").where(F.col("l_returnflag") != "R")
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        supplier = self.table("supplier").select("s_suppkey", "s_nationkey")
        qty = F.col("l_quantity")
        if spiked:
            key = F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey")
            qty = F.when(key % 61 == 0, qty * 12).otherwise(qty)
        net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
        tax = net * F.col("l_tax")
        part = F.col("l_extendedprice") * F.col("l_discount") / 9
        return (
            line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                F.lit("C1").alias("company"),
                F.col("l_orderkey").cast("string").alias("invoice_no"),
                F.col("l_shipdate").cast("date").alias("invoice_date"),
                F.col("o_custkey").cast("string").alias("customer"),
                (F.col("o_custkey") % 20).cast("string").alias("sales_rep"),
                item_key(F.col("l_partkey")).alias("item_id"),
                qty.alias("qty"),
                (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
                *[part.alias(name) for name in DISCOUNTS[:-1]],
                F.when(F.col("l_linenumber") != 7, part).alias(DISCOUNTS[-1]),
                (F.col("l_extendedprice") * F.col("l_discount")).alias("discount"),
                net.alias("net_amount"),
                tax.alias("tax_amount"),
                (net + tax).alias("gross_amount"),
                F.concat(F.lit("SITE"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0")).alias("site"),
                F.col("l_linenumber").alias("line_no"),
                F.col("l_suppkey").alias("line_ref"),
                line_sequence().alias("line_seq"),
            )
        )

    def sales_lines(self, spiked: bool = False) -> DataFrame:
        return self.invoice_details(spiked).drop(*DISCOUNTS)

    def daily(self, spiked: bool = False) -> DataFrame:
        """Daily sales with last price: the fact most operators start from."""
        lines = self.sales_lines(spiked)
        return attach_last_price(daily_sales(lines), last_price(lines, TIE_BREAK))

    def daily_table(self, spiked: bool = False) -> DataFrame:
        """The same fact as a written table, for queries that read it several times."""
        return staged_daily(self.sales_lines(spiked), *TIE_BREAK)

    def purchase_header(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("invoice_no"),
            F.lit("C1").alias("company"),
            F.concat(F.lit("F"), (F.col("o_custkey") % 5).cast("string")).alias("site"),
            F.col("o_orderdate").cast("date").alias("invoice_date"),
            F.lit("EUR").alias("currency"),
            F.col("o_orderstatus").alias("status"),
        )

    def purchase_detail(self) -> DataFrame:
        supplier = self.table("supplier").select("s_suppkey", F.col("s_name").alias("supplier"))
        line = self.table("lineitem").where(F.col("l_returnflag") == "A")
        return line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
            F.col("l_orderkey").cast("string").alias("invoice_no"),
            F.lit("C1").alias("company"),
            "supplier",
            item_key(F.col("l_partkey")).alias("item_id"),
            F.col("l_quantity").alias("qty"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            F.col("l_extendedprice").alias("net_amount"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_suppkey").alias("line_ref"),
            line_sequence().alias("line_seq"),
        )

    def purchase_lines(self) -> DataFrame:
        extra = ["invoice_no", "line_no", "line_ref", *TIE_BREAK]
        return purchase_lines(self.purchase_header(), self.purchase_detail(), extra=extra)

    def daily_purchases(self) -> DataFrame:
        lines = self.purchase_lines()
        return attach_last_price(daily_purchases(lines), last_price(lines, TIE_BREAK))

    def bom_header(self) -> DataFrame:
        size, key = F.col("p_size"), F.col("p_partkey")
        start = F.date_add(F.lit(date(1998, 1, 1)), (key % 1500).cast("int"))
        return self.table("part").where(key % 4 == 0).select(
            item_key(key).alias("item_id"),
            F.lit(1).alias("alt"),
            F.lit(1).alias("bom_type"),
            F.when(size % 10 == 0, 2).otherwise(1).alias("status"),
            F.when(size % 3 != 0, start).alias("valid_from"),
            F.when(size % 7 == 0, F.lit(date(1999, 1, 1))).alias("valid_to"),
        )

    def bom_line(self) -> DataFrame:
        part = self.table("part")
        fifth = F.floor(part.agg(F.count("*")).scalar() / 5)
        key = F.col("p_partkey")
        lines = (
            part.where(key % 4 == 0)
            .select(key, "p_size", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("j"))
            .withColumn("fifth", fifth)
        )
        base = (key * 3 + F.col("j") * 7) % F.col("fifth")
        return lines.withColumn("base", base).select(
            item_key(key).alias("item_id"),
            F.lit(1).alias("alt"),
            F.lit(1).alias("bom_type"),
            item_key(F.col("base") + F.when(F.col("base") % 4 == 0, 1).otherwise(0)).alias("component"),
            ((F.col("p_size") + F.col("j")) % 5).cast("double").alias("qty"),
            F.when((key + F.col("j")) % 11 == 0, 2).otherwise(1).alias("comp_status"),
        )

    def stock(self) -> DataFrame:
        supplier = self.table("supplier").select("s_suppkey", "s_nationkey")
        line = self.table("lineitem").where(F.col("l_returnflag") == "R")
        return line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
            item_key(F.col("l_partkey")).alias("item_id"),
            F.concat(F.lit("SITE"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0")).alias("site"),
            F.col("l_quantity").alias("qty"),
            F.when(F.col("l_linestatus") == "O", 1).otherwise(2).alias("is_physical"),
            F.lit(0).alias("is_frozen"),
        )

    def item_master(self) -> DataFrame:
        return self.table("part").select(
            item_key(F.col("p_partkey")).alias("item_id"),
            F.col("p_name").alias("label"),
            F.when(F.col("p_size") % 25 == 0, 2).otherwise(1).alias("status"),
        )

    def sales_order(self) -> DataFrame:
        orders = self.table("orders").where(F.col("o_orderstatus") == "O").select("o_orderkey")
        line = self.table("lineitem").select("l_orderkey", "l_partkey")
        return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_orderkey").cast("string").alias("order_no"),
            item_key(F.col("l_partkey")).alias("item_id"),
        )

    def bom(self) -> DataFrame:
        return masterdata.active_bom(self.bom_header(), self.bom_line(), AS_OF)

    def stock_fg(self) -> DataFrame:
        return masterdata.stock_finished_goods(
            self.stock(), self.item_master(), self.bom_header(), self.bom_line(), self.sales_order()
        )

    def stock_comp(self) -> DataFrame:
        return masterdata.stock_components(self.stock(), self.item_master())

    def calendar_events(self) -> DataFrame:
        return self.spark.createDataFrame(event_spans(), CALENDAR_EVENTS)


def item_key(key):
    """Zero-padded text key, so text order equals key order."""
    text = key.cast("string")
    return F.concat(F.lit("ART"), F.when(F.length(text) < 8, F.lpad(text, 8, "0")).otherwise(text))


def line_sequence():
    """Number that orders the lines of a day: order, line, supplier."""
    return (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1048576 + F.col("l_suppkey")


def event_spans() -> list[tuple[str, date, date]]:
    """The event calendar as (name, first day, last day)."""
    day = date.fromisoformat
    spans = []
    for start in FASTS:
        first = day(start)
        spans.append(("fast", first, date.fromordinal(first.toordinal() + 29)))
        spans.append(("feast_1", *[date.fromordinal(first.toordinal() + k) for k in (30, 32)]))
    spans += [("feast_2", day(s), date.fromordinal(day(s).toordinal() + 2)) for s in FEASTS]
    spans += [("summer", date(y, 7, 1), date(y, 8, 31)) for y in SUMMERS]
    spans.append((OVERLAP[0], day(OVERLAP[1]), day(OVERLAP[2])))
    return spans
