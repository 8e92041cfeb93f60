from datetime import date

import pytest
from pyspark.sql import functions as F

from tidestock.operators import facts
from tidestock.plans.loading import load_purchases, load_sales, staged_daily
from tidestock.schemas import SALES_LINES
from tidestock.session import new_path
from tidestock.sources import masterdata
from tidestock.sources.invoices import discount_total
from tidestock.sources.readers import read_jdbc, rename_positional
from tidestock.sources.sinks import write_plan_tables

LINES = "invoice_date date, site string, item_id string, qty double, unit_price double, seq long"


def lines(spark):
    d = date
    return spark.createDataFrame(
        [
            (d(2024, 1, 1), "S1", "A", 5.0, 10.0, 1),
            (d(2024, 1, 1), "S1", "A", 3.0, 11.0, 2),
            (d(2024, 1, 2), "S2", "A", 1.0, None, 3),
            (d(2024, 1, 3), "S1", "B", None, 7.0, 4),
            (d(2024, 1, 3), None, "B", 4.0, 9.0, 5),
            (d(2024, 1, 4), "S1", None, 4.0, 9.0, 6),
            (d(2024, 1, 5), "S1", "C", 2.0, None, 7),
        ],
        LINES,
    )


def test_daily_sales_drops_null_keys_and_sums_nulls_as_zero(spark):
    got = {(str(r[0]), r[1], r[2]): r[3] for r in facts.daily_sales(lines(spark)).collect()}
    assert got == {
        ("2024-01-01", "S1", "A"): 8.0,
        ("2024-01-02", "S2", "A"): 1.0,
        ("2024-01-03", "S1", "B"): 0.0,
        ("2024-01-05", "S1", "C"): 2.0,
    }


def test_last_price_skips_nulls_and_breaks_ties(spark):
    got = {r["item_id"]: r["last_price"] for r in facts.last_price(lines(spark), ["seq"]).collect()}
    assert got == {"A": 11.0, "B": 9.0}


def test_staged_daily_equals_the_two_step_form(spark):
    raw = lines(spark)
    plain = facts.attach_last_price(facts.daily_sales(raw), facts.last_price(raw, ["seq"]))
    columns = plain.columns
    assert sorted(map(str, staged_daily(raw, "seq").select(columns).collect())) == sorted(map(str, plain.collect()))


def test_item_without_price_keeps_null(spark):
    row = staged_daily(lines(spark), "seq").where("item_id = 'C'").first()
    assert row["last_price"] is None and row["qty"] == 2.0


def test_rename_positional_checks_the_width(spark):
    with pytest.raises(ValueError):
        rename_positional(spark.range(1), SALES_LINES)


def test_load_sales_from_unnamed_columns(spark):
    row = ("C1", "7", "2024-02-01", "9", "1", "A", "3", "2.5", "0", "7.5", "0", "7.5", "S1")
    raw = spark.createDataFrame([row], [f"c{i}" for i in range(13)])
    got = load_sales(raw).first()
    assert (got["invoice_date"], got["qty"], got["last_price"]) == (date(2024, 2, 1), 3.0, 2.5)


def test_discount_total_propagates_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(discount_total(["a", "b"])).collect()] == [3.0, None]


def test_jdbc_reader_passes_caller_options(spark):
    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def options(self, **given):
            self.seen.update(given)
            return self

        def option(self, key, value):
            self.seen[key] = value
            return self

        def load(self):
            return self.seen

    class Session:
        read = Reader()

    seen = read_jdbc(Session(), "lines", {"url": "jdbc:x"}, split_on="day", lower="1", upper="9", splits=4)
    assert seen == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "lines", "partitionColumn": "day",
        "lowerBound": "1", "upperBound": "9", "numPartitions": 4,
    }
    with pytest.raises(ValueError):
        read_jdbc(Session(), "lines", {}, split_on="day")


def test_purchases_round_trip_through_csv(spark):
    header = spark.createDataFrame(
        [("1", "C1", "F1", date(2024, 1, 1), "V", "EUR", "O")],
        "invoice_no string, company string, site string, invoice_date date, supplier string, currency string, status string",
    )
    detail = spark.createDataFrame(
        [("1", "C1", "A", 2.0, 3.5, 7.0, 1), ("2", "C1", "A", 9.0, 1.0, 9.0, 2)],
        "invoice_no string, company string, item_id string, qty double, unit_price double, net_amount double, seq long",
    )
    got = load_purchases(header, detail, ["seq"]).collect()
    assert [tuple(r) for r in got] == [(date(2024, 1, 1), "V", "A", 2.0, 3.5)]


def bom_tables(spark):
    header = spark.createDataFrame(
        [
            ("P", 1, 1, 1, None, None),
            ("P", 2, 1, 1, date(2030, 1, 1), None),
            ("Q", 1, 1, 2, None, None),
            ("R", 1, 1, 1, date(2020, 1, 1), date(2024, 6, 30)),
        ],
        "item_id string, alt int, bom_type int, status int, valid_from date, valid_to date",
    )
    line = spark.createDataFrame(
        [
            ("P", 1, 1, "X", 2.0, 1), ("P", 1, 1, "Y", 0.0, 1), ("P", 1, 1, "Z", 1.0, 2),
            ("P", 2, 1, "W", 1.0, 1), ("Q", 1, 1, "X", 1.0, 1), ("R", 1, 1, "X", 3.0, 1),
        ],
        "item_id string, alt int, bom_type int, component string, qty double, comp_status int",
    )
    return header, line


def test_active_bom_validity(spark):
    header, line = bom_tables(spark)
    edges = masterdata.active_bom(header, line, date(2024, 6, 30)).collect()
    assert sorted(map(tuple, edges)) == [("P", "X", 2.0), ("R", "X", 3.0)]
    later = masterdata.active_bom(header, line, date(2024, 7, 1)).collect()
    assert sorted(map(tuple, later)) == [("P", "X", 2.0)]


def test_stock_conditions(spark):
    header, line = bom_tables(spark)
    stock = spark.createDataFrame(
        [
            ("P", "S1", "5", 1, 0), ("P", "S2", "bad", 1, 0), ("P", "S1", "7", 2, 0), ("P", "S1", "7", 1, 1),
            ("X", "S1", "4", 1, 0), ("O", "S2", "3", 1, 0), ("N", "S1", "3", 1, 0), ("D", "S1", "1", 1, 0),
        ],
        "item_id string, site string, qty string, is_physical int, is_frozen int",
    )
    master = spark.createDataFrame(
        [("P", "p", 1), ("X", "x", 1), ("O", "o", 1), ("N", "n", 1), ("D", "d", 2)],
        "item_id string, label string, status int",
    )
    orders = spark.createDataFrame([("1", "O"), (None, "N"), ("2", "X")], "order_no string, item_id string")
    fg = masterdata.stock_finished_goods(stock, master, header, line, orders).collect()
    assert sorted(map(tuple, fg)) == [("O", "o", 3.0), ("P", "p", 5.0)]
    comp = masterdata.stock_components(stock, master).collect()
    assert sorted(r["item_id"] for r in comp) == ["N", "O", "P", "X"]
    assert masterdata.stock_components(stock, master, site="S2").count() == 2


def test_two_labels_for_one_item_fail(spark):
    stock = spark.createDataFrame([("A", "x", 1.0), ("A", "y", 2.0)], "item_id string, label string, qty_on_hand double")
    with pytest.raises(Exception, match="several labels"):
        masterdata.require_unique_items(stock).collect()


def test_plan_tables_are_directories(spark):
    df = spark.range(3)
    plan = {name: df for name in ("monthly_revenue", "final_stock_fg", "final_stock_comp")}
    paths = write_plan_tables(plan, new_path(spark, "plan"), fmt="csv")
    assert all(spark.read.option("header", True).csv(p).count() == 3 for p in paths.values())


def test_describe_and_profile(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "qty double")
    row = facts.describe(df, "qty").first()
    assert (row["n"], row["mean"], row["p50"], row["max"]) == (3, 2.0, 2.0, 3.0)
    profile = facts.dataset_profile(df, ["qty"], amount="qty").first()
    assert (profile["n_rows"], profile["n_qty"], profile["total_qty"]) == (4, 3, 6.0)


def test_value_counts_top(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "k string")
    assert [tuple(r) for r in facts.value_counts(df, "k", top=1).collect()] == [("a", 2)]
    assert facts.value_counts(df.withColumn("x", F.lit(1)), "x").first()["n_rows"] == 4


def test_latest_values_need_no_sort(spark):
    raw = lines(spark)
    daily = facts.attach_last_price(facts.daily_sales(raw), facts.last_price(raw, ["seq"]))
    for df in (facts.last_price(raw, ["seq"]), facts.last_price(raw), facts.item_stats(daily)):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_item_stats_takes_the_last_known_values(spark):
    rows = [("A", date(2024, 1, 1), "S1", 1.0, 5.0), ("A", date(2024, 1, 3), "S1", 2.0, None), ("A", date(2024, 1, 3), "S2", 9.0, None),
            ("A", date(2024, 1, 2), "S9", 4.0, 7.0), ("B", date(2024, 1, 1), "S1", None, None)]
    daily = spark.createDataFrame(rows, "item_id string, invoice_date date, site string, qty double, last_price double")
    got = {r["item_id"]: tuple(r)[1:] for r in facts.item_stats(daily).collect()}
    assert got == {"A": (4.0, 9.0, 7.0), "B": (None, None, None)}
