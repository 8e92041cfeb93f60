from datetime import date

import pytest
from pyspark.sql import functions as F

from tidestock.operators import forecast, metrics, replenish, reports
from tidestock.plans.planning import baseline_detail, run_planning

DAILY = "invoice_date date, site string, item_id string, qty double, last_price double"


def daily(spark):
    return spark.createDataFrame(
        [
            (date(2024, 1, 31), "S", "A", 10.0, 2.0),
            (date(2023, 2, 10), "S", "A", 4.0, 2.0),
            (date(2023, 2, 11), "S", "A", 8.0, 2.0),
            (date(2023, 5, 1), "S", "B", 3.0, None),
        ],
        DAILY,
    )


def test_future_months_clamp_and_fall_back(spark):
    rows = forecast.forecast_features(daily(spark), 3).where("item_id = 'A'").orderBy("months_ahead").collect()
    assert [r["forecast_date"] for r in rows] == [date(2024, 2, 29), date(2024, 3, 31), date(2024, 4, 30)]
    assert rows[0]["qty_mean_item_month"] == 6.0
    assert rows[1]["qty_mean_item_month"] == pytest.approx(22 / 3)
    assert {r["qty_lag_1"] for r in rows} == {10.0} and {r["day"] for r in rows} == {15}
    assert rows[0]["weekday"] == date(2024, 2, 29).weekday()


def test_detail_and_monthly_totals_agree(spark):
    detail = baseline_detail(daily(spark), 3)
    monthly = forecast.forecast_monthly(detail).collect()
    assert [(r["year"], r["month"]) for r in monthly] == [(2024, 2), (2024, 3), (2024, 4)]
    total = forecast.forecast_total(detail).first()[0]
    assert total == pytest.approx(sum(r["revenue"] for r in monthly))
    rolled = forecast.forecast_rollup(detail).where("level = 3").first()
    assert rolled["revenue_forecast"] == pytest.approx(total)


def test_negative_predictions_become_zero(spark):
    rows = spark.createDataFrame(
        [("A", 2024, 1, -5.0, 2.0), ("A", 2024, 2, 5.0, 2.0)],
        "item_id string, year int, month int, prediction double, last_price double",
    )
    got = forecast.forecast_detail(rows).orderBy("month").collect()
    assert [(r["qty_forecast"], r["revenue_forecast"]) for r in got] == [(0.0, 0.0), (5.0, 10.0)]


def test_fitted_revenue_needs_the_price(spark):
    rows = daily(spark).drop("last_price").withColumn("prediction", F.lit(1.0))
    with pytest.raises(ValueError):
        forecast.fitted_revenue_monthly(rows)


@pytest.mark.parametrize(
    ("coverage", "status", "band"),
    [
        (-2.0, None, "stockout_risk"), (-1.0, None, "stockout_risk"), (-0.5, "stockout_risk", "stockout_risk"),
        (0.0, "stockout_risk", "stockout_risk"), (25.0, "stockout_risk", "low_stock"), (25.01, "low_stock", "low_stock"),
        (75.0, "low_stock", "sufficient"), (75.01, "sufficient", "sufficient"), (100.0, "sufficient", "sufficient"),
    ],
)
def test_status_edges(spark, coverage, status, band):
    row = spark.createDataFrame([(coverage,)], "c double").select(
        replenish.coverage_status(F.col("c")), replenish.coverage_band(F.col("c"))
    ).first()
    assert tuple(row) == (status, band)


def plan(spark):
    detail = spark.createDataFrame(
        [("P", 2024, 1, 60.0, 6.0), ("P", 2024, 2, 40.0, 4.0), ("N", 2024, 1, 0.0, 0.0), ("U", 2024, 1, 8.0, 1.0)],
        "item_id string, year int, month int, qty_forecast double, revenue_forecast double",
    )
    bom = spark.createDataFrame(
        [("P", "X", 2.0), ("P", "X", 0.5), ("U", "X", 1.0), ("U", "Y", 3.0), ("GONE", "Y", 9.0)],
        "fg_item string, component string, qty double",
    )
    stock_fg = spark.createDataFrame([("P", "p", 25.0), ("N", "n", 5.0)], "item_id string, label string, qty_on_hand double")
    stock_comp = spark.createDataFrame([("X", "x", 1000.0)], "item_id string, label string, qty_on_hand double")
    return run_planning(detail, bom, stock_fg, stock_comp)


def test_planning_chain(spark):
    tables = plan(spark)
    assert len(tables) == 10
    fg = {r["item_id"]: r for r in tables["final_stock_fg"].collect()}
    assert (fg["P"]["purchase"], fg["P"]["coverage_pct"], fg["P"]["status"]) == (75.0, 25.0, "stockout_risk")
    assert (fg["N"]["purchase"], fg["N"]["coverage_pct"], fg["N"]["final_stock"]) == (0.0, 100.0, 5.0)
    assert (fg["U"]["qty_on_hand"], fg["U"]["purchase"], fg["U"]["label"]) == (0.0, 8.0, None)
    comp = {r["item_id"]: r for r in tables["final_stock_comp"].collect()}
    assert comp["X"]["requirement"] == 75 * 2.5 + 8 and comp["X"]["n_products"] == 2
    assert (comp["X"]["purchase"], comp["X"]["final_stock"]) == (0.0, 1000 - 195.5)
    assert (comp["Y"]["requirement"], comp["Y"]["purchase"], comp["Y"]["final_stock"]) == (24.0, 24.0, 0.0)


def test_plan_reports(spark):
    tables = plan(spark)
    kpis = replenish.plan_kpis(tables["final_stock_fg"]).first()
    assert (kpis["n_items"], kpis["n_to_buy"], kpis["n_covered"], kpis["n_stockout_risk"]) == (3, 2, 1, 2)
    total = replenish.plan_with_total(tables["purchases_fg"]).where("is_total = 1").first()
    assert (total["item_id"], total["purchase"]) == ("TOTAL", 83.0)
    assert [r["item_id"] for r in replenish.to_buy(tables["purchases_fg"]).collect()] == ["P", "U"]
    shares = {r["status"]: r["share_pct"] for r in reports.status_share(tables["purchases_fg"]).collect()}
    assert shares["stockout_risk"] == pytest.approx(200 / 3)
    assert reports.top_purchases(tables["purchases_fg"], 1).first()["item_id"] == "P"


def test_invariants_of_a_plan(spark):
    for name in ("final_stock_fg", "final_stock_comp"):
        rows = plan(spark)[name]
        bad = rows.where((F.col("purchase") < 0) | (F.col("qty_on_hand") + F.col("purchase") < F.col("requirement")))
        assert bad.count() == 0


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 9, 10, 10]] + [(None,)], "x double")
    got = reports.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["n_rows"] for r in got] == [2, 1, 0, 0, 3]
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert sum(r["n_rows"] for r in reports.histogram(flat, "x", 4).collect()) == 2


def test_metrics_and_verdict(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 9.0), (20.0, 22.0)], "actual double, prediction double")
    row = metrics.regression_metrics(df).first()
    assert row["r2"] == pytest.approx(1 - 6 / 200) and row["mae"] == pytest.approx(4 / 3)
    errors = metrics.mape_table(df).first()
    assert errors["mape_all"] == pytest.approx((1 + 0.1 + 0.1) / 3 * 100)
    assert errors["mape_positive"] == pytest.approx(10.0)
    constant = spark.createDataFrame([(1.0, 1.0)] * 2, "actual double, prediction double")
    assert metrics.regression_metrics(constant).first()["r2"] is None
    scores = spark.createDataFrame([("a", 0.9, 14.9), ("b", 0.84, 15.0), ("c", None, 25.0)], "model string, r2 double, mape double")
    verdict = {r["model"]: (r["r2_ok"], r["mape_class"]) for r in metrics.quality_verdict(scores).collect()}
    assert verdict == {"a": (True, "good"), "b": (False, "acceptable"), "c": (None, "high")}
    assert [r["model"] for r in metrics.compare_models(scores).where("is_best = 1").collect()] == ["a"]


def test_revenue_gap_without_actual_revenue(spark):
    df = spark.createDataFrame(
        [("A", 0.0, 5.0, 2.0), ("B", 10.0, 5.0, 2.0)], "item_id string, actual double, prediction double, last_price double"
    )
    gaps = metrics.revenue_gap(df)
    assert {r["item_id"]: r["gap_pct"] for r in gaps.collect()} == {"A": 0.0, "B": -50.0}
    assert metrics.revenue_gap_total(gaps).first()["gap_pct"] == 0.0
    assert {r["item_id"]: r["is_outside"] for r in reports.validation_table(gaps).collect()} == {"A": 0, "B": 1}
