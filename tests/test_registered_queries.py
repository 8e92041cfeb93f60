"""The driver contract, and a selection of queries against their SQL on the smallest data."""

import pytest

import __spark_entry__ as entry_module
from checks.compare import canonical, duck

FOLDER = "/root/testdata/sf0.001"
SELECTION = [
    "daily_sales", "attach_last_price", "load_purchases_pipeline", "src_stock_fg", "lag_features", "feature_table",
    "event_feature_table", "label_encode_unseen", "iqr_clean", "quantile_bounds", "plan_pipeline", "forecast_rollup",
    "holdout_revenue_gap", "aug_rare", "stationarity_d", "series_backtest", "qq_points", "one_hot_item",
]


def test_every_sql_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert len(entry_module.queries()) > 130


def test_flagship_runs(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "final_stock" in df.columns


@pytest.mark.parametrize("name", SELECTION)
def test_matches_sql(spark, name):
    df = entry_module.queries()[name](spark, FOLDER)
    result = duck(FOLDER).execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, result.fetchall())
