import duckdb
import pytest
from helpers import FOLDER

from tidestock.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        duck.execute(f"create view {table} as from '{FOLDER}/{table}.parquet'")
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    df = QUERIES[name](spark, FOLDER)
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r[n] for n in names) for r in df.collect()) == sorted(result.fetchall())
