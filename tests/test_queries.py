"""Every query of the time-series engine that SQL can express, against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkcast.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
SLOW = {"stream_fleet", "stream_upsert", "stream_dedup", "stream_enrich", "stream_gold_tail"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for name in os.listdir(DATA):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def rows(df: pd.DataFrame) -> list[str]:
    def cell(x):
        if pd.isna(x):
            return "null"
        if isinstance(x, (int, float)) or hasattr(x, "dtype"):
            return f"{float(x) + 0.0:.6f}" if not isinstance(x, pd.Timestamp) else str(x)
        return str(pd.Timestamp(x)) if hasattr(x, "hour") else str(x)

    return sorted("|".join(cell(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(set(registry.ORACLE_SQL) - SLOW))
def test_query(spark, duck, name):
    got, want = registry.QUERIES[name](spark, DATA).toPandas(), duck.sql(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(SLOW))
def test_streams_equal_batches(spark, duck, name):
    assert rows(registry.QUERIES[name](spark, DATA).toPandas()) == rows(duck.sql(registry.ORACLE_SQL[name]).df())


def test_feature_list_has_no_observed_value(spark):
    names = [r.feature for r in registry.QUERIES["feature_cols"](spark, DATA).collect()]
    assert "total" not in names and "gen_lag_24" in names
    assert all(r.breaches == 0 for r in registry.QUERIES["lineage_check"](spark, DATA).collect())


def test_a_layer_is_read_by_month(spark):
    df = registry.QUERIES["recent_months"](spark, DATA)
    files = df.select(F.input_file_name().alias("f")).distinct().collect()
    assert {tuple(r.f.split("/")[-3:-1]) for r in files} == {("p_year=1998", f"p_month={m}") for m in (5, 6, 7)}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "p_year" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
