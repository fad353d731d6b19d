import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = ["events", "lineitem", "customer", "embeddings"]
SAMPLE = ["flows_idle", "response_decide", "dedup", "class_report", "to_alerts", "audit_kpis", "split_stratified"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "Flow Duration" in df.columns


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_counts_equal_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    want = con.execute(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(want.columns) and got.count() == len(want)
