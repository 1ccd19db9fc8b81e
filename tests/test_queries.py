import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import TABLES, compare

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    line, ok = compare(spark, con, name, SMALL)
    assert ok, line


def test_entry(spark):
    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["score_all", "docs_train_eval", "cv_records", "ema_perplexity", "merge_history", "latency_hist", "row_cap_large"])
def test_no_cross_joins(spark, name):
    plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_rows_of_a_small_file_are_dealt_to_all_tasks(spark, tmp_path):
    """One file of few bytes is one task's to read, and the variants of its rows would be that task's to make."""
    from chatmill.queries import QUERIES

    spark.range(1, 400).selectExpr(
        "id AS c_custkey", "'n' || id AS c_name", "id % 5 AS c_nationkey", "'BUILDING' AS c_mktsegment"
    ).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(5).selectExpr("id AS n_nationkey", "'N' || id AS n_name").coalesce(1).write.parquet(f"{tmp_path}/nation.parquet")
    for name, column in (("schema_prompt", "prompt"), ("ordered_json", "target"), ("augment_fields", "date_fmt")):
        rows = QUERIES[name](spark, str(tmp_path))
        sizes = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count(column).alias("n")).collect()]
        assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sum(sizes) == 399 * 4 and max(sizes) <= 399
