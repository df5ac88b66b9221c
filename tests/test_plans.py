"""Plans of the registered queries: few exchanges, pushed filters, no Python, no cross joins."""

import re

import pytest
from pyspark.sql import functions as F

from epiframe.plans import series
from epiframe.plans.bounds import rows_within
from epiframe.plans.shared import settle
from epiframe.queries import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = [n for n in QUERIES if not n.startswith("stream_")]
ONE_EXCHANGE = [
    "asof_nearest",
    "multi_stream_align",
    "valid_runs",
    "span_all_true",
    "segment_ids",
    "future_chunk",
    "state_delta",
    "cumulative_pose",
    "dedup_keep_last",
]


def plan_of(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(spark, name)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert word not in plan


@pytest.mark.parametrize("name", ONE_EXCHANGE)
def test_one_exchange(spark, name):
    assert len(re.findall(r"Exchange (?:hash|range)partitioning", plan_of(spark, name))) == 1


def test_columns_and_filters_reach_the_scan(spark):
    plan = plan_of(spark, "scan_parquet_projected")
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
    plan = plan_of(spark, "stride_sample")
    assert "EqualTo(event_type,click)" in plan and "props" not in plan


@pytest.mark.parametrize("name", ["asof_nearest", "valid_runs", "future_chunk", "cumulative_pose"])
def test_plans_for_hot_keys(spark, monkeypatch, name):
    """With hot keys there is still no cross join, and only counted tables are broadcast."""
    monkeypatch.setattr(series, "MAX_ROWS", 20)
    monkeypatch.setattr(series, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(spark, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "Python"):
        assert word not in plan


@pytest.mark.parametrize("name", ONE_EXCHANGE)
def test_nothing_is_read_before_the_query(spark, monkeypatch, name):
    """The footers prove that the rows fit a task, so no plan is counted."""
    known, proved = series.rows_within, []

    def rows_within(df, most):
        proved.append(known(df, most))
        return proved[-1]

    monkeypatch.setattr(series, "rows_within", rows_within)
    QUERIES[name](spark, SF)
    assert None not in proved


def test_row_bounds(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    n, most = li.count(), 10**6
    assert rows_within(li, most) == n
    assert rows_within(li, n - 1) is None
    assert rows_within(li.filter("l_quantity > 5").select("l_orderkey").distinct(), most) == n
    assert rows_within(li.union(li).orderBy("l_orderkey").limit(7), most) == 7
    assert rows_within(li.unionByName(li), most) == 2 * n
    assert rows_within(li.join(li.select("l_orderkey"), "l_orderkey", "left_semi"), most) == n
    assert rows_within(li.join(li.select("l_orderkey"), "l_orderkey"), most) is None
    assert rows_within(li.withColumn("x", F.explode(F.array(F.lit(1), F.lit(2)))), most) is None
    assert rows_within(li.limit(0), most) == 0 and rows_within(spark.range(5), most) == 5


def test_hot_keys_cost_one_pass_over_the_rows(spark, monkeypatch):
    """The rows are written once; both parts are read from there."""
    written = []
    monkeypatch.setattr(series, "settle", lambda df, by=None: written.append(by) or settle(df, by))
    df = spark.range(3000).selectExpr("id % 3 AS k", "id AS t").filter("k < 2 OR t < 30")
    df = df.join(spark.range(2).selectExpr("id AS c"))  # no proof
    s = series.Series.plan(df, ["k"], ["t", "c"], 500)
    assert written == [None, "_hot", None]
    assert s.cold.count() == 20 and s.hot.count() == 4000
    for part in (s.cold, s.hot):
        assert "Range" not in part._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["asof_stored", "chunk_stored"])
def test_stored_tables_need_no_exchange(spark, name):
    assert "Exchange" not in plan_of(spark, name)
