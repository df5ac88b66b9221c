"""The blocked plans for hot keys give the same results as the plain ones.

Thresholds are lowered so that almost every key counts as hot.
"""

import pytest
from oracle import difference, duck
from pyspark.sql import functions as F

from epiframe.operators import stats
from epiframe.plans import series
from epiframe.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
EVENT_QUERIES = [
    "asof_nearest",
    "asof_backward",
    "multi_stream_align",
    "valid_runs",
    "span_all_true",
    "segment_ids",
    "edge_repeats",
    "linspace_sample",
    "resampled_episode",
    "reset_crossing_flag",
    "cumulative_pose",
    "controller_to_hand",
    "global_spans",
    "scan_ordered_id_list",
    "ordered_listing",
    "asof_backward_strict",
    "asof_tolerance_flag",
    "zip_join_verify",
    "select_by_list",
    "page",
    "partition_check",
    "sequence_gaps",
    "packet_clock",
    "run_records",
    "run_rejects",
    "emitted_runs",
    "run_membership",
    "reuse_flag",
    "global_index",
    "median_rate_and_ratio",
    "trajectory_qa",
    "preflight_summary",
    "ordered_digest",
    "pose_compose",
    "delta_roundtrip_check",
    "integrate_hold",
    "state_delta",
    "anchor_relative_action",
    "resampled_episode_strict",
    "episode_rejects",
    "episode_vectors",
    "preflight_report",
    "scan_log_metrics",
]
FRAME_QUERIES = ["future_chunk", "masked_vector_stats", "verify_padding_mask", "cfr_resample", "interval_discontinuity"]


def check(spark, monkeypatch, name, max_rows):
    monkeypatch.setattr(series, "MAX_ROWS", max_rows)
    plain, hot = series.Series.plan, []

    def plan(*args, **kwargs):
        s = plain(*args, **kwargs)
        hot.append(s.hot is not None)
        return s

    monkeypatch.setattr(series.Series, "plan", staticmethod(plan))
    df = QUERIES[name](spark, SF)
    assert any(hot)
    assert difference(df.collect(), df.columns, duck(SF), SQL[name]) is None


@pytest.mark.parametrize("name", EVENT_QUERIES)
def test_hot_keys(spark, monkeypatch, name):
    check(spark, monkeypatch, name, 20)


@pytest.mark.parametrize("name", FRAME_QUERIES)
def test_hot_short_keys(spark, monkeypatch, name):
    check(spark, monkeypatch, name, 8)


def test_summaries_of_summaries(spark, monkeypatch):
    """Blocks of so few rows that the summaries have summaries of their own, four deep."""
    monkeypatch.setattr(series, "MAX_ROWS", 5)
    df = spark.range(300).selectExpr("1 AS k", "id AS t", "IF(id % 50 = 7, id, NULL) AS v").join(spark.range(1).drop("id"))
    s = series.Series.plan(df, ["k"], ["t"])
    s = s.scan(number="n", total={"c": F.col("t")}, held={"h": F.col("v")}, ahead={"a": F.col("v")}, previous={"p": F.col("v")})
    for r in s.frame().collect():
        back = (r.t - 7) // 50 * 50 + 7
        assert (r.n, r.c) == (r.t, r.t * (r.t + 1) // 2)
        assert r.h == (back if r.t >= 7 else None) and r.a == (back + 50 if back + 50 < 300 else None)
        assert r.p == (r.t - 1 if r.t % 50 == 8 else None)


def test_blocks_of_a_hot_key_stay_small(spark):
    """A block is far smaller than the most rows that a task may sort."""
    df = spark.range(1_200_000).selectExpr("1 AS k", "id AS t")
    s = series.Series.plan(df, ["k"], ["t"], 1_000_000)
    assert s.n_blocks == 3
    assert s.hot.groupBy(series.BLOCK).count().agg(F.max("count")).first()[0] < 550_000


def test_spans_are_planned_once(spark, monkeypatch):
    """Index, rows and edges of the spans come from one division into blocks."""
    settled, plain = [], series.settle
    monkeypatch.setattr(series, "settle", lambda df, by=None: settled.append(by) or plain(df, by))
    check(spark, monkeypatch, "spans_check", 200)
    assert settled.count("_hot") == 1


def test_vector_stats_of_hot_and_ordinary_keys(spark):
    df = spark.range(600).selectExpr("IF(id < 400, 0, id % 30) AS k", "id AS t", "array(id % 7, id * 0.5D) AS v")
    s = series.Series.plan(df, ["k"], ["t"], 100)
    assert s.hot is not None
    names = ["k", "dim", "n", "min", "max", "mean", "std"]
    got, want = [
        {tuple(r[:3]): [pytest.approx(x) for x in r[3:]] for r in stats.vector_stats(x, ["k"], "v", 2).select(names).collect()} for x in (s, df)
    ]
    assert len(got) == 60 and got.keys() == want.keys() and all(got[k] == [x.expected for x in want[k]] for k in want)


def test_vector_stats_send_rows_not_sums(spark):
    """Where the rows of a key lie apart, sums before the exchange are wider than the rows."""
    s = series.Series.plan(spark.range(90).selectExpr("id % 30 AS k", "id AS t", "array(id * 0.5D) AS v"), ["k"], ["t"])
    plan = stats.vector_stats(s, ["k"], "v", 1)._jdf.queryExecution().sparkPlan().toString()
    plan = plan[plan.rindex("HashAggregate") :]
    assert "REPARTITION_BY_COL" in plan


def test_inputs_that_fit_a_task_are_not_split(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    assert series.Series.plan(df, ["user_id"], ["ts"]).hot is None


def test_exploded_rows_of_one_key_stay_within_the_bound(spark):
    """Ten million rows that look like a few bytes to the optimizer."""
    df = spark.range(10).select(
        F.lit(1).alias("k"), F.explode(F.sequence(F.col("id") * 1_000_000, F.col("id") * 1_000_000 + 999_999)).alias("t")
    )
    s = series.Series.plan(df, ["k"], ["t"])
    assert s.cold.isEmpty()
    sizes = [r["count"] for r in s.hot.groupBy(series.BLOCK).count().collect()]
    assert sum(sizes) == 10_000_000 and max(sizes) <= 1.25 * series.MAX_ROWS


def test_a_series_like_another_has_its_hot_keys(spark, monkeypatch):
    df = spark.range(5000).selectExpr("id % 3 AS k", "id AS t")
    s = series.Series.plan(df, ["k"], ["t"], 300)
    with monkeypatch.context() as m:
        m.setattr(series, "hot_keys", lambda *a: pytest.fail("counted again"))
        again = series.Series.plan(df.filter("t % 2 = 0"), ["k"], ["t"], 300, like=s)
    assert again.number("n").frame().count() == 2500 and again.hot is not None


def test_one_key_with_all_rows(spark):
    df = spark.range(5000).selectExpr("1 AS k", "id AS t", "id % 7 AS v")
    s = series.Series.plan(df, ["k"], ["t"], 300).number("pos")
    assert s.hot is not None and s.cold.isEmpty()
    s = s.cumulate({"c": F.col("v")}).shift({"p": F.col("t")}).shift({"n": F.col("t")}, forward=True)
    rows = sorted(s.frame().collect(), key=lambda r: r.t)
    total = 0
    for i, r in enumerate(rows):
        total += i % 7
        assert (r.pos, r.c) == (i, total)
        assert r.p == (i - 1 if i else None)
        assert r.n == (i + 1 if i < 4999 else None)
