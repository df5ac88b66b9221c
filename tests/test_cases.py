"""Small literal cases with known answers."""

import math

import pytest
from pyspark.sql import functions as F

from epiframe.functions import geometry as g
from epiframe.functions.values import (
    crop_right_half,
    decode_packet,
    letterbox,
    parse_flag,
    state_bin,
)
from epiframe.operators import audit, stats
from epiframe.operators import sequence as seq
from epiframe.operators.align import Stream, asof, fresh
from epiframe.operators.pose import cumulative_pose, future_chunk
from epiframe.plans.series import Series


def clocks(spark, values, name="t"):
    return spark.createDataFrame([(1, v, i) for i, v in enumerate(values)], f"k INT, {name} BIGINT, id BIGINT")


def matched(spark, source, query, policy):
    out = asof(
        clocks(spark, query), Stream(clocks(spark, source), "t", ["id"]), ["k"], "t", "id", policy
    )
    return [(r.src_index, r.src_delta) for r in out.orderBy("t").collect()]


def test_nearest(spark):
    assert [i for i, _ in matched(spark, [0, 10, 20, 30, 40], [9, 21, 39], "nearest")] == [1, 2, 4]


def test_nearest_tie_takes_the_earlier(spark):
    assert matched(spark, [0, 10], [5, 6, 4, 99, -3], "nearest") == [
        (0, 3), (0, -4), (0, -5), (1, 4), (1, -89),
    ]


@pytest.mark.parametrize("policy", ["nearest", "causal"])
def test_joints(spark, policy):
    assert matched(spark, [0, 90, 210], [100, 220], policy) == [(1, -10), (2, -10)]


def test_causal_before_the_first_row(spark):
    assert matched(spark, [50, 60], [10, 55], "causal") == [(-1, 40), (0, -5)]
    assert matched(spark, [50, 60], [10, 55], "causal_strict") == [(-1, None), (0, -5)]
    flags = spark.createDataFrame([(40,), (-5,), (-500,), (None,)], "d BIGINT")
    causal, near = fresh(F.col("d"), 100, "causal"), fresh(F.col("d"), 100)
    rows = flags.select(causal, near).collect()
    assert [tuple(r) for r in rows] == [(False, True), (True, True), (False, False), (False, False)]


def test_empty_source(spark):
    assert matched(spark, [], [1, 2], "nearest") == [(None, None), (None, None)]


def runs(spark, valid, edge):
    rows = [(1, i, v, e) for i, (v, e) in enumerate(zip(valid, edge))]
    df = spark.createDataFrame(rows, "k INT, pos BIGINT, v BOOLEAN, e BOOLEAN")
    s = seq.valid_runs(Series.plan(df, ["k"], ["pos"]), F.col("v"), F.col("e"))
    return seq.run_records(s.frame(), ["k"], "pos", [])


def bits(text):
    return [c == "T" for c in text]


def test_runs_with_a_bad_edge(spark):
    rec = runs(spark, bits("TTFTTT"), bits("TTTFTT"))
    assert sorted((r.start, r.end) for r in rec.collect()) == [(0, 2), (3, 6)]
    rec = runs(spark, bits("TTTT"), bits("TTFT"))
    assert sorted((r.start, r.end) for r in rec.collect()) == [(0, 2), (2, 4)]


def test_several_runs_are_rejected(spark):
    rec = runs(spark, bits("TFTTFTTTFT"), bits("T" * 10))
    row = seq.single_substantial_run(rec, ["k"]).first()
    assert (row.runs, row.substantial, row.reject_reason) == (4, 2, "multiple_valid_runs")


def test_single_run_is_chosen(spark):
    row = seq.single_substantial_run(runs(spark, bits("TFTTTTFT"), bits("T" * 8)), ["k"]).first()
    assert (row.chosen_run, row.chosen_start, row.chosen_end) == (1, 2, 6)
    row = seq.single_substantial_run(runs(spark, bits("TFT"), bits("TTT")), ["k"]).first()
    assert row.reject_reason == "all_singletons"


@pytest.mark.parametrize("horizon", [50, 90])
def test_padding(spark, horizon):
    s = Series.plan(clocks(spark, [0, 1, 2, 3]), ["k"], ["t"])
    rows = future_chunk(s, F.col("t"), horizon, "t").frame().orderBy("t").collect()
    assert len(rows) == 4 and all(rows[-1].is_pad)
    assert rows[0].is_pad.index(True) == 3
    assert max(max(r.chunk) for r in rows) == 3 and all(len(r.chunk) == horizon for r in rows)
    strict = future_chunk(s, F.col("t"), horizon, "t", strict=True).frame().orderBy("t").collect()
    assert len(strict) == 3 and strict[0].is_pad.index(True) == 2


def test_closed_form_of_padded_slots(spark):
    n, horizon = 60, 50
    s = Series.plan(clocks(spark, range(n)), ["k"], ["t"])
    pads = F.sum(F.size(F.filter("is_pad", lambda p: p)))
    total = future_chunk(s, F.lit(0), horizon, "t").frame().agg(pads).first()[0]
    assert total == horizon * (horizon + 1) // 2


def test_horizon_bounds(spark):
    s = Series.plan(clocks(spark, [0]), ["k"], ["t"])
    for bad in (0, 1025):
        with pytest.raises(ValueError):
            future_chunk(s, F.lit(0), bad, "t")


def test_pose_chain(spark):
    rows = [(1, i, dx, v) for i, (dx, v) in enumerate([(0.0, False), (1.0, True), (1.0, True)])]
    df = spark.createDataFrame(rows, "k INT, frame BIGINT, dx DOUBLE, v BOOLEAN")
    zero = F.lit(0.0)
    df = df.withColumn("d", g.pack([F.col("dx"), zero, zero, zero, zero, zero, F.lit(1.0)]))
    s = Series.plan(df, ["k"], ["frame"])
    out = cumulative_pose(s, "d", F.col("v"), F.col("frame") - 1, "frame").orderBy("frame").collect()
    assert [r.pose.px for r in out] == [0.0, 1.0, 2.0]
    assert [r.linked for r in out] == [False, True, True]


def test_packet_conflict(spark):
    rows = [(1, 123, 0, "5"), (1, 123, 1, "6"), (1, 124, 2, "7"), (1, 124, 3, "7")]
    df = spark.createDataFrame(rows, "k INT, t BIGINT, row INT, p STRING")
    out = seq.dedup_keep_last(df, ["k"], "t", "row", F.col("p"), ["p"]).orderBy("t").collect()
    assert [(r.row, r.duplicates, r.conflict) for r in out] == [(1, 1, True), (3, 1, False)]


def test_packets(spark):
    good = ";".join(str(i) for i in range(25))
    df = spark.createDataFrame([(good,)], "p STRING")
    assert df.select(decode_packet(F.col("p"))).first()[0] == [i / 10 for i in range(6)]
    with pytest.raises(Exception, match="expected 25 values"):
        spark.createDataFrame([("1;2",)], "p STRING").select(decode_packet(F.col("p"))).collect()


def test_flags(spark):
    df = spark.createDataFrame([(w,) for w in ("1", "True", "yes", "0", "FALSE", " no")], "w STRING")
    assert [r[0] for r in df.select(parse_flag(F.col("w"))).collect()] == [True] * 3 + [False] * 3
    with pytest.raises(Exception, match="not a boolean flag"):
        spark.createDataFrame([("maybe",)], "w STRING").select(parse_flag(F.col("w"))).collect()


def test_crop(spark):
    sizes = [(3840, 1200), (3200, 1200), (3838, 1200), (3840, 1199), (0, 0)]
    df = spark.createDataFrame(sizes, "w BIGINT, h BIGINT")
    out = [r[0] for r in df.select(crop_right_half(F.col("w"), F.col("h"))).collect()]
    assert [tuple(c) if c else None for c in out] == [
        (1920, 0, 1920, 1200), (1600, 0, 1600, 1200), None, None, None,
    ]
    box = df.limit(1).select(letterbox(F.lit(1920), F.lit(1200), 640, 480)).first()[0]
    assert tuple(box) == (640, 400, 0, 40)


def test_histogram_equals_direct(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    levels = rng.integers(0, 256, (3, 4000))
    rows = [(c, int(v)) for c in range(3) for v in levels[c]]
    df = spark.createDataFrame(rows, "c INT, v INT")
    hist = stats.build_histogram(df, F.col("c"), F.col("v"))
    for r in stats.histogram_stats(hist).collect():
        x = levels[r.channel] / 255
        assert abs(r.mean - x.mean()) < 1e-12 and abs(r.std - x.std()) < 1e-12
        assert (r.min, r.max) == (x.min(), x.max())


def test_merging_twice_keeps_moments(spark):
    one = spark.createDataFrame([(0, 1.0, 5.0, 3.0, 0.5, 11)], "d INT, min DOUBLE, max DOUBLE, mean DOUBLE, std DOUBLE, n BIGINT")
    r = stats.merge_stats(one.unionAll(one), ["d"]).first()
    assert (r.min, r.max, r.mean, r.n) == (1.0, 5.0, 3.0, 22) and abs(r.std - 0.5) < 1e-15


def test_merged_stats_are_joined_where_they_lie(spark):
    """All rows of a dimension in one task would be a share of the table."""
    rows = spark.range(40).selectExpr("id % 2 AS d", "0.0D AS min", "1.0D AS max", "id * 1.0D AS mean", "0.5D AS std", "2L AS n")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = stats.merge_stats(rows, ["d"])
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert {r.d: (r["mean"], r.n) for r in out.collect()} == {0: (19.0, 40), 1: (20.0, 40)}


def test_masked_mean(spark):
    df = spark.createDataFrame(
        [(1, 1.0, False), (1, 100.0, True), (1, 3.0, False), (2, 9.0, True)], "g INT, x DOUBLE, p BOOLEAN"
    )
    out = stats.masked_mean(df, ["g"], F.col("x"), F.col("p")).orderBy("g").collect()
    assert [(r.masked_mean, r.real_slots) for r in out] == [(2.0, 2), (0.0, 0)]


def test_image_error_of_equal_images(spark):
    a = spark.createDataFrame([(i, float(i)) for i in range(9)], "p INT, v DOUBLE")
    assert stats.image_error(a, a, ["p"], "v", 255.0).first().psnr == math.inf


def test_bins_match_the_edges(spark):
    import numpy as np

    xs = [-1e-17, 0.0, 1.0, 1.5, -1.0, -1.0000001, 0.99999, -0.5, 127 / 128]
    want = (np.digitize(xs, np.linspace(-1, 1, 257)[:-1]) - 1).tolist()
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i INT, x DOUBLE").orderBy("i")
    assert [r[0] for r in df.select(state_bin(F.col("x"))).collect()] == want


def test_three_points(spark):
    """Measured points in millimetres and the rotation they define."""
    o, f, u = (7.435, -15.192, -53.839), (7.435, -100.782, -109.321), (7.435, -20.632, -45.448)
    cols = [[F.lit(x) for x in p] for p in (o, f, u)]
    axes = g.three_point_frame(*cols)
    row = spark.range(1).select(*[axes[k][i] for i in range(3) for k in range(3)]).first()
    want = [0, 1, 0, -0.839121663, 0, -0.543943780, -0.543943780, 0, 0.839121663]
    assert all(abs(a - b) < 1e-9 for a, b in zip(row, want))
    same = g.three_point_frame(cols[0], cols[1], cols[1])
    assert spark.range(1).select(same[0][0], same[1][1], same[2][2]).first() == (None, None, None)


def test_merge_renames_past_used_numbers(spark):
    entries = spark.createDataFrame([(f"{p}/x.txt",) for p in "abcde"] + [("q/y",)], "path STRING")
    existing = spark.createDataFrame([("x__2.txt",), ("x__4.txt",), ("x__5.txt",)], "name STRING")
    plan = audit.merge_plan(entries, existing, "path", "rename").orderBy("path").collect()
    assert [r.target for r in plan] == [
        "x.txt", "x__1.txt", "x__3.txt", "x__6.txt", "x__7.txt", "y",
    ]


def test_digest_of_long_lists(spark):
    import hashlib

    df = spark.range(10).select(F.col("id").alias("pos"), F.col("id").cast("string").alias("t"))
    leaves = [
        hashlib.sha256("\n".join(map(str, range(i, min(i + 4, 10)))).encode()).hexdigest()
        for i in range(0, 10, 4)
    ]
    want = hashlib.sha256("\n".join(leaves).encode()).hexdigest()
    row = audit.chained_digest(df, "pos", "t", leaf=4).first()
    assert (row.tree_sha256, row.levels, row.leaf) == (want, 2, 4)


def test_edge_repeats(spark):
    df = spark.createDataFrame(
        [(k, i, v) for k, vs in {1: [5, 5, 6, 7, 7, 7], 2: [3, 3], 3: [1, 2, 2, 4]}.items() for i, v in enumerate(vs)],
        "k INT, pos INT, v INT",
    )
    out = seq.edge_repeats(Series.plan(df, ["k"], ["pos"]), "v").orderBy("k").collect()
    assert [(r.prefix_repeats, r.suffix_repeats, r.interior_repeats) for r in out] == [
        (1, 2, 0), (1, 0, 0), (0, 0, 1),
    ]


def test_microseconds_do_not_depend_on_the_session_zone(spark):
    from epiframe.functions.values import micros

    texts = ["2024-03-10 02:30:00.5", "2024-11-03 01:30:00", "1969-12-31 23:59:59.999999"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = [r[0] for r in df.select(micros(F.col("t").cast("timestamp_ntz"))).collect()]
            assert got == [1710037800500000, 1730597400000000, -1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_null_checks_are_not_passed(spark):
    rows = [(1, 0, True, True, 0), (1, 1, None, True, 1), (1, 2, True, None, 2), (1, 3, True, True, 3)]
    df = spark.createDataFrame(rows, "k INT, t INT, ok BOOLEAN, edge BOOLEAN, n INT")
    s = seq.span_all_true(Series.plan(df, ["k"], ["t"]), F.col("t") % 2 == 0, F.col("ok"), ["n"])
    assert [r.transition_valid for r in s.frame().orderBy("t").collect()] == [True, False]
    s = seq.valid_runs(Series.plan(df, ["k"], ["t"]), F.lit(True), F.col("edge"))
    assert [r.run for r in s.frame().orderBy("t").collect()] == [0, 0, 1, 1]
    s = seq.valid_runs(Series.plan(df, ["k"], ["t"]), F.col("ok"), F.lit(True))
    assert [r.run for r in s.frame().orderBy("t").collect()] == [0, -1, 1, 1]


def test_episodes_without_runs_are_rejected(spark):
    rec = runs(spark, bits("TT"), bits("TT"))
    all_of = spark.createDataFrame([(1,), (9,)], "k INT")
    got = {r.k: r for r in seq.single_substantial_run(rec, ["k"], episodes=all_of).collect()}
    assert got[9].reject_reason == "no_valid_run" and got[9].runs == 0
    full = seq.emitted_runs(rec, None, ["k"]).first()
    assert full.emitted and full.output_episode_id == "1" and full.discard_reason is None


def test_null_payloads_conflict(spark):
    df = spark.createDataFrame([(1, 5, 0, 3), (1, 5, 1, None), (1, 6, 2, None), (1, 6, 3, None)], "k INT, t INT, r INT, v INT")
    got = {r.t: r.conflict for r in seq.dedup_keep_last(df, ["k"], "t", "r", F.col("v"), ["v"]).collect()}
    assert got == {5: True, 6: False}


def test_missing_pixels_leave_no_error(spark):
    a = spark.createDataFrame([(0, 1.0), (1, 2.0)], "p INT, v DOUBLE")
    row = stats.image_error(a, a.filter("p = 0"), ["p"], "v", 255.0).first()
    assert row.one_sided == 1 and row.mse is None and row.psnr is None


def test_playback_rate(spark):
    times = [0, 10, 25, 40]
    df = spark.createDataFrame([(1, t, i) for i, t in enumerate(times)], "k INT, t BIGINT, i BIGINT")
    rows = seq.cfr_resample(Series.plan(df, ["k"], ["t"]), "t", 5, "i", (2, 1)).orderBy("out_frame").collect()
    # frame n shows source time 10 n; the tail is the median delay of 15
    assert [r.i for r in rows] == [0, 1, 1, 2, 3, 3]


def test_ids_end_where_the_text_ends(spark):
    from epiframe.functions.values import EPISODE_ID

    good = "20260101_120000_1_2"
    df = spark.createDataFrame([(good,), (good + "\n",), ("x" + good,)], "id STRING")
    assert [r.id for r in df.filter(F.col("id").rlike(EPISODE_ID)).collect()] == [good]


@pytest.mark.parametrize("n", [3, 4, 5, 16, 17])
def test_digest_is_one_kind_on_both_sides_of_a_leaf(spark, n):
    import hashlib

    lines, levels = [str(i) for i in range(n)], 0
    while levels == 0 or len(lines) > 1:
        lines = [hashlib.sha256("\n".join(lines[i : i + 4]).encode()).hexdigest() for i in range(0, len(lines), 4)]
        levels += 1
    df = spark.range(n).select(F.col("id").alias("pos"), F.col("id").cast("string").alias("t"))
    row = audit.chained_digest(df, "pos", "t", leaf=4).first()
    assert (row.tree_sha256, row.levels) == (lines[0], levels)


def test_directories_keep_their_whole_name(spark):
    rows = [("a/run.v1", True), ("b/run.v1", True), ("c/x.csv", False), ("d/x.csv", False)]
    entries = spark.createDataFrame(rows, "path STRING, dir BOOLEAN")
    none = spark.createDataFrame([], "name STRING")
    got = {r.path: r.target for r in audit.merge_plan(entries, none, "path", "rename", F.col("dir")).collect()}
    assert got == {"a/run.v1": "run.v1", "b/run.v1": "run.v1__1", "c/x.csv": "x.csv", "d/x.csv": "x__1.csv"}


@pytest.mark.parametrize("source, target", [("/a/b", "file:///a/b/"), ("s3://k/a", "s3://k/a/out")])
def test_merge_refuses_to_write_into_its_source(source, target):
    with pytest.raises(ValueError):
        audit.require_separate(source, target)
    audit.require_separate("/a/b", "/a/bc")


def test_null_values_keep_their_slots(spark, monkeypatch):
    """A null among the values of a chunk is a slot of its own, for plain and for hot keys."""
    df = spark.createDataFrame([(1, i, None if i % 3 == 1 else i) for i in range(12)], "k INT, t INT, v INT")
    for max_rows in (None, 5):
        s = Series.plan(df.join(spark.range(1)) if max_rows else df, ["k"], ["t"], max_rows).number("pos")
        assert (s.hot is not None) == (max_rows is not None)
        got = {r.t: (r.chunk, r.is_pad) for r in future_chunk(s, F.col("v"), 3, "pos").frame().collect()}
        for i in range(12):
            want = [None if j % 3 == 1 else j for j in range(i + 1, min(i + 4, 12))]
            last = want[-1] if want else (None if i % 3 == 1 else i)
            assert got[i] == (want + [last] * (3 - len(want)), [k >= len(want) for k in range(3)])
