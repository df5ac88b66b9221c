"""Random data against plain NumPy and Python loops."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from epiframe.functions import geometry as g
from epiframe.operators import sequence as seq
from epiframe.operators import stats
from epiframe.operators.align import Stream, asof
from epiframe.operators.episode import Sampling, training_samples
from epiframe.operators.pose import cumulative_pose, future_chunk, prefix_products
from epiframe.plans import series
from epiframe.plans.series import Series

QUICK = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def matrix(p, q):
    x, y, z, w = q
    m = np.eye(4)
    m[:3, :3] = [
        [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)],
        [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)],
        [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)],
    ]
    m[:3, 3] = p
    return m


def nine(m):
    return [*m[:3, 3], *m[:3, 0], *m[:3, 1]]


def random_poses(rng, n):
    q = rng.normal(size=(n, 4))
    return rng.normal(size=(n, 3)), q / np.linalg.norm(q, axis=1, keepdims=True)


def pose_table(spark, p, q, extra=()):
    rows = [(1, i, *map(float, p[i]), *map(float, q[i])) for i in range(len(p))]
    df = spark.createDataFrame(rows, "k INT, i BIGINT, a DOUBLE, b DOUBLE, c DOUBLE, x DOUBLE, y DOUBLE, z DOUBLE, w DOUBLE")
    return df.select("k", "i", g.pack([F.col(c) for c in "abcxyzw"]).alias("pose"))


@pytest.mark.parametrize("max_rows", [None, 60])
def test_runs_equal_a_loop(spark, max_rows):
    rng = random.Random(3)
    rows, want = [], {}
    for k in range(60):
        n = rng.randint(1, 30) if k else 400
        v = [rng.random() < 0.7 for _ in range(n)]
        e = [rng.random() < 0.8 for _ in range(n)]
        rows += [(k, i, v[i], e[i]) for i in range(n)]
        run, previous = -1, False
        for i in range(n):
            if v[i] and not (previous and e[i]):
                run += 1
            previous = v[i]
            want[k, i] = run if v[i] else -1
    df = spark.createDataFrame(rows, "k INT, pos BIGINT, v BOOLEAN, e BOOLEAN")
    s = seq.valid_runs(Series.plan(df, ["k"], ["pos"], max_rows), F.col("v"), F.col("e"))
    assert {(r.k, r.pos): r.run for r in s.frame().collect()} == want


@pytest.mark.parametrize("max_rows", [None, 40])
def test_spans_equal_a_loop(spark, max_rows):
    rng = random.Random(4)
    ok = [rng.random() < 0.8 for _ in range(300)]
    cam = np.cumsum([rng.choice([0, 1, 1]) for _ in range(300)]).tolist()
    df = spark.createDataFrame([(1, i, ok[i], cam[i]) for i in range(300)], "k INT, i BIGINT, ok BOOLEAN, cam BIGINT")
    s = seq.span_all_true(
        Series.plan(df, ["k"], ["i"], max_rows), F.col("i") % 3 == 0, F.col("ok"), ["cam"]
    )
    got = {r.i: r.transition_valid for r in s.frame().collect()}
    for i in range(0, 300, 3):
        assert got[i] == (i == 0 or (all(ok[i - 2 : i + 1]) and cam[i] > cam[i - 3]))


@given(st.lists(st.integers(0, 60), min_size=1, max_size=25, unique=True),
       st.lists(st.integers(-5, 65), min_size=1, max_size=25))
@QUICK
def test_nearest_equals_brute_force(spark, source, query):
    source = sorted(source)
    a = spark.createDataFrame([(1, q, i) for i, q in enumerate(query)], "k INT, t BIGINT, id BIGINT")
    b = spark.createDataFrame([(1, s, i) for i, s in enumerate(source)], "k INT, t BIGINT, id BIGINT")
    for r in asof(a, Stream(b, "t", ["id"]), ["k"], "t", "id").collect():
        best = min(range(len(source)), key=lambda i: (abs(source[i] - r.t), source[i]))
        assert (r.src_id, r.src_index, r.src_delta) == (best, best, source[best] - r.t)


@given(st.lists(st.floats(-1e3, 1e3), min_size=1, max_size=40))
@QUICK
def test_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(1, v) for v in values], "k INT, v DOUBLE")
    r = stats.exact_quantiles(df, ["k"], "v", {"a": 0.01, "b": 0.5, "c": 0.99}, 5).first()
    np.testing.assert_allclose([r.a, r.b, r.c], np.quantile(values, [0.01, 0.5, 0.99]), atol=1e-9)


@pytest.mark.parametrize("n", [1, 5, 127, 128, 129, 1000])
def test_prefix_products_equal_numpy(spark, n):
    p, q = random_poses(np.random.default_rng(n), n)
    out = prefix_products(pose_table(spark, p, q), ["k"], "i", "pose").orderBy("i")
    got = out.select(g.pose9(F.col("pose"))).collect()
    m = np.eye(4)
    for i in range(n):
        m = m @ matrix(p[i], q[i])
        np.testing.assert_allclose(got[i][0], nine(m), atol=1e-9)


def test_prefix_products_over_three_levels(spark):
    """More rows than 128 * 128, all steps alike, so the answer is known in closed form."""
    n = 128 * 128 * 2 + 17
    half = 0.5 * 2 * np.pi / 1000
    rows = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("i"))
    step = g.constant((0, 0, 1, 0, 0, np.sin(half), np.cos(half)))
    out = prefix_products(g.with_pose(rows, "pose", step), ["k"], "i", "pose")
    turned = F.col("i") + 1
    angle = turned * F.lit(2 * np.pi / 1000)
    m = g.matrix(g.rotation(F.col("pose")))
    worst = out.agg(
        F.count(F.lit(1)),
        F.max(F.abs(F.col("pose.pz") - turned)),
        F.max(F.abs(m[0][0] - F.cos(angle))),
    ).first()
    assert worst[0] == n and worst[1] < 1e-6 and worst[2] < 1e-8


@pytest.mark.parametrize("max_rows", [None, 50])
def test_chains_with_resets_equal_numpy(spark, max_rows):
    rng = np.random.default_rng(11)
    n = 400
    p, q = random_poses(rng, n)
    valid = rng.random(n) < 0.97
    df = pose_table(spark, p, q)
    flags = spark.createDataFrame([(i, bool(valid[i])) for i in range(n)], "i BIGINT, v BOOLEAN")
    s = Series.plan(df.join(flags, "i"), ["k"], ["i"], max_rows)
    out = cumulative_pose(s, "pose", F.col("v"), F.col("i") - 1, "i")
    # the source column is replaced by the chained pose
    got = out.orderBy("i").select("segment", g.pose9(F.col("pose"))).collect()
    m, segment = np.eye(4), 0
    for i in range(n):
        if i and valid[i]:
            m = m @ matrix(p[i], q[i])
        else:
            m, segment = np.eye(4), segment + (i > 0)
        assert got[i][0] == segment
        np.testing.assert_allclose(got[i][1], nine(m), atol=1e-9)


def test_geometry_equals_numpy(spark):
    p, q = random_poses(np.random.default_rng(5), 60)
    df = pose_table(spark, p, q).withColumn("other", F.lead("pose").over(series.W.partitionBy("k").orderBy("i")))
    a, b = F.col("pose"), F.col("other")
    rows = df.filter("other IS NOT NULL").orderBy("i").select(
        g.pose9(g.compose(a, b)),
        g.pose9(g.inverse(a)),
        g.pose9(g.relative(a, b)),
        F.array(*g.from_matrix(g.matrix(g.rotation(a)))),
        g.rotation_error(g.matrix(g.rotation(a))),
        g.angle_deg(g.rotation(a)),
    ).collect()
    for i, r in enumerate(rows):
        x, y = matrix(p[i], q[i]), matrix(p[i + 1], q[i + 1])
        np.testing.assert_allclose(r[0], nine(x @ y), atol=1e-12)
        np.testing.assert_allclose(r[1], nine(np.linalg.inv(x)), atol=1e-12)
        np.testing.assert_allclose(r[2], nine(np.linalg.inv(x) @ y), atol=1e-12)
        np.testing.assert_allclose(r[3], q[i] if q[i][3] >= 0 else -q[i], atol=1e-9)
        assert r[4] < 1e-12
        assert abs(r[5] - np.degrees(2 * np.arccos(abs(q[i][3])))) < 1e-6


@pytest.mark.parametrize("strict", [False, True])
def test_training_samples_equal_numpy(spark, strict):
    """States and actions of one episode, and the link between them."""
    n, horizon = 12, 5
    p, q = random_poses(np.random.default_rng(9), n)
    df = pose_table(spark, p, q).withColumns(
        {
            "grid_index": F.col("i"),
            "run": F.lit(0),
            "sample_valid": F.lit(True),
            "transition_valid": F.lit(True),
            "j": F.col("i") * 1.5,
        }
    )
    how = Sampling(1, horizon, 1, 1, strict=strict)
    s = training_samples(Series.plan(df, ["k"], ["i"]), "pose", F.array("j"), how)
    rows = s.frame().orderBy("i").collect()
    m = [matrix(p[i], q[i]) for i in range(n)]
    assert [r.i for r in rows] == list(range(1 if strict else 0, n))
    for r in rows:
        before = np.linalg.inv(m[r.i - 1]) @ m[r.i] if r.i else np.eye(4)
        np.testing.assert_allclose(r.state, [*nine(before), r.i * 1.5], atol=2e-6)
        for k in range(1, horizon + 1):
            t = min(r.i + k, n - 1)
            want = [*nine(np.linalg.inv(m[r.i]) @ m[t]), t * 1.5]
            np.testing.assert_allclose(r.action[k - 1], want, atol=2e-6)
            assert r.is_pad[k - 1] == (r.i + k >= n)
        assert r.full_horizon == (r.i + horizon < n)
    for r, following in zip(rows, rows[1:]):
        np.testing.assert_allclose(r.action[0], following.state, atol=2e-6)


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 100, 127, 500])
def test_linspace_equals_numpy(spark, n):
    df = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("pos"))
    s = seq.linspace_sample(Series.plan(df, ["k"], ["pos"]), "pos", 64)
    want = np.linspace(0, n - 1, min(64, n)).round().astype(int).tolist()
    assert sorted(r.pos for r in s.frame().collect()) == want


def test_resampling_equals_searchsorted(spark):
    rng = np.random.default_rng(2)
    times = np.cumsum(rng.integers(1, 40, 200))
    period = 17
    df = spark.createDataFrame([(1, int(t), i) for i, t in enumerate(times)], "k INT, t BIGINT, i BIGINT")
    out = seq.cfr_resample(Series.plan(df, ["k"], ["t"]), "t", period, "i")
    got = [r.i for r in out.orderBy("out_frame").collect()]
    t = times - times[0]
    frames = max(1, int(np.floor((t[-1] + np.median(np.diff(t))) / period + 0.5)))
    want = np.clip(np.searchsorted(t, np.arange(frames) * period, side="right") - 1, 0, 199)
    assert got == want.tolist()


@pytest.mark.parametrize("n", [1, 2, 3, 50, 999, 30_000])
def test_selected_quantiles_equal_numpy(spark, n):
    rng = np.random.default_rng(n)
    x = np.concatenate([rng.normal(size=n - n // 3), rng.integers(0, 3, n // 3)])
    df = spark.createDataFrame([(1, float(v)) for v in x] + [(2, None), (3, 1.5)], "k INT, x DOUBLE").repartition(4)
    points = {"a": 0.0, "b": 0.01, "c": 0.5, "d": 0.99, "e": 1.0}
    got = {r.k: r for r in stats.selected_quantiles(df, ["k"], "x", points).collect()}
    np.testing.assert_allclose([got[1][p] for p in points], np.quantile(x, list(points.values())), rtol=1e-12, atol=1e-12)
    np.testing.assert_allclose([got[1].mean, got[1].std, got[1].n], [x.mean(), x.std(), n], atol=1e-12)
    assert got[3].c == 1.5 and got[3].n == 1


ADVERSARIAL = {
    "sorted": np.arange(40_000, dtype=float),
    "close": 1000 + np.arange(40_000) * 2.0**-40,
    "ties": np.repeat([1.0, 2.0, 2.0 + 2**-50], [100, 30_000, 9_900]),
    "scales": np.concatenate([s * 10.0 ** np.arange(-300, 300, 0.05) for s in (1, -1)]),
    "ends": np.array([-0.0, 0.0, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308] * 50),
    "infinite": np.array([-np.inf] * 30 + [np.inf] * 30 + [1.0] * 40),
}


@pytest.mark.parametrize("counted_rows", [1, 500, None])
@pytest.mark.parametrize("name", ADVERSARIAL)
def test_quantiles_of_hard_values(spark, name, counted_rows):
    """Sorted, close, tied and far apart values, cut into parts until each is a single value."""
    x = ADVERSARIAL[name]
    if counted_rows is not None:
        x = x[:: max(1, len(x) // 4000)]
    df = spark.createDataFrame([(float(v),) for v in x], "x DOUBLE").repartition(3).withColumn("k", F.lit("a"))
    points = {"a": 0.0, "b": 0.01, "c": 0.4999, "d": 0.99, "e": 1.0}
    got = stats.selected_quantiles(df, ["k"], "x", points, counted_rows).first()
    ordered = np.sort(x)
    for p, q in points.items():
        at = (len(x) - 1) * q
        lo, hi = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
        want = lo if lo == hi and np.isfinite(lo) else lo + (hi - lo) * (at - np.floor(at))
        assert got[p] == want or (np.isnan(got[p]) and np.isnan(want)) or np.isclose(got[p], want, rtol=1e-12)
    assert got.n == len(x)


def test_weighted_selection_equals_repeated_rows(spark):
    """Whole weights, also none, count like copies; hard values and few rows counted at once."""
    rng = random.Random(8)
    pool = [0.0, -0.0, 1e-300, -1e300, 5.0, 5.0000001, -5.0, 1e9, 1e9 + 1, 2.5, -7.25]
    rows = [(k, rng.choice(pool) if rng.random() < 0.5 else rng.gauss(0, 3), rng.randrange(0, 6)) for k in "ab" for _ in range(400)]
    rows = [r for r in rows if abs(r[1]) < 1e200] + [("c", 4.0, 3), ("d", 1.0, 0), ("d", 2.0, 2), ("e", None, 4)]
    df = spark.createDataFrame(rows, "k string, x double, w bigint")
    copies = df.select("k", "x", F.explode(F.expr("array_repeat(0, cast(w as int))")))
    points = {"q0": 0.0, "q1": 0.01, "mid": 0.5, "q9": 0.99, "top": 1.0}
    got = stats.selected_quantiles(df, ["k"], "x", points, counted_rows=40, weight="w")
    want = stats.selected_quantiles(copies, ["k"], "x", points)
    got, want = ({r.k: r for r in d.collect()} for d in (got, want))
    assert set(got) == set(want) == set("abcd")
    for k, r in want.items():
        assert [got[k][p] for p in [*points, "n"]] == [r[p] for p in [*points, "n"]]
        assert got[k]["mean"] == pytest.approx(r["mean"], rel=1e-12, abs=1e-9)
        assert got[k]["std"] == pytest.approx(r["std"], rel=1e-9, abs=0.2 if k in "ab" else 1e-10)


@pytest.mark.parametrize("horizon", [1, 3, 50])
def test_future_stats_equal_those_of_chunks(spark, horizon):
    rng = random.Random(horizon)
    rows = [(k, i, [rng.gauss(0, 1), float(i % 5)]) for k, n in (("a", 1), ("b", 2), ("c", 70)) for i in range(n)]
    s = Series.plan(spark.createDataFrame(rows, "k string, pos bigint, v array<double>"), ["k"], ["pos"])
    built = future_chunk(s, F.col("v"), horizon, "pos").frame()
    want = stats.masked_vector_stats(built, {"state": "v"}, {"actions": ("chunk", "is_pad")})
    got = stats.future_stats(s.frame(), "v", horizon, "pos")
    got, want = ({(r.key, r.dim): r for r in d.collect()} for d in (got, want))
    assert set(got) == set(want)
    for at, r in want.items():
        assert tuple(got[at][c] for c in ("n", "q01", "q99")) == tuple(r[c] for c in ("n", "q01", "q99"))
        assert got[at]["mean"] == pytest.approx(r["mean"], abs=1e-12)
        assert got[at]["std"] == pytest.approx(r["std"], rel=1e-9)
