"""Rigid-transform jobs over the pose table, and value scaling over the state table.

The SQL side works with rotation matrices, the Spark side with quaternions.
"""

import math

from pyspark.sql import functions as F

from epiframe.functions import geometry as g
from epiframe.functions.values import (
    quantile_scale,
    quantile_unscale,
    r6,
    state_bin,
    zero_pad,
)
from epiframe.operators import pose as po
from epiframe.operators.align import Stream
from epiframe.plans.shared import settle
from epiframe.operators.episode import Sampling, emitted_rows, resampled_grid, strict_choice, training_samples
from epiframe.queries.base import (
    EM,
    EV,
    HORIZON,
    LI,
    events,
    kind,
    kind_sql,
    asof_sql,
    pose_rows,
    pose_series,
    query,
    r6_sql,
    source,
    table,
    with_sql,
)
from epiframe.queries.joins import CALIBRATION, calibrations
from epiframe.queries.sequence import DAY, HOUR, W_EV, props_k, K_SQL
from epiframe.queries.stats import BOUNDS_SQL, DIMS, ST, bounds, bounds_row

NINE = ("x", "y", "z", "c0", "c1", "c2", "c3", "c4", "c5")
W_EM = "OVER (PARTITION BY label ORDER BY vec_id)"


def nine(pose):
    """pose9 as nine rounded columns."""
    m = g.matrix(g.rotation(pose))
    values = [*g.position(pose), *[m[r][0] for r in range(3)], *[m[r][1] for r in range(3)]]
    return [r6(v).alias(n) for v, n in zip(values, NINE)]


def V(prefix=""):
    return [f"{prefix}p{a}" for a in "xyz"]


def M(prefix=""):
    return [[f"{prefix}r{i}{j}" for j in range(3)] for i in range(3)]


def const(m):
    return [[f"({x!r}::DOUBLE)" for x in row] for row in m]


def T(m):
    return [[m[j][i] for j in range(3)] for i in range(3)]


def mm(a, b):
    return [
        ["(" + " + ".join(f"{a[i][k]}*{b[k][j]}" for k in range(3)) + ")" for j in range(3)]
        for i in range(3)
    ]


def mv(a, v):
    return ["(" + " + ".join(f"{a[i][k]}*{v[k]}" for k in range(3)) + ")" for i in range(3)]


def add(a, b):
    return [f"({x} + {y})" for x, y in zip(a, b)]


def sub(a, b):
    return [f"({x} - {y})" for x, y in zip(a, b)]


def nine_sql(p, m):
    values = [*p, *[m[r][0] for r in range(3)], *[m[r][1] for r in range(3)]]
    return ", ".join(f"{r6_sql(v)} AS {n}" for v, n in zip(values, NINE))


def cols_sql(p, m, prefix=""):
    parts = [f"{x} AS {prefix}p{a}" for x, a in zip(p, "xyz")]
    parts += [f"{m[i][j]} AS {prefix}r{i}{j}" for i in range(3) for j in range(3)]
    return ", ".join(parts)


NAMES = [*V(), *[x for row in M() for x in row]]
PREV = "pv AS (SELECT *, " + ", ".join(f"lag({c}) {W_EM} AS l_{c}" for c in NAMES) + " FROM em)"


def quat_matrix(q):
    x, y, z, w = q
    return [
        [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)],
        [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)],
        [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)],
    ]


@query(
    "quat_normalize",
    with_sql(
        [EM],
        f"""SELECT vec_id, {r6_sql('an')} AS norm, an >= 1e-12 AND abs(an - 1) <= 0.05 AS input_ok,
        an >= 1e-8 AS converter_ok, abs(an - 1) <= 1e-10 AS replay_ok,
        {', '.join(r6_sql(f'a{a} / an') + f' AS q{a}' for a in 'xyzw')} FROM em1""",
    ),
)
def quat_normalize(spark, sf_dir):
    raw = [F.get("embedding", F.lit(i)).cast("double") for i in range(3, 7)]
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", *[c.alias(f"a{a}") for c, a in zip(raw, "xyzw")]
    )
    q = [F.col(f"a{a}") for a in "xyzw"]
    n = g.norm(q)
    return rows.select(
        "vec_id",
        r6(n).alias("norm"),
        g.normalise(q, 1e-12, 0.05)[0].isNotNull().alias("input_ok"),
        g.normalise(q, 1e-8)[0].isNotNull().alias("converter_ok"),
        (F.abs(n - 1.0) <= 1e-10).alias("replay_ok"),
        *[r6(c).alias(f"q{a}") for c, a in zip(g.normalise(q, 1e-8), "xyzw")],
    )


@query(
    "quat_to_matrix",
    with_sql([EM], "SELECT vec_id, " + ", ".join(f"{r6_sql(c)} AS {c}" for c in NAMES[3:]) + " FROM em"),
)
def quat_to_matrix(spark, sf_dir):
    m = g.matrix(g.rotation(F.col("pose")))
    cells = [r6(m[i][j]).alias(f"r{i}{j}") for i in range(3) for j in range(3)]
    return pose_rows(spark, sf_dir).select("vec_id", *cells)


@query(
    "matrix_to_quat",
    with_sql(
        [EM],
        "SELECT vec_id, "
        + ", ".join(r6_sql(f"CASE WHEN qw < 0 THEN -q{a} ELSE q{a} END") + f" AS q{a}" for a in "xyzw")
        + " FROM em",
    ),
)
def matrix_to_quat(spark, sf_dir):
    m = g.matrix(g.rotation(F.col("pose")))
    cells = [m[i][j].alias(f"r{i}{j}") for i in range(3) for j in range(3)]
    rows = pose_rows(spark, sf_dir).select("vec_id", *cells)
    q = g.from_matrix([[F.col(f"r{i}{j}") for j in range(3)] for i in range(3)])
    return rows.select("vec_id", *[r6(c).alias(f"q{a}") for c, a in zip(q, "xyzw")])


@query(
    "rotation_check",
    with_sql([EM], "SELECT vec_id, true AS rotation_ok, false AS stretched_ok FROM em"),
)
def rotation_check(spark, sf_dir):
    """The rotation itself, and the same matrix stretched by one per mille."""
    m = g.matrix(g.rotation(F.col("pose")))
    longer = [[c * 1.001 for c in row] for row in m]
    return pose_rows(spark, sf_dir).select(
        "vec_id",
        (g.rotation_error(m) <= 1e-9).alias("rotation_ok"),
        (g.rotation_error(longer) <= 1e-9).alias("stretched_ok"),
    )


def with_previous(spark, sf_dir):
    s = pose_series(spark, sf_dir).shift({"prev": F.col("pose")})
    return s.frame().filter("prev IS NOT NULL")


@query(
    "pose_compose",
    with_sql(
        [EM, PREV],
        f"""SELECT vec_id, {nine_sql(add(V('l_'), mv(M('l_'), V())), mm(M('l_'), M()))}
        FROM pv WHERE l_px IS NOT NULL""",
    ),
)
def pose_compose(spark, sf_dir):
    rows = with_previous(spark, sf_dir)
    return rows.select("vec_id", *nine(g.compose(F.col("prev"), F.col("pose"))))


@query(
    "pose_inverse",
    with_sql(
        [EM],
        f"SELECT vec_id, {nine_sql([f'-({x})' for x in mv(T(M()), V())], T(M()))} FROM em",
    ),
)
def pose_inverse(spark, sf_dir):
    return pose_rows(spark, sf_dir).select("vec_id", *nine(g.inverse(F.col("pose"))))


RELATIVE = (mv(T(M("l_")), sub(V(), V("l_"))), mm(T(M("l_")), M()))


@query(
    "pose_relative",
    with_sql([EM, PREV], f"SELECT vec_id, {nine_sql(*RELATIVE)} FROM pv WHERE l_px IS NOT NULL"),
)
def pose_relative(spark, sf_dir):
    rows = with_previous(spark, sf_dir)
    return rows.select("vec_id", *nine(g.relative(F.col("prev"), F.col("pose"))))


@query(
    "spatial_delta",
    with_sql(
        [EM, PREV],
        f"""SELECT vec_id, {nine_sql(sub(V(), V('l_')), mm(M(), T(M('l_'))))}
        FROM pv WHERE l_px IS NOT NULL""",
    ),
)
def spatial_delta(spark, sf_dir):
    rows = with_previous(spark, sf_dir)
    return rows.select("vec_id", *nine(g.spatial_delta(F.col("prev"), F.col("pose"))))


@query(
    "encode_rot6d",
    with_sql(
        [
            EM,
            "e AS (SELECT vec_id, unnest(range(9)) AS dim, unnest(["
            + ", ".join([*V(), "r00", "r10", "r20", "r01", "r11", "r21"])
            + "]) AS x FROM em)",
        ],
        f"SELECT vec_id, dim::INTEGER AS dim, {r6_sql('x')} AS x FROM e",
    ),
)
def encode_rot6d(spark, sf_dir):
    rows = pose_rows(spark, sf_dir).select("vec_id", F.posexplode(g.pose9(F.col("pose"))).alias("dim", "x"))
    return rows.withColumn("x", r6(F.col("x")))


ORIGIN_SHIFT = -0.042
_CAL = {s: ([f"({x!r}::DOUBLE)" for x in v[:3]], const(quat_matrix(v[3:]))) for s, v in CALIBRATION.items()}


def _side(values):
    left, right = values
    if isinstance(left, list):
        return [_side(pair) for pair in zip(left, right)]
    return f"CASE WHEN label < 5 THEN {left} ELSE {right} END"


_HAND_P = add(V(), mv(M(), ["cx", "cy", "cz"]))
_HAND = (
    "cal AS (SELECT *, "
    + ", ".join(f"{e} AS c{a}" for e, a in zip(_side((_CAL["left"][0], _CAL["right"][0])), "xyz"))
    + ", "
    + ", ".join(
        f"{e} AS k{i}{j}"
        for i, row in enumerate(_side((_CAL["left"][1], _CAL["right"][1])))
        for j, e in enumerate(row)
    )
    + " FROM em), "
    + "hr AS (SELECT label, vec_id, qw > -0.2 AS ok, "
    + cols_sql(_HAND_P, mm(M(), [[f"k{i}{j}" for j in range(3)] for i in range(3)]))
    + " FROM cal), "
    + "hand AS (SELECT label, vec_id, ok, "
    + cols_sql([f"p{a} + r{i}0 * ({ORIGIN_SHIFT})" for i, a in enumerate("xyz")], M())
    + " FROM hr), "
    + "hp AS (SELECT *, lag(ok) " + W_EM + " AS l_ok, lag(vec_id) " + W_EM + " AS l_id, "
    + ", ".join(f"lag({c}) {W_EM} AS l_{c}" for c in NAMES)
    + " FROM hand)"
)
_OK = "coalesce(ok AND l_ok AND vec_id - l_id <= 12, false)"
_EYE = [["1.0" if i == j else "0.0" for j in range(3)] for i in range(3)]


def hand_poses(spark, df):
    """Controller poses moved to the hand target by the calibration of their side."""
    side = F.when(F.col("label") < 5, "left").otherwise("right")
    rows = df.withColumns({"side": side, "ok": F.col("pose.qw") > -0.2})
    rows = rows.join(F.broadcast(calibrations(spark)), "side")  # two rows, one per side
    shift = g.constant((ORIGIN_SHIFT, 0, 0, 0, 0, 0, 1))
    rows = g.with_pose(rows, "hand", g.compose(F.col("pose"), F.col("offset")))
    return g.with_pose(rows, "hand", g.compose(F.col("hand"), shift)).drop("pose", "offset")


def hand_deltas(spark, sf_dir):
    s = pose_series(spark, sf_dir).map(lambda d: hand_poses(spark, d))
    return po.relative_deltas(s, "hand", "ok", "vec_id", "vec_id", step=0, max_dt=12)


@query(
    "controller_to_hand",
    with_sql(
        [EM, _HAND],
        f"SELECT label, vec_id, l_id AS previous_frame, vec_id - l_id AS dt, {_OK} AS delta_valid, "
        + nine_sql(
            [f"CASE WHEN {_OK} THEN {x} ELSE 0 END" for x in RELATIVE[0]],
            [
                [f"CASE WHEN {_OK} THEN {x} ELSE {e} END" for x, e in zip(r, er)]
                for r, er in zip(RELATIVE[1], _EYE)
            ],
        )
        + " FROM hp",
    ),
)
def controller_to_hand(spark, sf_dir):
    rows = hand_deltas(spark, sf_dir).frame()
    return rows.select(
        "label", "vec_id", "previous_frame", "dt", "delta_valid", *nine(F.col("delta"))
    )


@query(
    "delta_roundtrip_check",
    with_sql(
        [EM, _HAND],
        f"""SELECT label, count(*) FILTER (WHERE {_OK}) AS valid_deltas,
        count(*) FILTER (WHERE {_OK} AND vec_id % 41 = 0) AS moved, count(*) FILTER (WHERE {_OK} AND vec_id % 53 = 0) AS turned,
        count(*) FILTER (WHERE {_OK} AND vec_id % 41 = 0) = 0 AS position_ok,
        count(*) FILTER (WHERE {_OK} AND vec_id % 53 = 0) = 0 AS rotation_ok FROM hp GROUP BY 1""",
    ),
)
def delta_roundtrip_check(spark, sf_dir):
    """Previous pose times delta must give the current pose back within 1e-9.

    Deltas of every 41st vector are moved by 1e-6, those of every 53rd are turned by 1e-4.
    """
    rows = hand_deltas(spark, sf_dir).frame().filter("delta_valid")
    off = F.when(F.col("vec_id") % 41 == 0, F.lit(1e-6)).otherwise(F.lit(0.0))
    half = F.when(F.col("vec_id") % 53 == 0, F.lit(1e-4)).otherwise(F.lit(0.0)) / 2
    zero = F.lit(0.0)
    spoil = g.pack([off, zero, zero, zero, zero, F.sin(half), F.cos(half)])
    rows = rows.withColumn("_spoil", spoil)
    rows = g.with_pose(rows, "_spoiled", g.compose(F.col("delta"), F.col("_spoil")))
    rows = g.with_pose(rows, "back", g.compose(F.col("_pp"), F.col("_spoiled")))
    gap = [a - b for a, b in zip(g.position(F.col("back")), g.position(F.col("hand")))]
    a, b = (g.matrix(g.rotation(F.col(c))) for c in ("back", "hand"))
    turn = F.greatest(*[F.abs(a[i][j] - b[i][j]) for i in range(3) for j in range(3)])
    return rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("valid_deltas"),
        F.count_if(g.norm(gap) > 1e-9).alias("moved"),
        F.count_if(turn > 1e-9).alias("turned"),
        (F.max(g.norm(gap)) <= 1e-9).alias("position_ok"),
        (F.max(turn) <= 1e-9).alias("rotation_ok"),
    )


def _cross(a, b):
    return [
        f"({a[1]}*{b[2]} - {a[2]}*{b[1]})",
        f"({a[2]}*{b[0]} - {a[0]}*{b[2]})",
        f"({a[0]}*{b[1]} - {a[1]}*{b[0]})",
    ]


@query(
    "three_point_frame",
    with_sql(
        [
            "t0 AS (SELECT vec_id, "
            + ", ".join(
                f"embedding[{4 + i}]::DOUBLE - embedding[{1 + i}]::DOUBLE AS f{i}, "
                f"embedding[{7 + i}]::DOUBLE - embedding[{1 + i}]::DOUBLE AS u{i}"
                for i in range(3)
            )
            + " FROM embeddings)",
            "t1 AS (SELECT *, " + ", ".join(f"f{i} / sqrt(f0*f0 + f1*f1 + f2*f2) AS x{i}" for i in range(3)) + " FROM t0)",
            "t2 AS (SELECT *, " + ", ".join(f"{e} AS s{i}" for i, e in enumerate(_cross(["u0", "u1", "u2"], ["x0", "x1", "x2"]))) + " FROM t1)",
            "t3 AS (SELECT *, " + ", ".join(f"s{i} / sqrt(s0*s0 + s1*s1 + s2*s2) AS y{i}" for i in range(3)) + " FROM t2)",
            "t4 AS (SELECT *, " + ", ".join(f"{e} AS z{i}" for i, e in enumerate(_cross(["x0", "x1", "x2"], ["y0", "y1", "y2"]))) + " FROM t3)",
        ],
        "SELECT vec_id, " + ", ".join(f"{r6_sql(f'{a}{i}')} AS {a}{i}" for a in "xyz" for i in range(3)) + " FROM t4",
    ),
)
def three_point_frame(spark, sf_dir):
    e = [F.get("embedding", F.lit(i)).cast("double") for i in range(9)]
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", *[c.alias(f"e{i}") for i, c in enumerate(e)]
    )
    e = [F.col(f"e{i}") for i in range(9)]
    axes = g.three_point_frame(e[:3], e[3:6], e[6:9])
    return rows.select(
        "vec_id",
        *[r6(axes[k][i]).alias(f"{a}{i}") for k, a in enumerate("xyz") for i in range(3)],
    )


_A = [["0", "0", "-1"], ["-1", "0", "0"], ["0", "1", "0"]]


@query(
    "basis_change",
    with_sql([EM], f"SELECT vec_id, {nine_sql(mv(_A, V()), mm(mm(_A, M()), T(_A)))} FROM em"),
)
def basis_change(spark, sf_dir):
    return pose_rows(spark, sf_dir).select("vec_id", *nine(g.basis_change(F.col("pose"))))


_X90 = [["1", "0", "0"], ["0", "0", "-1"], ["0", "1", "0"]]


@query(
    "conjugate_delta",
    with_sql([EM], f"SELECT vec_id, {nine_sql(mv(T(_X90), V()), mm(mm(T(_X90), M()), _X90))} FROM em"),
)
def conjugate_delta(spark, sf_dir):
    """The motion seen from a frame turned by +90 degrees about x."""
    half = math.sqrt(0.5)
    turn = g.constant((0, 0, 0, half, 0, 0, half))
    rows = g.conjugated(pose_rows(spark, sf_dir), "seen", F.col("pose"), turn)
    return rows.select("vec_id", *nine(F.col("seen")))


@query(
    "scale_delta",
    with_sql(
        [
            EM,
            """sc AS (SELECT *, sqrt(qx*qx + qy*qy + qz*qz) AS s, CASE WHEN qw < 0 THEN -1 ELSE 1 END AS f FROM em)""",
            "th AS (SELECT *, 0.5 * 2 * atan2(s, f*qw) AS t, f*qx/s AS ux, f*qy/s AS uy, f*qz/s AS uz FROM sc)",
            # Rodrigues' formula for the scaled rotation vector
            """rd AS (SELECT vec_id, 0.5*px AS px, 0.5*py AS py, 0.5*pz AS pz,
              cos(t) + ux*ux*(1 - cos(t)) AS r00, ux*uy*(1 - cos(t)) - uz*sin(t) AS r01, 0.0 AS r02,
              ux*uy*(1 - cos(t)) + uz*sin(t) AS r10, cos(t) + uy*uy*(1 - cos(t)) AS r11, 0.0 AS r12,
              ux*uz*(1 - cos(t)) - uy*sin(t) AS r20, uy*uz*(1 - cos(t)) + ux*sin(t) AS r21, 0.0 AS r22
              FROM th)""",
        ],
        f"SELECT vec_id, {nine_sql(V(), M())} FROM rd",
    ),
)
def scale_delta(spark, sf_dir):
    return pose_rows(spark, sf_dir).select("vec_id", *nine(g.scale(F.col("pose"), 0.5, 0.5)))


@query(
    "rotation_angle",
    with_sql(
        [EM, "q AS (SELECT *, " + ", ".join(f"lag(q{a}) {W_EM} AS l{a}" for a in "xyzw") + " FROM em)"],
        f"""SELECT vec_id, {r6_sql('degrees(2 * acos(least(1, abs(qw))))')} AS angle,
        CASE WHEN lx IS NOT NULL THEN
        {r6_sql('degrees(2 * acos(least(1, abs(qx*lx + qy*ly + qz*lz + qw*lw))))')} END AS turn_from_previous
        FROM q""",
    ),
)
def rotation_angle(spark, sf_dir):
    rows = pose_series(spark, sf_dir).shift({"prev": F.col("pose")}).frame()
    q, p = g.rotation(F.col("pose")), g.rotation(F.col("prev"))
    turn = F.when(F.col("prev").isNotNull(), g.angle_between_deg(q, p))
    return rows.select("vec_id", r6(g.angle_deg(q)).alias("angle"), r6(turn).alias("turn_from_previous"))


# -- chains, states and actions ------------------------------------------------------------

_STEP = (add(V("a."), mv(M("a."), V("d."))), mm(M("a."), M("d.")))


def _chain(start, linked, extra_first, extra_next, extra_names):
    first = ", ".join(["0.0::DOUBLE AS " + c for c in V()] + [f"{_EYE[i][j]}::DOUBLE AS r{i}{j}" for i in range(3) for j in range(3)])
    if start == "delta":
        first = ", ".join(
            [f"CASE WHEN {linked} THEN {c} ELSE 0 END AS {c}" for c in V()]
            + [f"CASE WHEN {linked} THEN r{i}{j} ELSE {_EYE[i][j]} END AS r{i}{j}" for i in range(3) for j in range(3)]
        )
    hold = {
        "identity": ([ "0.0"] * 3, _EYE),
        "delta": (V("a."), M("a.")),
    }[start]
    d = linked.replace("qw", "d.qw")
    nxt = ", ".join(
        [f"CASE WHEN {d} THEN {x} ELSE {h} END" for x, h in zip(_STEP[0], hold[0])]
        + [f"CASE WHEN {d} THEN {_STEP[1][i][j]} ELSE {hold[1][i][j]} END" for i in range(3) for j in range(3)]
    )
    return (
        "WITH RECURSIVE " + EM + f""",
        c AS (SELECT label, vec_id, pos, {extra_first} {first} FROM em WHERE pos = 0
        UNION ALL SELECT d.label, d.vec_id, d.pos, {extra_next.replace('LINK', d)} {nxt}
        FROM c a JOIN em d ON d.label = a.label AND d.pos = a.pos + 1)
        SELECT label, vec_id, {extra_names} {nine_sql(V(), M())} FROM c"""
    )


@query(
    "cumulative_pose",
    _chain(
        "identity",
        "(qw > -0.4)",
        "0::BIGINT AS segment,",
        "a.segment + CASE WHEN LINK THEN 0 ELSE 1 END,",
        "segment,",
    ),
)
def cumulative_pose(spark, sf_dir):
    s = pose_series(spark, sf_dir).shift({"declared": F.col("vec_id")})
    out = po.cumulative_pose(s.with_columns({"d": F.col("pose")}), "d", F.col("pose.qw") > -0.4,
                             F.col("declared"), "vec_id")
    return out.select("label", "vec_id", "segment", *nine(F.col("pose")))


@query("integrate_hold", _chain("delta", "(qw > -0.2)", "", "", ""))
def integrate_hold(spark, sf_dir):
    s = pose_series(spark, sf_dir).with_columns({"ok": F.col("pose.qw") > -0.2, "d": F.col("pose")})
    out = po.integrate_hold(s, F.col("d"), F.col("ok"))
    return out.select("label", "vec_id", *nine(F.col("pose")))


_EYE9 = ["0", "0", "0"]
_STATE = (
    [f"CASE WHEN l_px IS NULL THEN 0 ELSE {x} END" for x in RELATIVE[0]],
    [[f"CASE WHEN l_px IS NULL THEN {e} ELSE {x} END" for x, e in zip(r, er)] for r, er in zip(RELATIVE[1], _EYE)],
)


@query("state_delta", with_sql([EM, PREV], f"SELECT label, vec_id, {nine_sql(*_STATE)} FROM pv"))
def state_delta(spark, sf_dir):
    rows = po.state_delta(pose_series(spark, sf_dir), "pose").frame()
    return rows.select("label", "vec_id", *nine(F.col("state")))


ACTION = (mv(T(M("a.")), sub(V("t."), V("a."))), mm(T(M("a.")), M("t.")))
_ACT = [
    EM,
    "n AS (SELECT label, count(*) AS n FROM em GROUP BY 1)",
    f"k AS (SELECT unnest(range(1, {HORIZON + 1})) AS k)",
]
_ACT_FROM = """FROM em a JOIN n USING (label) CROSS JOIN k
  JOIN em t ON t.label = a.label AND t.pos = least(a.pos + k, n.n - 1)"""


def actions(spark, sf_dir, strict=False):
    s = pose_series(spark, sf_dir).number("pos")
    s = po.future_chunk(s, F.col("pose"), HORIZON, "pos", strict)
    return po.slots(s.frame(), ["label", "vec_id", "pos", "pose"])


@query(
    "anchor_relative_action",
    with_sql(
        _ACT,
        f"""SELECT a.label, a.vec_id, k::INTEGER AS k, a.pos + k >= n.n AS padded,
        {nine_sql(*ACTION)} {_ACT_FROM}""",
    ),
)
def anchor_relative_action(spark, sf_dir):
    rows = actions(spark, sf_dir)
    return rows.select("label", "vec_id", "k", "padded", *nine(g.relative(F.col("pose"), F.col("target"))))


@query(
    "action_state_invariant",
    with_sql(
        [EM, f"nx AS (SELECT label, lead(vec_id) {W_EM} AS next_id FROM em)"],
        """SELECT label, count(next_id) AS compared, count(*) FILTER (WHERE next_id % 37 = 0) AS violations
        FROM nx GROUP BY 1""",
    ),
)
def action_state_invariant(spark, sf_dir):
    """The first action of a row must be the state of the next row, within 2e-6.

    The states of every 37th vector are moved by five times that.
    """
    s = pose_series(spark, sf_dir).number("pos")
    s = po.future_chunk(s, F.col("pose"), HORIZON, "pos")
    s = po.state_delta(s, "pose").shift({"next_state": F.col("state"), "next_id": F.col("vec_id")}, forward=True)
    spoiled = F.when(F.col("next_id") % 37 == 0, F.lit(1e-5)).otherwise(F.lit(0.0))
    state = F.transform(g.pose9(F.col("next_state")), lambda x: x + spoiled)
    action = g.pose9(g.relative(F.col("pose"), F.col("chunk")[0]))
    far = F.exists(
        F.zip_with(action, state, lambda a, b: F.abs(a - b)), lambda e: e > 2e-6
    )
    real = ~F.col("is_pad")[0]
    return s.frame().groupBy("label").agg(
        F.count_if(real).alias("compared"), F.count_if(real & far).alias("violations")
    )


_INV = ([f"-({x})" for x in mv(T(M()), V())], T(M()))
_SIX = lambda p, m: [*p, m[0][0], m[1][0], m[2][0], m[0][1], m[1][1], m[2][1]]


@query(
    "packed_vector",
    with_sql(
        [
            EM,
            "v AS (SELECT em.vec_id, list_concat([" + ", ".join(_SIX(V(), M()) + _SIX(*_INV)) + "],"
            " embedding[8:19]::DOUBLE[])::FLOAT[] AS s FROM em JOIN embeddings e ON e.vec_id = em.vec_id)",
            "u AS (SELECT vec_id, unnest(range(30)) AS dim, unnest(s) AS x FROM v)",
        ],
        f"SELECT vec_id, dim::INTEGER AS dim, {r6_sql('x::DOUBLE')} AS x FROM u",
    ),
)
def packed_vector(spark, sf_dir):
    """Two pose9 blocks and twelve joints as one float vector of 30."""
    joints = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.slice("embedding", 8, 12).cast("array<double>").alias("joints"),
        *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(7)],
    )
    e = [F.col(f"e{i}") for i in range(7)]
    rows = joints.select("vec_id", "joints", g.pack(e[:3] + g.unit(e[3:])).alias("pose"))
    packed = F.concat(g.pose9(F.col("pose")), g.pose9(g.inverse(F.col("pose"))), "joints")
    out = rows.select("vec_id", F.posexplode(packed.cast("array<float>")).alias("dim", "x"))
    return out.withColumn("x", r6(F.col("x").cast("double")))


@query(
    "zero_pad_vector",
    """SELECT vec_id, unnest(range(66))::INTEGER AS dim,
    unnest(list_concat(embedding::DOUBLE[], [0.0::DOUBLE, 0.0::DOUBLE])) AS x FROM embeddings""",
)
def zero_pad_vector(spark, sf_dir):
    v = zero_pad(F.col("embedding").cast("array<double>"), 66)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(v).alias("dim", "x"))


# -- scaling of state channels -------------------------------------------------------------


def scaled(spark, sf_dir, stats):
    rows = table(spark, sf_dir, "lineitem").withColumn("_b", bounds_row(stats))
    channels = [
        F.struct(F.lit(i).alias("dim"), F.col(c).alias("x"), F.col("_b")[i]["q01"].alias("q01"),
                 F.col("_b")[i]["q99"].alias("q99"))
        for i, c in enumerate(DIMS)
    ]
    rows = rows.select("l_orderkey", "l_linenumber", "l_partkey", F.inline(F.array(*channels)))
    return rows.withColumn("y", quantile_scale(F.col("x"), F.col("q01"), F.col("q99")))


def fixed_bounds(stats, first: int, last: int, low: float, high: float):
    """Replace the empirical bounds of a range of dimensions by fixed ones; nothing is clipped."""
    inside = F.col("dim").between(first, last)
    return stats.withColumns(
        {
            "q01": F.when(inside, F.lit(low)).otherwise(F.col("q01")),
            "q99": F.when(inside, F.lit(high)).otherwise(F.col("q99")),
        }
    )


_SCALED = [
    LI,
    ST.replace("pos,", "pos, l_linenumber, l_partkey,"),
    BOUNDS_SQL,
    "sc AS (SELECT *, 2 * (x - q01) / (q99 - q01 + 1e-6) - 1 AS y FROM st JOIN bd USING (dim))",
]


@query(
    "quantile_normalize",
    with_sql(
        _SCALED,
        f"""SELECT l_orderkey, l_linenumber, l_partkey, dim, {r6_sql('y')} AS y,
        abs((y + 1) / 2 * (q99 - q01 + 1e-6) + q01 - x) <= 1e-9 AS inverse_ok FROM sc""",
    ),
)
def quantile_normalize(spark, sf_dir):
    rows = scaled(spark, sf_dir, bounds(spark, sf_dir))
    back = quantile_unscale(F.col("y"), F.col("q01"), F.col("q99"))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "dim",
        r6(F.col("y")).alias("y"),
        (F.abs(back - F.col("x")) <= 1e-9).alias("inverse_ok"),
    )


@query(
    "fixed_bounds_override",
    with_sql(
        [
            *_SCALED[:3],
            "fb AS (SELECT dim, CASE WHEN dim >= 2 THEN 0 ELSE q01 END AS q01, CASE WHEN dim >= 2 THEN 100 ELSE q99 END AS q99 FROM bd)",
            "sf AS (SELECT dim, q01, q99, 2 * (x - q01) / (q99 - q01 + 1e-6) - 1 AS y FROM st JOIN fb USING (dim))",
        ],
        f"""SELECT dim, {r6_sql('q01')} AS q01, {r6_sql('q99')} AS q99, {r6_sql('min(y)')} AS low,
        {r6_sql('max(y)')} AS high, count(*) FILTER (WHERE abs(y) > 1) AS outside FROM sf GROUP BY ALL""",
    ),
)
def fixed_bounds_override(spark, sf_dir):
    stats = fixed_bounds(bounds(spark, sf_dir), 2, 3, 0.0, 100.0)
    rows = scaled(spark, sf_dir, stats).groupBy("dim", "q01", "q99").agg(
        r6(F.min("y")).alias("low"),
        r6(F.max("y")).alias("high"),
        F.count_if(F.abs("y") > 1).alias("outside"),
    )
    return rows.withColumns({c: r6(F.col(c)) for c in ("q01", "q99")})


_BIN = "greatest(-1, least(255, floor(y * 128) + 128))::BIGINT"


@query(
    "discretize_state",
    with_sql(_SCALED, f"SELECT l_orderkey, l_linenumber, l_partkey, dim, {_BIN} AS bin FROM sc"),
)
def discretize_state(spark, sf_dir):
    rows = scaled(spark, sf_dir, bounds(spark, sf_dir))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "dim", state_bin(F.col("y")).alias("bin")
    )


@query(
    "state_prompt_text",
    with_sql(
        [
            "b AS (SELECT "
            + ", ".join(
                f"quantile_cont({c}, 0.01) AS a{i}, quantile_cont({c}, 0.99) AS z{i}" for i, c in enumerate(DIMS)
            )
            + " FROM lineitem)",
            "y AS (SELECT *, "
            + ", ".join(
                "greatest(-1, least(255, floor((2 * (" + c + f" - a{i}) / (z{i} - a{i} + 1e-6) - 1) * 128) + 128))::BIGINT AS b{i}"
                for i, c in enumerate(DIMS)
            )
            + " FROM lineitem, b)",
        ],
        """SELECT l_orderkey, l_linenumber, l_partkey,
        concat('Task: ship ', l_returnflag, ', State: ', b0, ' ', b1, ' ', b2, ' ', b3, ';', chr(10), 'Action: ')
        AS prompt FROM y""",
    ),
)
def state_prompt_text(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("b", bounds_row(bounds(spark, sf_dir)))
    bins = [
        state_bin(quantile_scale(F.col(c), F.col("b")[i]["q01"], F.col("b")[i]["q99"]))
        for i, c in enumerate(DIMS)
    ]
    text = F.concat(
        F.lit("Task: ship "),
        "l_returnflag",
        F.lit(", State: "),
        F.concat_ws(" ", *[b.cast("string") for b in bins]),
        F.lit(";\nAction: "),
    )
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", text.alias("prompt"))


# -- the whole episode job -----------------------------------------------------------------

HOW = Sampling(
    stride=2,
    horizon=HORIZON,
    max_alignment=2 * DAY,
    max_hand_age=2 * DAY,
    interval_floor=5 * DAY,
)


def events_with_pose(spark, sf_dir):
    """Events with a planar pose made of their value and counter; the clicks are the frames."""
    turn = F.col("k") * F.lit(math.pi / 200)
    zero = F.lit(0.0)
    flat = [F.col("value") / 100.0, F.col("k") / 100.0, zero]
    pose = g.pack([*flat, zero, zero, F.sin(turn), F.cos(turn)])
    rows = events(spark, sf_dir).withColumn("k", props_k())
    return rows.select(
        "user_id", "event_id", "ts_us", pose.alias("pose"), (F.col("value") >= 2).alias("pose_ok"),
        (F.col("ts_us") + F.col("k") * 1_000_000).alias("frame_us"), "event_type", "value",
    )


def episode_grid(spark, sf_dir, how=HOW, max_rows=None, clock=None, gates=None):
    """(grid rows, facts of each episode)"""
    ev = events_with_pose(spark, sf_dir)
    names = {"cam0": "view", "cam1": "purchase", "left": "error", "right": "signup"}
    cameras = {n: source(ev, names[n]) for n in ("cam0", "cam1")}
    hands = {n: source(ev, names[n]) for n in ("left", "right")}
    tags = {n: F.col("event_type") == k for n, k in {"": "click", **names}.items()}
    return resampled_grid(
        kind(ev, "click").drop("event_type", "value"), cameras, hands, ["user_id"], "ts_us", "event_id",
        "pose_ok", how, max_rows, clock, gates, ev, tags,
    )


_GRID = [
    EV,
    *[kind_sql(k) for k in ("click", "view", "purchase", "error", "signup")],
    *[c for k in ("view", "purchase", "error", "signup") for c in asof_sql(k)],
    f"cd AS (SELECT *, ts_us - lag(ts_us) {W_EV} AS gap FROM click)",
    "md AS (SELECT user_id, round_even(median(gap), 0)::BIGINT AS nominal FROM cd GROUP BY 1)",
    f"""raw AS (SELECT c.user_id, c.event_id, c.ts_us, c.pos, c.value >= 2 AND coalesce(abs(gap - nominal) <=
      greatest({5 * DAY}, round_even(nominal * 0.1::DOUBLE, 0)::BIGINT), true) AS row_ok,
      v.s_pos AS i0, p.s_pos AS i1, v.delta AS d0, p.delta AS d1, e.delta AS dl, s.delta AS dr
      FROM cd c LEFT JOIN md USING (user_id) JOIN near_view v USING (user_id, event_id)
      JOIN near_purchase p USING (user_id, event_id) JOIN near_error e USING (user_id, event_id)
      JOIN near_signup s USING (user_id, event_id))""",
    f"""bad AS (SELECT *, sum(CASE WHEN row_ok THEN 0 ELSE 1 END) {W_EV} AS c FROM raw)""",
    f"""gr AS (SELECT *, pos // 2 AS grid_index, coalesce(c = lag(c) {W_EV} AND i0 > lag(i0) {W_EV}
      AND i1 > lag(i1) {W_EV}, lag(c) {W_EV} IS NULL) AS transition_valid,
      coalesce(abs(d0) <= {2 * DAY} AND abs(d1) <= {2 * DAY} AND abs(dl) <= {2 * DAY}
      AND abs(dr) <= {2 * DAY}, false) AS sample_valid FROM bad WHERE pos % 2 = 0)""",
    f"""rs AS (SELECT *, sample_valid AND (NOT coalesce(lag(sample_valid) {W_EV}, false)
      OR NOT transition_valid) AS st FROM gr)""",
    f"""rn AS (SELECT *, CASE WHEN sample_valid THEN sum(CASE WHEN st THEN 1 ELSE 0 END) {W_EV} - 1
      ELSE -1 END::BIGINT AS run, count(*) OVER (PARTITION BY user_id) AS n FROM rs)""",
]


@query(
    "resampled_episode",
    with_sql(
        _GRID,
        f"""SELECT user_id, event_id, pos AS source_row, grid_index, i0 AS cam0_index, d0 AS cam0_delta,
        i1 AS cam1_index, d1 AS cam1_delta, dl AS left_delta, dr AS right_delta, sample_valid,
        transition_valid, sample_valid AND transition_valid AS alignment_valid, run,
        least({HORIZON}, n - 1 - grid_index)::INTEGER AS real_slots,
        grid_index + {HORIZON} < n AS full_horizon FROM rn""",
    ),
)
def resampled_episode(spark, sf_dir):
    joints = F.array(F.col("left.value"), F.col("right.value"))
    s = training_samples(episode_grid(spark, sf_dir)[0], "pose", joints, HOW)
    return s.frame().select(
        "user_id", "event_id", "source_row", "grid_index", "cam0_index", "cam0_delta", "cam1_index",
        "cam1_delta", "left_delta", "right_delta", "sample_valid", "transition_valid",
        "alignment_valid", "run", "real_slots", "full_horizon",
    )


STRICT = Sampling(**{**HOW.__dict__, "strict": True})
_STRICT = [
    *_GRID,
    "rr AS (SELECT user_id, run, count(*) AS c FROM rn WHERE run >= 0 GROUP BY ALL)",
    """ch AS (SELECT user_id, min(run) FILTER (WHERE c >= 2) AS run FROM rr GROUP BY 1
      HAVING count(*) FILTER (WHERE c >= 2) = 1)""",
    f"sr AS (SELECT rn.*, row_number() {W_EV} - 1 AS sample_pos FROM rn JOIN ch USING (user_id, run))",
]


@query(
    "resampled_episode_strict",
    with_sql(
        _STRICT,
        "SELECT user_id, event_id, source_row, grid_index, run, sample_pos FROM "
        "(SELECT *, pos AS source_row FROM sr) WHERE sample_pos >= 1",
    ),
)
def resampled_episode_strict(spark, sf_dir):
    joints = F.array(F.col("left.value"), F.col("right.value"))
    s = training_samples(episode_grid(spark, sf_dir, STRICT)[0], "pose", joints, STRICT)
    return s.frame().select("user_id", "event_id", "source_row", "grid_index", "run", "sample_pos")


# -- rates of their own, two clocks, rejects -------------------------------------------------

PER = 6 * DAY
RATED = Sampling(
    **{**HOW.__dict__, "output_rate": 2, "per_second": PER, "ratio_tolerance": 0.3, "interval_floor": 2 * DAY}
)


def gates_of(spark, sf_dir):
    """Episodes with a value above 480 stand for those with a bad report."""
    rows = events(spark, sf_dir).groupBy("user_id").agg(F.max("value").alias("v")).filter("v > 480")
    return rows.select("user_id", F.lit("status_not_ok").alias("category"), F.lit("report").alias("message"))


def rated_grid(spark, sf_dir):
    return episode_grid(spark, sf_dir, RATED, clock="frame_us", gates=gates_of(spark, sf_dir))


_CK = "(props->>'$.k')::BIGINT"
_RATES = [
    EV,
    *[kind_sql(k) for k in ("click", "view", "purchase", "error", "signup")],
    *[c for k in ("view", "purchase", "error", "signup") for c in asof_sql(k)],
    f"fc AS (SELECT *, {_CK} AS k, ts_us + {_CK} * 1000000 AS frame_us FROM click)",
    f"cd AS (SELECT *, frame_us - lag(frame_us) {W_EV} AS gap FROM fc)",
    f"ms AS (SELECT user_id, {PER}.0::DOUBLE / nullif(median(gap), 0) AS rate, count(*) AS rows FROM cd GROUP BY 1)",
    *[
        f"""f_{k} AS (SELECT user_id, (count(*) - 1) * {PER}.0::DOUBLE / nullif(max(ts_us) - min(ts_us), 0) AS fps
          FROM {k} GROUP BY 1)"""
        for k in ("view", "purchase")
    ],
    "gt AS (SELECT user_id FROM ev GROUP BY 1 HAVING max(value) > 480)",
    """r0 AS (SELECT ms.*, round_even(rate, 0)::BIGINT AS source_rate, (a.fps / 2 + b.fps / 2) / rate AS ratio,
      gt.user_id IS NOT NULL AS gated FROM ms LEFT JOIN f_view a USING (user_id)
      LEFT JOIN f_purchase b USING (user_id) LEFT JOIN gt USING (user_id))""",
    """rt AS (SELECT *, CASE WHEN gated THEN 'status_not_ok'
      WHEN NOT coalesce(abs(rate - source_rate) <= 0.25 AND source_rate > 0 AND source_rate % 2 = 0, false)
      THEN 'unsupported_rate' WHEN NOT coalesce(round_even(ratio, 0) > 0 AND abs(ratio - round_even(ratio, 0)) <= 0.3, false)
      THEN 'camera_ratio' END AS category FROM r0)""",
]


@query(
    "episode_rejects",
    with_sql(
        _RATES,
        f"""SELECT user_id, rows, source_rate, source_rate // 2 AS stride, category,
        round_even({PER}.0::DOUBLE / nullif(source_rate, 0), 0)::BIGINT AS nominal FROM rt""",
    ),
)
def episode_rejects(spark, sf_dir):
    """Rate, stride and reject category of every episode."""
    facts = rated_grid(spark, sf_dir)[1]
    return facts.select("user_id", "rows", "source_rate", "stride", "category", "nominal")


_RATED = [
    *_RATES,
    f"""raw AS (SELECT c.user_id, c.event_id, c.ts_us, c.pos, c.k, c.value AS cv, rt.source_rate // 2 AS stride,
      c.value >= 2 AND coalesce(abs(gap - nominal) <= greatest({2 * DAY}, round_even(nominal * 0.1::DOUBLE, 0)::BIGINT),
      true) AS row_ok, v.s_pos AS i0, p.s_pos AS i1, v.delta AS d0, p.delta AS d1, e.delta AS dl, s.delta AS dr,
      e.s_value AS lj, s.s_value AS rj
      FROM cd c JOIN (SELECT *, round_even({PER}.0::DOUBLE / source_rate, 0)::BIGINT AS nominal FROM rt
        WHERE category IS NULL) rt USING (user_id) JOIN near_view v USING (user_id, event_id)
      JOIN near_purchase p USING (user_id, event_id) JOIN near_error e USING (user_id, event_id)
      JOIN near_signup s USING (user_id, event_id))""",
    f"bad AS (SELECT *, sum(CASE WHEN row_ok THEN 0 ELSE 1 END) {W_EV} AS c FROM raw)",
    f"""gr AS (SELECT *, pos // stride AS grid_index, coalesce(c = lag(c) {W_EV} AND i0 > lag(i0) {W_EV}
      AND i1 > lag(i1) {W_EV}, lag(c) {W_EV} IS NULL) AS transition_valid,
      coalesce(abs(d0) <= {2 * DAY} AND abs(d1) <= {2 * DAY} AND abs(dl) <= {2 * DAY}
      AND abs(dr) <= {2 * DAY}, false) AS sample_valid, cv / 100.0::DOUBLE AS px, k / 100.0::DOUBLE AS py,
      2 * k * pi() / 200 AS yaw, count(*) OVER (PARTITION BY user_id) AS n FROM bad WHERE pos % stride = 0)""",
]
_VECTORS = f"""ks AS (SELECT unnest(range(0, {HORIZON + 1})) AS slot),
ends AS (SELECT a.user_id, a.event_id, slot, slot > 0 AND a.grid_index + slot >= a.n AS padded,
  CASE WHEN slot = 0 THEN greatest(a.grid_index - 1, 0) ELSE a.grid_index END AS g0,
  CASE WHEN slot = 0 THEN a.grid_index ELSE least(a.grid_index + slot, a.n - 1) END AS g1 FROM gr a, ks),
mv AS (SELECT e.user_id, e.event_id, slot, padded, cos(x.yaw) AS c0, sin(x.yaw) AS s0, y.px - x.px AS dx,
  y.py - x.py AS dy, y.yaw - x.yaw AS turn, y.lj, y.rj
  FROM ends e JOIN gr x ON x.user_id = e.user_id AND x.grid_index = e.g0
  JOIN gr y ON y.user_id = e.user_id AND y.grid_index = e.g1),
vec AS (SELECT user_id, event_id, slot::INTEGER AS slot, padded, [c0 * dx + s0 * dy, c0 * dy - s0 * dx, 0, cos(turn), sin(turn), 0,
  -sin(turn), cos(turn), 0, lj, rj] AS v FROM mv)"""


@query(
    "episode_vectors",
    with_sql(
        [*_RATED, _VECTORS],
        """SELECT user_id, event_id, slot, padded, (dim - 1)::INTEGER AS dim, round(v[dim]::FLOAT::DOUBLE, 3) + 0.0 AS x
        FROM vec, (SELECT unnest(range(1, 12)) AS dim)""",
    ),
)
def episode_vectors(spark, sf_dir):
    """State (slot 0) and action chunk (slots 1 up) of every grid row, unfolded."""
    joints = F.array(F.col("left.value"), F.col("right.value"))
    rows = training_samples(rated_grid(spark, sf_dir)[0], "pose", joints, RATED).frame()
    whole = F.concat(F.array(F.struct(F.col("state").alias("v"), F.lit(False).alias("padded"))),
                     F.arrays_zip(F.col("action").alias("v"), F.col("is_pad").alias("padded")))
    rows = rows.select("user_id", "event_id", F.posexplode(whole).alias("slot", "e"))
    rows = rows.select("user_id", "event_id", "slot", "e.padded", F.posexplode("e.v").alias("dim", "x"))
    return rows.withColumn("x", F.round(F.col("x").cast("double"), 3) + 0.0)


@query(
    "preflight_report",
    with_sql(
        [*_RATED, f"ep AS (SELECT user_id, count(*) FILTER (WHERE grid_index + {HORIZON} < n) AS f FROM gr GROUP BY 1)"],
        f"""SELECT (SELECT count(*) FROM rt) AS episodes, (SELECT count(*) FROM rt WHERE category IS NULL) AS accepted,
        (SELECT count(*) FROM rt WHERE category = 'status_not_ok') AS status_not_ok,
        (SELECT count(*) FROM rt WHERE category = 'unsupported_rate') AS unsupported_rate,
        (SELECT count(*) FROM rt WHERE category = 'camera_ratio') AS camera_ratio,
        (SELECT sum(rows)::BIGINT FROM rt WHERE category IS NULL) AS source_rows, count(*) AS grid_rows,
        count(*) FILTER (WHERE sample_valid AND transition_valid) AS aligned_rows,
        max(abs(d0)) AS max_cam0, max(abs(d1)) AS max_cam1,
        max(abs(dl)) FILTER (WHERE abs(dl) <= {2 * DAY}) AS max_left,
        max(abs(dr)) FILTER (WHERE abs(dr) <= {2 * DAY}) AS max_right,
        count(*) FILTER (WHERE grid_index + {HORIZON} < n) AS full_horizon_rows,
        sum(greatest(0, grid_index + {HORIZON} - n + 1))::BIGINT AS padded_slots,
        (SELECT count(*) FROM ep WHERE f = 0) AS episodes_without_full_row FROM gr""",
    ),
)
def preflight_report(spark, sf_dir):
    """Rejects by category, maxima over grid rows (cameras) and fresh rows (hands), padding."""
    s, facts = rated_grid(spark, sf_dir)
    return preflight(s.settled().frame(), facts, "grid_index", RATE_REJECTS)


RATE_REJECTS = ("status_not_ok", "unsupported_rate", "camera_ratio")
RUN_REJECTS = ("no_valid_run", "all_singletons", "multiple_valid_runs")


def preflight(rows, facts, pos, names):
    """One row about the samples ``rows`` (settled; ``pos`` is dense in an episode) and ``facts``."""
    last = F.max(pos).alias("_last")
    rows = rows.join(rows.groupBy("user_id").agg(last), "user_id")
    ahead = F.least(F.lit(HORIZON), F.col("_last") - F.col(pos))
    full = F.col(pos) + HORIZON <= F.col("_last")

    def hand(n):
        delta = F.abs(f"{n}_delta")
        return F.max(F.when(delta <= RATED.max_hand_age, delta))

    grid = rows.agg(
        F.count(F.lit(1)).alias("grid_rows"),
        F.count_if(F.col("sample_valid") & F.col("transition_valid")).alias("aligned_rows"),
        *[F.max(F.abs(f"{n}_delta")).alias(f"max_{n}") for n in ("cam0", "cam1")],
        *[hand(n).alias(f"max_{n}") for n in ("left", "right")],
        F.count_if(full).alias("full_horizon_rows"),
        F.sum(HORIZON - ahead).alias("padded_slots"),
    )
    short = rows.groupBy("user_id").agg(F.count_if(full).alias("f")).agg(F.count_if(F.col("f") == 0)).scalar()
    category = F.col("category")
    totals = facts.agg(
        F.count(F.lit(1)).alias("episodes"),
        F.count_if(category.isNull()).alias("accepted"),
        *[F.count_if(F.coalesce(category == n, F.lit(False))).alias(n) for n in names],
        F.sum(F.when(category.isNull(), F.col("rows"))).alias("source_rows"),
    )
    out = totals.withColumns({"_g": grid.select(F.struct("*")).scalar(), "episodes_without_full_row": short})
    return out.select(*totals.columns, "_g.*", "episodes_without_full_row")


# -- strict mode: episodes of one run ----------------------------------------------------------

_RUNS = [
    *_RATED,
    f"""rs AS (SELECT *, sample_valid AND (NOT coalesce(lag(sample_valid) {W_EV}, false)
      OR NOT transition_valid) AS st FROM gr)""",
    f"rn AS (SELECT * EXCLUDE n, CASE WHEN sample_valid THEN sum(st::INTEGER) {W_EV} - 1 END AS run FROM rs)",
    "rr AS (SELECT user_id, run, count(*) AS c FROM rn WHERE run IS NOT NULL GROUP BY ALL)",
    """ch AS (SELECT user_id, count(*) AS runs, count(*) FILTER (WHERE c >= 2) AS big,
      min(run) FILTER (WHERE c >= 2) AS run FROM rr GROUP BY 1)""",
    """ft AS (SELECT rt.* EXCLUDE category, coalesce(category, CASE WHEN runs IS NULL THEN 'no_valid_run' WHEN big = 0
      THEN 'all_singletons' WHEN big > 1 THEN 'multiple_valid_runs' END) AS category, coalesce(runs, 0) AS runs,
      coalesce(big, 0) AS big, category IS NULL AS planned FROM rt LEFT JOIN ch USING (user_id))""",
]
RATED_STRICT = Sampling(**{**RATED.__dict__, "strict": True})


def strict_grid(spark, sf_dir):
    """(settled grid rows, chosen runs, facts with all rejects)"""
    grid = episode_grid(spark, sf_dir, RATED_STRICT, clock="frame_us", gates=gates_of(spark, sf_dir))
    return strict_choice(*grid)


@query(
    "episode_rejects_strict",
    with_sql(
        _RUNS,
        """SELECT user_id, rows, source_rate, category, CASE WHEN planned AND category IS NOT NULL
        THEN concat(runs, ' valid runs, ', big, ' of two or more samples') END AS message FROM ft""",
    ),
)
def episode_rejects_strict(spark, sf_dir):
    """Every episode with its rate and the reason why strict mode refuses it, found early or late."""
    facts = strict_grid(spark, sf_dir)[2]
    late = F.col("category").isin(*RUN_REJECTS)
    return facts.select("user_id", "rows", "source_rate", "category", F.when(late, F.col("message")).alias("message"))


@query(
    "preflight_strict",
    with_sql(
        [
            *_RUNS,
            f"""ss AS (SELECT rn.*, row_number() {W_EV} - 1 AS sp FROM rn JOIN ch USING (user_id, run) WHERE big = 1)""",
            "em AS (SELECT *, max(sp) OVER (PARTITION BY user_id) AS last FROM ss)",
            f"ep AS (SELECT user_id, count(*) FILTER (WHERE sp + {HORIZON} <= last) AS f FROM em GROUP BY 1)",
        ],
        "SELECT (SELECT count(*) FROM ft) AS episodes, (SELECT count(*) FROM ft WHERE category IS NULL) AS accepted, "
        + " ".join(f"(SELECT count(*) FROM ft WHERE category = '{n}') AS {n}," for n in (*RATE_REJECTS, *RUN_REJECTS))
        + f"""(SELECT sum(rows)::BIGINT FROM ft WHERE category IS NULL) AS source_rows, count(*) AS grid_rows,
        count(*) FILTER (WHERE sample_valid AND transition_valid) AS aligned_rows,
        max(abs(d0)) AS max_cam0, max(abs(d1)) AS max_cam1,
        max(abs(dl)) FILTER (WHERE abs(dl) <= {2 * DAY}) AS max_left,
        max(abs(dr)) FILTER (WHERE abs(dr) <= {2 * DAY}) AS max_right,
        count(*) FILTER (WHERE sp + {HORIZON} <= last) AS full_horizon_rows,
        sum({HORIZON} - least({HORIZON}, last - sp))::BIGINT AS padded_slots,
        (SELECT count(*) FROM ep WHERE f = 0) AS episodes_without_full_row FROM em""",
    ),
)
def preflight_strict(spark, sf_dir):
    """The report in strict mode: rejects found before and after the runs were known."""
    s, chosen, facts = strict_grid(spark, sf_dir)
    rows = emitted_rows(s, RATED_STRICT, chosen).settled().frame()
    return preflight(rows, settle(facts), "sample_pos", (*RATE_REJECTS, *RUN_REJECTS))
