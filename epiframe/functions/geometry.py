"""Rigid transforms as column arithmetic.

A pose column is a struct of seven doubles: position ``px py pz`` and unit quaternion
``qx qy qz qw``. Functions take pose columns or lists of the seven columns, and return
lists, which ``pack`` or ``with_pose`` turn into a pose column. Everything is plain
arithmetic, so it stays in generated code.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("px", "py", "pz", "qx", "qy", "qz", "qw")
POSE_TYPE = "struct<" + ",".join(f"{f}:double" for f in FIELDS) + ">"


def pack(values) -> Column:
    """Pose column of seven columns."""
    return F.struct(*[c.alias(f) for c, f in zip(values, FIELDS)])


def with_pose(df: DataFrame, name: str, values) -> DataFrame:
    """Add a pose column computed once per row.

    The seven numbers are first projected as plain columns. Catalyst keeps that projection
    apart, where it would inline a struct into every later use of one of its fields.
    """
    parts = {f"_{name}_{f}": c for f, c in zip(FIELDS, values)}
    return df.withColumns(parts).withColumn(name, pack([F.col(c) for c in parts])).drop(*parts)


def constant(values) -> list[Column]:
    return [F.lit(float(x)) for x in values]


def identity() -> list[Column]:
    return constant((0, 0, 0, 0, 0, 0, 1))


def choose(condition: Column, a, b) -> list[Column]:
    return [F.when(condition, x).otherwise(y) for x, y in zip(a, b)]


def position(p) -> list[Column]:
    return p[:3] if isinstance(p, list) else [p[f] for f in FIELDS[:3]]


def rotation(p) -> list[Column]:
    return p[3:] if isinstance(p, list) else [p[f] for f in FIELDS[3:]]


# -- quaternions (x, y, z, w) -----------------------------------------------------------


def norm(v) -> Column:
    return F.sqrt(sum((x * x for x in v[1:]), v[0] * v[0]))


def unit(v) -> list[Column]:
    n = norm(v)
    return [x / n for x in v]


def normalise(q, smallest: float, largest_error: float | None = None) -> list[Column]:
    """Unit quaternion, null where the norm is too small or too far from one."""
    n = norm(q)
    ok = n >= smallest
    if largest_error is not None:
        ok = ok & (F.abs(n - 1.0) <= largest_error)
    return [F.when(ok, x / n) for x in q]


def conjugate(q):
    return [-q[0], -q[1], -q[2], q[3]]


def multiply(a, b):
    ax, ay, az, aw = a
    bx, by, bz, bw = b
    return [
        aw * bx + ax * bw + ay * bz - az * by,
        aw * by + ay * bw + az * bx - ax * bz,
        aw * bz + az * bw + ax * by - ay * bx,
        aw * bw - ax * bx - ay * by - az * bz,
    ]


def cross(a, b):
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def dot(a, b) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def rotate(q, v):
    """Vector turned by a unit quaternion."""
    t = [x * 2.0 for x in cross(q[:3], v)]
    u = cross(q[:3], t)
    return [v[i] + q[3] * t[i] + u[i] for i in range(3)]


def matrix(q) -> list[list[Column]]:
    x, y, z, w = q
    one, two = F.lit(1.0), F.lit(2.0)
    return [
        [one - two * (y * y + z * z), two * (x * y - z * w), two * (x * z + y * w)],
        [two * (x * y + z * w), one - two * (x * x + z * z), two * (y * z - x * w)],
        [two * (x * z - y * w), two * (y * z + x * w), one - two * (x * x + y * y)],
    ]


def canonical(q) -> list[Column]:
    """The representative with w >= 0."""
    return [F.when(q[3] < 0, -x).otherwise(x) for x in q]


def from_matrix(m) -> list[Column]:
    """Unit quaternion with w >= 0 of a rotation matrix.

    The largest of the four squared components is found from the diagonal, and the others
    follow from sums and differences of the off-diagonal pairs.
    """
    a, b, c = m[0][0], m[1][1], m[2][2]
    yz, zx, xy = m[2][1] - m[1][2], m[0][2] - m[2][0], m[1][0] - m[0][1]
    sxy, sxz, syz = m[0][1] + m[1][0], m[0][2] + m[2][0], m[1][2] + m[2][1]
    four = {
        "w": F.lit(1.0) + a + b + c,
        "x": F.lit(1.0) + a - b - c,
        "y": F.lit(1.0) - a + b - c,
        "z": F.lit(1.0) - a - b + c,
    }
    rows = {
        "w": [yz, zx, xy, four["w"]],
        "x": [four["x"], sxy, sxz, yz],
        "y": [sxy, four["y"], syz, zx],
        "z": [sxz, syz, four["z"], xy],
    }
    use_w = a + b + c > 0
    use_x = (a >= b) & (a >= c)
    use_y = b >= c
    out = []
    for i in range(4):

        def part(k):
            return rows[k][i] / (F.sqrt(four[k]) * 2.0)

        out.append(
            F.when(use_w, part("w")).when(use_x, part("x")).when(use_y, part("y")).otherwise(part("z"))
        )
    return canonical(out)


def rotation_error(m) -> Column:
    """Largest entry of R'R - I, and of det R - 1."""
    errors = []
    cols = [[m[r][c] for r in range(3)] for c in range(3)]
    for i in range(3):
        for j in range(i, 3):
            errors.append(F.abs(dot(cols[i], cols[j]) - (1.0 if i == j else 0.0)))
    errors.append(F.abs(dot(cols[0], cross(cols[1], cols[2])) - 1.0))
    return F.greatest(*errors)


def angle_deg(q) -> Column:
    return F.degrees(F.lit(2.0) * F.acos(F.least(F.lit(1.0), F.abs(q[3]))))


def angle_between_deg(a, b) -> Column:
    d = sum((x * y for x, y in zip(a[1:], b[1:])), a[0] * b[0])
    return F.degrees(F.lit(2.0) * F.acos(F.least(F.lit(1.0), F.abs(d))))


# -- poses ------------------------------------------------------------------------------


def compose(a, b) -> list[Column]:
    moved = rotate(rotation(a), position(b))
    return [x + y for x, y in zip(position(a), moved)] + multiply(rotation(a), rotation(b))


def inverse(a) -> list[Column]:
    back = conjugate(rotation(a))
    return [-x for x in rotate(back, position(a))] + back


def relative(a, b) -> list[Column]:
    """inverse(a) times b."""
    back = conjugate(rotation(a))
    step = [y - x for x, y in zip(position(a), position(b))]
    return rotate(back, step) + multiply(back, rotation(b))


def spatial_delta(a, b) -> list[Column]:
    """Base-frame difference: position difference and R_b R_a'."""
    step = [y - x for x, y in zip(position(a), position(b))]
    return step + multiply(rotation(b), conjugate(rotation(a)))


def pose9(a) -> Column:
    """Translation and the first two rotation columns."""
    m = matrix(rotation(a))
    return F.array(*position(a), *[m[r][0] for r in range(3)], *[m[r][1] for r in range(3)])


def scale(a, translation: float, rotation_scale: float) -> list[Column]:
    """Translation times a factor, rotation vector times a factor."""
    q = canonical(rotation(a))
    s = norm(q[:3])
    half = F.atan2(s, q[3]) * rotation_scale
    gain = F.when(s < 1e-12, F.lit(float(rotation_scale))).otherwise(F.sin(half) / s)
    return [x * translation for x in position(a)] + [x * gain for x in q[:3]] + [F.cos(half)]


def conjugated(df: DataFrame, name: str, a, x) -> DataFrame:
    """Add inverse(x) a x: the same motion seen from a frame moved by x."""
    df = with_pose(df, name, relative(x, a))
    return with_pose(df, name, compose(F.col(name), x))


def basis_change(a) -> list[Column]:
    """Pose in axes (-z, -x, y): v' = A v and R' = A R A'."""
    px, py, pz = position(a)
    qx, qy, qz, qw = rotation(a)
    return [-pz, -px, py, -qz, -qx, qy, qw]


def three_point_frame(origin, front, up):
    """Axes x = O to F, y = unit((U - O) x x), z = x x y; null where collinear."""
    fo = [f - o for f, o in zip(front, origin)]
    uo = [u - o for u, o in zip(up, origin)]
    x = unit(fo)
    side = cross(uo, x)
    n = norm(side)
    ok = n > F.lit(1e-9) * norm(uo)
    y = [F.when(ok, s / n) for s in side]
    z = cross(x, y)
    return [[F.when(ok, c) for c in x], y, z]
