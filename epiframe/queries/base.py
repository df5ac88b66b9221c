"""Registry, and the driver tables read as recordings.

* ``events``: an episode per user; ``click`` is the master grid, ``view`` and ``purchase``
  are two cameras, ``error`` and ``signup`` are the left and right packet logs.
* ``lineitem``: an episode per order; the frame order is a full tie-break.
* ``embeddings``: an episode per label; elements 1-3 are a translation and 4-7 a quaternion.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.functions import geometry as g
from epiframe.functions.values import micros
from epiframe.operators.align import Stream
from epiframe.plans.series import Series

QUERIES: dict = {}
SQL: dict = {}

TOLERANCE = 6 * 3600 * 1_000_000
HORIZON = 3
LI_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts_us", micros(F.col("ts"))).drop("ts")


def kind(ev: DataFrame, name: str) -> DataFrame:
    return ev.filter(F.col("event_type") == name)


def source(ev: DataFrame, name: str) -> Stream:
    return Stream(kind(ev, name), "ts_us", ["event_id", "value"])


def user_series(df: DataFrame, *cols: str) -> Series:
    return Series.plan(
        df.select("user_id", "ts_us", "event_id", *cols), ["user_id"], ["ts_us", "event_id"]
    )


def order_frames(spark, sf_dir, *cols: str) -> Series:
    """Line items as numbered frames of their order."""
    wanted = ["l_orderkey", *LI_ORDER, *[c for c in cols if c not in LI_ORDER]]
    rows = table(spark, sf_dir, "lineitem").select(*wanted)
    return Series.plan(rows, ["l_orderkey"], LI_ORDER).number("pos")


def pose_rows(spark, sf_dir) -> DataFrame:
    """Embeddings as poses, unit quaternion in XYZW order."""
    e = [F.get("embedding", F.lit(i)).cast("double") for i in range(7)]
    rows = table(spark, sf_dir, "embeddings").select("label", "vec_id", "embedding")
    return g.with_pose(rows, "pose", e[:3] + g.unit(e[3:])).drop("embedding")


def pose_series(spark, sf_dir) -> Series:
    return Series.plan(pose_rows(spark, sf_dir), ["label"], ["vec_id"])


def with_sql(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


EV = (
    "ev AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS ts_us, value, props FROM events)"
)


def kind_sql(name: str) -> str:
    return (
        f"{name} AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_us, event_id)"
        f" - 1 AS pos FROM ev WHERE event_type = '{name}')"
    )


def asof_sql(name: str, grid: str = "click") -> list[str]:
    """CTEs b_<name> (last at or before), a_<name> (first after) and near_<name>."""
    back = f"""b_{name} AS (SELECT q.event_id, q.user_id, q.ts_us, s.ts_us AS s_ts,
      s.event_id AS s_id, s.pos AS s_pos, s.value AS s_value
      FROM {grid} q ASOF LEFT JOIN {name} s ON q.user_id = s.user_id AND q.ts_us >= s.ts_us)"""
    ahead = f"""a_{name} AS (SELECT q.event_id, q.user_id, q.ts_us, s.ts_us AS s_ts,
      s.event_id AS s_id, s.pos AS s_pos, s.value AS s_value
      FROM {grid} q ASOF LEFT JOIN {name} s ON q.user_id = s.user_id AND q.ts_us < s.ts_us)"""
    back_wins = (
        "(b.s_ts IS NOT NULL AND (a.s_ts IS NULL OR b.ts_us - b.s_ts <= a.s_ts - b.ts_us))"
    )
    near = f"""near_{name} AS (SELECT b.event_id, b.user_id, b.ts_us,
      CASE WHEN {back_wins} THEN b.s_id ELSE a.s_id END AS s_id,
      CASE WHEN {back_wins} THEN b.s_value ELSE a.s_value END AS s_value,
      CASE WHEN {back_wins} THEN b.s_pos ELSE a.s_pos END AS s_pos,
      CASE WHEN {back_wins} THEN b.s_ts ELSE a.s_ts END - b.ts_us AS delta
      FROM b_{name} b JOIN a_{name} a ON a.event_id = b.event_id)"""
    return [back, ahead, near]


LI = f"""li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LI_ORDER)})
  - 1 AS pos, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)"""

EM = """em0 AS (SELECT label, vec_id,
  embedding[1]::DOUBLE AS px, embedding[2]::DOUBLE AS py, embedding[3]::DOUBLE AS pz,
  embedding[4]::DOUBLE AS ax, embedding[5]::DOUBLE AS ay, embedding[6]::DOUBLE AS az,
  embedding[7]::DOUBLE AS aw FROM embeddings),
em1 AS (SELECT *, sqrt(ax*ax + ay*ay + az*az + aw*aw) AS an FROM em0),
em2 AS (SELECT label, vec_id, px, py, pz, ax/an AS qx, ay/an AS qy, az/an AS qz, aw/an AS qw FROM em1),
em AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos,
  1 - 2*(qy*qy + qz*qz) AS r00, 2*(qx*qy - qz*qw) AS r01, 2*(qx*qz + qy*qw) AS r02,
  2*(qx*qy + qz*qw) AS r10, 1 - 2*(qx*qx + qz*qz) AS r11, 2*(qy*qz - qx*qw) AS r12,
  2*(qx*qz - qy*qw) AS r20, 2*(qy*qz + qx*qw) AS r21, 1 - 2*(qx*qx + qy*qy) AS r22 FROM em2)"""


def r6_sql(expr: str) -> str:
    return f"round({expr}, 6) + 0.0"
