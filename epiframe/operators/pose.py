"""Pose streams: chained deltas, relative deltas, future chunks and trajectory checks."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from epiframe.functions import geometry as g
from epiframe.operators.sequence import segment_ids
from epiframe.plans.series import Series
from epiframe.plans.shared import settle

BLOCK_ROWS = 128


def prefix_products(
    df: DataFrame, group: list[str], idx: str, pose: str, longest: int | None = None
) -> DataFrame:
    """Replace each pose by the product of all poses of its group up to it.

    ``idx`` is the dense position in the group. Composition is associative, so groups are
    cut into blocks of 128 rows. Inside a block, seven shifted compositions build all
    prefixes; they share one ordering. Block totals are scanned the same way one level up,
    128 times fewer rows each time, and joined back on the block, which is how the rows
    are already partitioned. A long group is thus spread over many tasks.
    """
    if longest is None:
        longest = (df.agg(F.max(idx)).first()[0] or 0) + 1
    df = df.withColumn("_b", F.floor(F.col(idx) / BLOCK_ROWS))
    w = W.partitionBy(*group, "_b").orderBy(idx)
    step = 1
    while step < min(BLOCK_ROWS, longest):
        df = df.withColumn("_lag", F.lag(pose, step).over(w))
        joined = g.pack(g.compose(F.col("_lag"), F.col(pose)))
        df = df.withColumn(pose, F.when(F.col("_lag").isNull(), F.col(pose)).otherwise(joined))
        step *= 2
    df = df.drop("_lag")
    if longest <= BLOCK_ROWS:
        return df.drop("_b")
    totals = df.filter(F.col(idx) % BLOCK_ROWS == BLOCK_ROWS - 1).select(
        *group, F.col("_b").alias(idx), F.col(pose)
    )
    above = -(-longest // BLOCK_ROWS)
    if above > BLOCK_ROWS:
        totals = settle(totals)  # 1/128 of the rows, so that no level repeats the one below
    totals = prefix_products(totals, group, idx, pose, above)
    before = totals.select(
        *group, (F.col(idx) + 1).alias("_b"), F.col(pose).alias("_before")
    )
    whole = g.compose(F.col("_before"), F.col(pose))
    whole = g.pack(g.position(whole) + g.unit(g.rotation(whole)))
    return (
        df.join(before, [*group, "_b"], "left")
        .withColumn(pose, F.when(F.col("_before").isNull(), F.col(pose)).otherwise(whole))
        .drop("_before", "_b")
    )


def cumulative_pose(
    s: Series, delta: str, valid: Column, declared_previous: Column, frame: str
) -> DataFrame:
    """Absolute poses from adjacent deltas: identity at the start of each segment."""
    s = segment_ids(s.number("_pos"), valid, declared_previous, frame)
    s = s.scan(held={"_start": F.when(~F.col("linked"), F.col("_pos"))})
    s = s.with_columns(
        {
            "_i": F.col("_pos") - F.col("_start"),
            "pose": F.when(F.col("linked"), F.col(delta)).otherwise(g.pack(g.identity())),
        }
    ).map(lambda d: d.drop("_pos", "_start"))
    # the longest segment is asked for first, so the numbered rows are read twice
    return prefix_products(s.settled().frame(), [*s.keys, "segment"], "_i", "pose").drop("_i")


def integrate_hold(s: Series, delta: Column, valid: Column) -> DataFrame:
    """Target trajectory from deltas; an invalid delta keeps the last pose."""
    s = s.number("_i").with_columns({"pose": F.when(valid, delta).otherwise(g.pack(g.identity()))})
    return prefix_products(s.settled().frame(), s.keys, "_i", "pose").drop("_i")


def relative_deltas(s: Series, pose: str, valid: str, frame: str, ts: str, step: int = 1,
                    max_dt: int | None = None) -> Series:
    """Delta to the previous row; identity and invalid where either end or the link is bad."""
    s = s.shift(
        {"_pp": F.col(pose), "_pv": F.col(valid), "previous_frame": F.col(frame), "_pt": F.col(ts)}
    )
    link = F.col("_pt").isNotNull()
    if step:
        link = link & (F.col(frame) - F.col("previous_frame") == step)
    s = s.with_columns({"dt": F.col(ts) - F.col("_pt")})
    if max_dt is not None:
        link = link & (F.col("dt") <= max_dt)
    ok = F.coalesce(link & F.col(valid) & F.col("_pv"), F.lit(False))
    s = s.with_columns({"delta_valid": ok})
    step = g.relative(F.col("_pp"), F.col(pose))
    delta = g.choose(F.col("delta_valid"), step, g.identity())
    return s.map(lambda d: g.with_pose(d, "delta", delta))


def state_delta(s: Series, pose: str, strict: bool = False) -> Series:
    """Motion from the previous row; the first row is identity, or dropped if strict."""
    s = s.shift({"_pp": F.col(pose)})
    step = g.relative(F.col("_pp"), F.col(pose))
    state = g.choose(F.col("_pp").isNull(), g.identity(), step)
    s = s.map(lambda d: g.with_pose(d, "state", state))
    if strict:
        s = s.filter(F.col("_pp").isNotNull())
    return s.map(lambda d: d.drop("_pp"))


def future_chunk(s: Series, value: Column, horizon: int, pos: str, strict: bool = False) -> Series:
    """Next ``horizon`` values of each row, the last one repeated in slots marked as padding.

    Adds ``chunk``, ``is_pad`` and ``real_slots``. Strict drops the first row as an anchor.
    """
    if not 1 <= horizon <= 1024:
        raise ValueError("horizon must be in 1..1024")
    s = s.with_columns({"_own": value}).future("_next", F.col("_own"), horizon, pos)
    seen = F.size("_next")
    last = F.when(seen > 0, F.get("_next", seen - 1)).otherwise(F.col("_own"))
    s = s.with_columns(
        {
            "chunk": F.concat("_next", F.array_repeat(last, F.lit(horizon) - seen)),
            "is_pad": F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda k: k > seen),
            "real_slots": seen,
        }
    )
    if strict:
        s = s.filter(F.col(pos) >= 1)
    return s.map(lambda d: d.drop("_own", "_next"))


def slots(df: DataFrame, keep: list[str]) -> DataFrame:
    """Long form of a chunk table: one row per anchor and slot k = 1..H."""
    z = F.arrays_zip(F.col("chunk").alias("v"), F.col("is_pad").alias("m"))
    return df.select(*keep, F.posexplode(z).alias("_k", "_z")).select(
        *keep,
        (F.col("_k") + 1).alias("k"),
        F.col("_z.v").alias("target"),
        F.col("_z.m").alias("padded"),
    )


def trajectory_qa(
    s: Series,
    keys: list[str],
    delta: str,
    valid: str,
    ts: str,
    per_second: int,
    max_step_mm: float = 100.0,
    max_rotation_deg: float = 90.0,
    max_dt_ms: float = 200.0,
    min_path_mm: float = 1.0,
) -> DataFrame:
    """Path, rotation and rate of a delta stream, with warnings by threshold."""
    step = F.lit(1000.0) * g.norm(g.position(F.col(delta)))
    turn = g.angle_deg(g.rotation(F.col(delta)))
    ok = F.col(valid)
    s = s.shift({"_pt": F.col(ts)})
    s = s.with_columns(
        {
            "_step": F.when(ok, step),
            "_turn": F.when(ok, turn),
            "_dt": (F.col(ts) - F.col("_pt")) * F.lit(1000.0 / per_second),
        }
    )
    span = (F.max(ts) - F.min(ts)) / F.lit(float(per_second))
    rows = F.count(F.lit(1))
    out = s.frame().groupBy(*keys).agg(
        rows.alias("rows"),
        F.count_if(ok).alias("valid_deltas"),
        F.count_if(~ok).alias("invalid_deltas"),
        F.coalesce(F.sum("_step"), F.lit(0.0)).alias("path_mm"),
        F.coalesce(F.sum("_turn"), F.lit(0.0)).alias("rotation_deg"),
        F.coalesce(F.max("_step"), F.lit(0.0)).alias("max_step_mm"),
        F.coalesce(F.max("_turn"), F.lit(0.0)).alias("max_rotation_deg"),
        F.coalesce(F.max("_dt"), F.lit(0.0)).alias("max_dt_ms"),
        F.coalesce((rows - 1) / F.nullif(span, F.lit(0.0)), F.lit(0.0)).alias("mean_rate_hz"),
    )
    warnings = F.array_compact(
        F.array(
            F.when(F.col("max_dt_ms") > max_dt_ms, "long_interval"),
            F.when((F.lit(min_path_mm) > 0) & (F.col("path_mm") < min_path_mm), "static"),
            F.when(F.col("max_step_mm") > max_step_mm, "long_step"),
            F.when(F.col("max_rotation_deg") > max_rotation_deg, "large_rotation"),
        )
    )
    return out.withColumn("warnings", warnings)
