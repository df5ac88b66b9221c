"""From raw streams to fixed-rate training samples, for all episodes in one plan."""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.functions import geometry as g
from epiframe.operators import sequence as seq
from epiframe.operators.align import Stream, align_series, align_tagged, fresh
from epiframe.operators.pose import future_chunk, state_delta
from epiframe.operators.stats import exact_quantiles
from epiframe.plans.series import Series
from epiframe.plans.shared import settle


@dataclass(frozen=True)
class Sampling:
    """Cadence and limits, in clock units.

    ``stride`` is a fixed number of source rows for each grid row. With ``output_rate`` each
    episode has its own stride, from its measured rate, and episodes whose rate or camera
    ratio is not near a whole number are rejected.
    """

    stride: int
    horizon: int
    max_alignment: int
    max_hand_age: int
    hand_policy: str = "nearest"
    interval_floor: int = 2_000_000
    interval_share: float = 0.10
    strict: bool = False
    output_rate: int | None = None
    per_second: int = 1_000_000_000
    rate_tolerance: float = 0.25
    ratio_tolerance: float = 0.05

    def __post_init__(self):
        if self.output_rate is not None and self.output_rate < 1:
            raise ValueError("output_rate must be at least 1")
        if self.stride < 1:
            raise ValueError("stride must be at least 1")
        if not 1 <= self.horizon <= 1024:
            raise ValueError("horizon must be in 1..1024")
        if self.max_alignment <= 0 or self.max_hand_age <= 0:
            raise ValueError("limits must be positive")


def episode_rates(
    s: Series, cameras: Mapping[str, Stream], clock: str, how: Sampling, gates: DataFrame | None = None
) -> DataFrame:
    """One row per episode: source_rate, stride, nominal, and why it is rejected, if it is.

    ``s`` has the master rows in order. The source rate is one over the median interval of
    ``clock``; it must be within ``rate_tolerance`` of a whole multiple of the output rate.
    The mean camera rate must be a whole multiple of it. ``gates`` has rejects found before
    (keys, category, message), which come first.
    """
    keys = s.keys
    episodes = s.frame().groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    gaps = s.shift({"_p": F.col(clock)}).frame().select(*keys, (F.col(clock) - F.col("_p")).alias("_gap"))
    out = episodes.join(exact_quantiles(gaps, keys, "_gap", {"_median": 0.5}), keys, "left")
    rate = F.lit(float(how.per_second)) / F.nullif(F.col("_median"), F.lit(0.0))
    mean = F.lit(0.0)
    for n, c in cameras.items():
        span = F.nullif(F.max(c.ts) - F.min(c.ts), F.lit(0))
        fps = ((F.count(F.lit(1)) - 1) * F.lit(float(how.per_second)) / span).alias(f"_fps_{n}")
        out = out.join(c.df.groupBy(*keys).agg(fps), keys, "left")
        mean = mean + F.col(f"_fps_{n}") / len(cameras)
    none = F.lit(None).cast("string")
    if gates is None:
        out = out.withColumns({"_gate": none, "_said": none})
    else:
        first = F.min(F.struct("category", "message"))
        gates = gates.groupBy(*keys).agg(first.alias("_g"))
        gates = gates.select(*keys, F.col("_g.category").alias("_gate"), F.col("_g.message").alias("_said"))
        out = out.join(gates, keys, "left")
    out = out.withColumns({"rate": rate, "ratio": mean / rate if cameras else F.lit(1.0)})
    out = out.withColumn("source_rate", F.bround("rate").cast("bigint"))
    whole = F.col("source_rate")
    rate_ok = (F.abs(F.col("rate") - whole) <= how.rate_tolerance) & (whole > 0) & (whole % how.output_rate == 0)
    near = F.bround("ratio")
    ratio_ok = (near > 0) & (F.abs(F.col("ratio") - near) <= how.ratio_tolerance)
    no = F.lit(False)
    category = (
        F.when(F.col("_gate").isNotNull(), F.col("_gate"))
        .when(~F.coalesce(rate_ok, no), "unsupported_rate")
        .when(~F.coalesce(ratio_ok, no), "camera_ratio")
    )
    out = out.withColumn("category", category)
    message = (
        F.when(F.col("_gate").isNotNull(), F.col("_said"))
        .when(F.col("category") == "unsupported_rate", F.format_string("source rate %s", F.col("rate").cast("string")))
        .when(F.col("category") == "camera_ratio", F.format_string("camera ratio %s", F.col("ratio").cast("string")))
    )
    nominal = F.bround(F.lit(float(how.per_second)) / F.nullif(whole, F.lit(0))).cast("bigint")
    stride = F.floor(whole / how.output_rate).cast("bigint")
    return out.select(
        *keys, "rows", "rate", "ratio", "source_rate", stride.alias("stride"), nominal.alias("nominal"),
        "category", message.alias("message"),
    )


def resampled_grid(
    master: DataFrame,
    cameras: Mapping[str, Stream],
    hands: Mapping[str, Stream],
    keys: list[str],
    ts: str,
    row_id: str,
    pose_valid: str,
    how: Sampling,
    max_rows: int | None = None,
    clock: str | None = None,
    gates: DataFrame | None = None,
    rows: DataFrame | None = None,
    tags: Mapping[str, Column] | None = None,
) -> tuple[Series, DataFrame]:
    """Grid rows with matches, validity flags and run index, and the facts of each episode.

    ``master`` has one row per master frame, aligned to the streams by ``ts``; intervals and
    rates are those of ``clock``, the frames' own clock, ``ts`` if there is only one. A grid
    row is sample-valid if every stream is within its limit, and transition-valid if since
    the previous grid row both cameras moved on, every raw pose was valid and no raw
    interval was off its nominal length. Rejected episodes have no rows, only a fact row
    with ``category`` and ``message``.

    If master and streams are rows of one table ``rows``, ``tags`` has the condition of each
    stream and of the master under ``""``; the table is then read once for all of them.
    """
    clock = clock or ts
    policy = {n: "nearest" for n in cameras} | {n: how.hand_policy for n in hands}
    streams = {**cameras, **hands}
    if rows is None:
        s = align_series(master, streams, keys, ts, row_id, policy, max_rows, number="source_row")
    else:
        of = {n: (tags[n], st.payload) for n, st in streams.items()}
        s = align_tagged(rows, tags[""], of, keys, ts, row_id, master.columns, policy, max_rows, number="source_row")

    rows = Series.plan(master.select(*dict.fromkeys([*keys, ts, row_id, clock])), keys, [ts, row_id], max_rows, like=s)
    if how.output_rate is None:
        gaps = rows.shift({"_p": F.col(clock)}).frame().select(*keys, (F.col(clock) - F.col("_p")).alias("_gap"))
        facts = exact_quantiles(gaps, keys, "_gap", {"_median": 0.5}, max_rows).select(
            *keys, F.bround("_median").cast("bigint").alias("nominal")
        )
        stride = F.lit(how.stride)
    else:
        facts = settle(episode_rates(rows, cameras, clock, how, gates))
        s = s.join_keys(facts.select(*keys, F.col("stride").alias("_stride"), "category"))
        s = s.filter("category IS NULL").map(lambda d: d.drop("category"))
        stride = F.col("_stride")
    s = seq.interval_discontinuity(s, clock, facts.select(*keys, "nominal"), how.interval_floor, how.interval_share)

    hand_ok, camera_ok = F.lit(True), F.lit(True)
    for n in hands:
        hand_ok = hand_ok & fresh(F.col(f"{n}_delta"), how.max_hand_age, how.hand_policy)
    for n in cameras:
        camera_ok = camera_ok & fresh(F.col(f"{n}_delta"), how.max_alignment)
    s = s.with_columns({"hands_fresh": hand_ok}).with_columns(
        {"sample_valid": camera_ok & F.col("hands_fresh")}
    )
    s = seq.span_all_true(
        s,
        F.pmod("source_row", stride) == 0,
        F.col(pose_valid) & F.col("interval_ok"),
        [f"{n}_index" for n in cameras],
        number="grid_index",
    )
    s = seq.valid_runs(s, F.col("sample_valid"), F.col("transition_valid"))
    return s.map(lambda d: d.drop("_stride")), facts


def strict_choice(s: Series, facts: DataFrame) -> tuple[Series, DataFrame, DataFrame]:
    """The grid rows (settled), the run that strict mode keeps of each episode, and the facts
    with the rejects that only the runs show.

    ``facts`` has one row per episode. An episode that was accepted so far is rejected here
    as ``no_valid_run``, ``all_singletons`` or ``multiple_valid_runs``; earlier rejects stay.
    The rows are written once, and read for the choice and again by what follows.
    """
    s = s.settled()
    if "category" not in facts.columns:
        none = F.lit(None).cast("string")
        facts = facts.withColumns({"category": none, "message": none})
    accepted = facts.filter("category IS NULL")
    records = seq.run_records(s.frame(), s.keys, "grid_index", [])
    chosen = settle(seq.single_substantial_run(records, s.keys, episodes=accepted))
    late = chosen.select(*s.keys, "runs", "substantial", F.col("reject_reason").alias("_late"))
    said = F.format_string("%d valid runs, %d of two or more samples", "runs", "substantial")
    out = facts.join(late, s.keys, "left").withColumns(
        {
            "category": F.coalesce("category", "_late"),
            "message": F.when(F.col("_late").isNotNull(), said).otherwise(F.col("message")),
        }
    )
    return s, chosen, out.drop("_late", "runs", "substantial")


def emitted_rows(s: Series, how: Sampling, chosen: DataFrame | None = None) -> Series:
    """Full mode keeps the whole grid; strict keeps the only run of two or more samples.

    ``chosen`` has the runs found by ``strict_choice``, whose settled rows ``s`` then are.
    """
    if not how.strict:
        return s.with_columns({"sample_pos": F.col("grid_index")})
    if chosen is None:
        s = s.settled()  # read for the choice of the run and again for its rows
        chosen = seq.single_substantial_run(seq.run_records(s.frame(), s.keys, "grid_index", []), s.keys)
    s = s.join_keys(chosen.select(*s.keys, "chosen_run")).filter("run = chosen_run")
    return s.map(lambda d: d.drop("chosen_run")).number("sample_pos")


def training_samples(
    s: Series, pose: str, joints: Column, how: Sampling, chosen: DataFrame | None = None
) -> Series:
    """State, shared-anchor action chunk and padding mask for every emitted row.

    state = pose9 of the motion since the previous row, then joints;
    action k = pose9 of the motion from this row to row + k, then joints of row + k.
    """
    s = emitted_rows(s, how, chosen).with_columns({"_j": joints})
    s = future_chunk(s, F.struct(F.col(pose).alias("p"), F.col("_j").alias("j")), how.horizon,
                     "sample_pos")
    s = state_delta(s, pose, strict=how.strict)

    def packed(p: Column, j: Column) -> Column:
        return F.concat(g.pose9(p), j).cast("array<float>")

    moved = F.transform(
        "chunk", lambda x: F.struct(g.pack(g.relative(F.col(pose), x.p)).alias("p"), x.j.alias("j"))
    )
    action = F.transform(moved, lambda y: packed(y.p, y.j))
    return s.with_columns(
        {
            "action": action,
            "state": packed(F.col("state"), F.col("_j")),
            "full_horizon": F.col("real_slots") == how.horizon,
            "alignment_valid": F.col("sample_valid") & F.col("transition_valid"),
        }
    ).map(lambda d: d.drop("chunk", "_j"))
