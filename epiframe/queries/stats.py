"""Aggregations: vector statistics, histograms, rates, quality reports and totals."""

from pyspark.sql import functions as F

from epiframe.functions import geometry as g
from epiframe.functions.values import quantile_scale, r6
from epiframe.operators import audit, stats
from epiframe.operators.align import align_series, fresh
from epiframe.operators.pose import future_chunk, slots, trajectory_qa
from epiframe.operators.sequence import monotonic_check
from epiframe.plans.series import Series
from epiframe.queries.base import (
    EM,
    EV,
    HORIZON,
    LI,
    TOLERANCE,
    asof_sql,
    events,
    kind,
    kind_sql,
    order_frames,
    pose_series,
    query,
    r6_sql,
    source,
    table,
    user_series,
    with_sql,
)
from epiframe.queries.joins import STATUS_SQL, catalog_status
from epiframe.queries.sequence import HOUR, W_EV, median_interval

DIMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KS = f"ks AS (SELECT unnest(range(1, {HORIZON + 1})) AS k)"
ST = "st AS (" + " UNION ALL ".join(
    f"SELECT l_orderkey, pos, {i} AS dim, {c} AS x FROM li" for i, c in enumerate(DIMS)
) + ")"
AC = """ac AS (SELECT a.l_orderkey, a.pos, k, s.dim, s.x FROM li a CROSS JOIN ks
  JOIN st s ON s.l_orderkey = a.l_orderkey AND s.pos = a.pos + k)"""


def frames(spark, sf_dir):
    s = order_frames(spark, sf_dir, *DIMS)
    return s.with_columns({"state": F.array(*DIMS)})


def chunks(spark, sf_dir):
    return future_chunk(frames(spark, sf_dir), F.col("state"), HORIZON, "pos")


def _rounded(df, *cols):
    return df.withColumns({c: r6(F.col(c)) for c in cols})


ALL_SQL = """SELECT key, dim, round(avg(x), 5) + 0.0 AS mean, round(stddev_pop(x), 5) + 0.0 AS std, count(*) AS n,
        round(quantile_cont(x, 0.01), 5) + 0.0 AS q01, round(quantile_cont(x, 0.99), 5) + 0.0 AS q99
        FROM al GROUP BY key, dim"""
MASKED_SQL = with_sql(
    [LI, KS, ST, AC, "al AS (SELECT 'state' AS key, dim, x FROM st UNION ALL SELECT 'actions', dim, x FROM ac)"],
    ALL_SQL,
)


def _five(df):
    # five digits: the true mean of a channel ends in a 5 at the seventh
    return df.withColumns({c: F.round(c, 5) + 0.0 for c in ("mean", "std", "q01", "q99")})


@query("masked_vector_stats", MASKED_SQL)
def masked_vector_stats(spark, sf_dir):
    rows = chunks(spark, sf_dir).frame()
    return _five(stats.masked_vector_stats(rows, {"state": "state"}, {"actions": ("chunk", "is_pad")}))


@query("future_stats", MASKED_SQL)
def future_stats(spark, sf_dir):
    """The same numbers from rows that count as often as they lie in a chunk."""
    return _five(stats.future_stats(frames(spark, sf_dir).frame(), "state", HORIZON, "pos"))


LONG = 1024


@query(
    "future_stats_long",
    with_sql(
        [
            EV,
            """n AS (SELECT user_id, value AS x, row_number() OVER (PARTITION BY user_id ORDER BY ts_us, event_id) - 1 AS pos
            FROM ev WHERE value IS NOT NULL)""",
            f"""al AS (SELECT 'state' AS key, 0 AS dim, x FROM n UNION ALL SELECT 'actions', 0, b.x FROM n a
            JOIN n b ON b.user_id = a.user_id AND b.pos > a.pos AND b.pos <= a.pos + {LONG})""",
        ],
        ALL_SQL,
    ),
)
def future_stats_long(spark, sf_dir):
    """Chunks of the next 1,024 readings of a user."""
    s = user_series(events(spark, sf_dir).filter("value IS NOT NULL"), "value").number("pos")
    s = s.with_columns({"state": F.array("value")})
    return _five(stats.future_stats(s.frame(), "state", LONG, "pos"))


def episode_stats(spark, sf_dir):
    return stats.vector_stats(frames(spark, sf_dir), ["l_orderkey"], "state", len(DIMS))


@query(
    "feature_stats",
    with_sql(
        [LI, ST],
        f"""SELECT l_orderkey, dim, min(x) AS min, max(x) AS max, {r6_sql('avg(x)')} AS mean,
        {r6_sql('stddev_pop(x)')} AS std, count(*) AS n FROM st GROUP BY 1, 2""",
    ),
)
def feature_stats(spark, sf_dir):
    return _rounded(episode_stats(spark, sf_dir), "mean", "std")


@query(
    "feature_stats_masked",
    with_sql(
        [LI, KS, ST, AC],
        f"""SELECT l_orderkey, dim, min(x) AS min, max(x) AS max, {r6_sql('avg(x)')} AS mean,
        {r6_sql('stddev_pop(x)')} AS std, count(*) AS n FROM ac GROUP BY 1, 2""",
    ),
)
def feature_stats_masked(spark, sf_dir):
    """Statistics over real action slots; episodes without any are left out."""
    rows = slots(chunks(spark, sf_dir).frame(), ["l_orderkey"]).filter(~F.col("padded"))
    return _rounded(stats.vector_stats(rows, ["l_orderkey"], "target", len(DIMS)), "mean", "std")


@query(
    "merge_stats",
    with_sql(
        [LI, ST],
        """SELECT dim, min(x) AS min, max(x) AS max, round(avg(x), 5) + 0.0 AS mean,
        round(stddev_pop(x), 5) + 0.0 AS std, count(*) AS n FROM st GROUP BY 1""",
    ),
)
def merge_stats(spark, sf_dir):
    out = stats.merge_stats(episode_stats(spark, sf_dir), ["dim"])
    return out.withColumns({c: F.round(c, 5) + 0.0 for c in ("mean", "std")})


def value_histogram(spark, sf_dir):
    level = F.least(F.lit(255), F.floor("value").cast("int"))
    return stats.build_histogram(events(spark, sf_dir), F.col("event_type"), level)


@query(
    "histogram_stats",
    with_sql(
        ["h AS (SELECT event_type AS channel, least(255, floor(value)) / 255.0::DOUBLE AS x FROM events)"],
        f"""SELECT channel, {r6_sql('min(x)')} AS min, {r6_sql('max(x)')} AS max,
        {r6_sql('avg(x)')} AS mean, {r6_sql('stddev_pop(x)')} AS std, count(*) AS n FROM h GROUP BY 1""",
    ),
)
def histogram_stats(spark, sf_dir):
    out = stats.histogram_stats(value_histogram(spark, sf_dir))
    return _rounded(out, "min", "max", "mean", "std")


@query(
    "build_histogram",
    """SELECT l_returnflag AS channel, floor(l_quantity)::INTEGER AS level, count(*) AS count
    FROM lineitem GROUP BY 1, 2""",
)
def build_histogram(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    level = F.floor("l_quantity").cast("int")
    return stats.build_histogram(rows, F.col("l_returnflag"), level)


@query(
    "exposure_flags",
    with_sql(
        [
            "h AS (SELECT user_id, least(255, floor(value))::INTEGER AS v FROM events)",
            """e AS (SELECT user_id, avg(v) AS mean, stddev_pop(v) AS std,
              avg((v < 16)::INTEGER) AS dark, avg((v >= 240)::INTEGER) AS bright FROM h GROUP BY 1)""",
        ],
        f"""SELECT user_id, {r6_sql('mean')} AS mean, {r6_sql('std')} AS std,
        {r6_sql('dark')} AS dark_fraction, {r6_sql('bright')} AS bright_fraction,
        concat_ws(',', CASE WHEN mean < 35 OR dark > 0.65 THEN 'DARK' END,
          CASE WHEN mean > 220 OR bright > 0.65 THEN 'BRIGHT' END,
          CASE WHEN std < 20 THEN 'LOW_CONTRAST' END) AS flags FROM e""",
    ),
)
def exposure_flags(spark, sf_dir):
    level = F.least(F.lit(255), F.floor("value").cast("int")).alias("level")
    hist = events(spark, sf_dir).groupBy("user_id", level).agg(F.count(F.lit(1)).alias("count"))
    out = stats.exposure_flags(hist, ["user_id"])
    out = _rounded(out, "mean", "std", "dark_fraction", "bright_fraction")
    return out.withColumn("flags", F.array_join("flags", ","))


def clip_timing_of(df, keys, row, ts, per_second, frame_rate=60):
    """First and last clock in file order, frame count, both durations and the frame rate."""
    out = df.groupBy(*keys).agg(
        F.min_by(ts, row).alias("first_ts"),
        F.max_by(ts, row).alias("last_ts"),
        F.count(ts).alias("frames"),
    )
    span = (F.col("last_ts") - F.col("first_ts")) / F.lit(float(per_second))
    useful = (F.col("frames") > 1) & (F.col("last_ts") > F.col("first_ts"))
    gaps = F.nullif(F.col("frames") - 1, F.lit(0))
    return out.withColumns(
        {
            "review_seconds": F.when(useful, F.round(span + span / gaps, 3)).otherwise(0.0),
            "chooser_seconds": F.when(useful, F.round(span + F.lit(1.0 / frame_rate), 3)),
            "capture_fps": F.when(useful, F.round(gaps / F.nullif(span, F.lit(0.0)), 9)).otherwise(0.0),
        }
    )


@query(
    "clip_timing",
    with_sql(
        [
            EV,
            """c AS (SELECT user_id, min_by(ts_us, event_id) AS first_ts, max_by(ts_us, event_id) AS last_ts,
              count(*) AS frames FROM ev WHERE event_type = 'click' GROUP BY 1)""",
            "s AS (SELECT *, (last_ts - first_ts) / 1000000.0::DOUBLE AS span, frames > 1 AND last_ts > first_ts AS u FROM c)",
        ],
        """SELECT user_id, first_ts, last_ts, frames,
        CASE WHEN u THEN round(span + span / (frames - 1), 3) ELSE 0 END AS review_seconds,
        CASE WHEN u THEN round(span + 1.0::DOUBLE / 60, 3) END AS chooser_seconds,
        CASE WHEN u THEN round((frames - 1) / span, 9) ELSE 0 END AS capture_fps FROM s""",
    ),
)
def clip_timing(spark, sf_dir):
    rows = kind(events(spark, sf_dir), "click")
    return clip_timing_of(rows, ["user_id"], "event_id", "ts_us", 1_000_000)


@query(
    "measured_rate",
    with_sql(
        [EV, kind_sql("view"), f"d AS (SELECT *, lag(ts_us) {W_EV} AS p FROM view)"],
        f"""SELECT user_id, count(*) FILTER (WHERE ts_us <= p) = 0 AS increasing,
        {r6_sql('(count(*) - 1) * 86400000000.0::DOUBLE / nullif(max(ts_us) - min(ts_us), 0)')}
        AS per_day FROM d GROUP BY 1""",
    ),
)
def measured_rate(spark, sf_dir):
    s = user_series(kind(events(spark, sf_dir), "view"))
    order = monotonic_check(s, "ts_us", "event_id").select(
        "user_id", F.col("accepted").alias("increasing")
    )
    span = F.nullif(F.max("ts_us") - F.min("ts_us"), F.lit(0))
    rate = (F.count(F.lit(1)) - 1) * F.lit(24.0 * HOUR) / span
    return order.join(s.frame().groupBy("user_id").agg(r6(rate).alias("per_day")), "user_id")


@query(
    "median_rate_and_ratio",
    with_sql(
        [
            EV,
            *[kind_sql(k) for k in ("click", "view")],
            *asof_sql("view"),
            f"gd AS (SELECT user_id, ts_us - lag(ts_us) {W_EV} AS gap FROM click)",
            f"gr AS (SELECT user_id, {24 * HOUR}.0::DOUBLE / median(gap) AS rate FROM gd GROUP BY 1)",
            f"""cr AS (SELECT user_id, (count(*) - 1) * {24 * HOUR}.0::DOUBLE
              / nullif(max(ts_us) - min(ts_us), 0) AS cam FROM view GROUP BY 1)""",
            """rr AS (SELECT user_id, rate, round_even(rate, 0)::BIGINT AS whole, cam / rate AS ratio,
              greatest(1, round_even(cam / rate, 0)::BIGINT) AS k FROM gr JOIN cr USING (user_id))""",
            """oo AS (SELECT n.user_id, round_even(median(n.s_pos - rr.k * c.pos), 0)::BIGINT AS offset_frames
              FROM near_view n JOIN click c ON c.event_id = n.event_id JOIN rr ON rr.user_id = n.user_id
              GROUP BY 1)""",
        ],
        f"""SELECT user_id, {r6_sql('rate')} AS rate, whole AS source_rate,
        coalesce(abs(rate - whole) <= 0.25 AND whole > 0 AND whole % 2 = 0, false) AS rate_ok,
        {r6_sql('ratio')} AS ratio, k AS camera_ratio, abs(ratio - k) <= 0.05 AS ratio_ok, offset_frames
        FROM rr LEFT JOIN oo USING (user_id)""",
    ),
)
def median_rate_and_ratio(spark, sf_dir):
    """Frames per day here; the source rate must be near a whole multiple of the output rate 2."""
    ev = events(spark, sf_dir)
    grid = kind(ev, "click").select("user_id", "event_id", "ts_us")
    rates = median_interval(user_series(grid)).select(
        "user_id", (F.lit(24.0 * HOUR) / F.col("median")).alias("rate")
    )
    span = F.nullif(F.max("ts_us") - F.min("ts_us"), F.lit(0))
    cams = kind(ev, "view").groupBy("user_id").agg(
        ((F.count(F.lit(1)) - 1) * F.lit(24.0 * HOUR) / span).alias("cam")
    )
    ratio = F.col("cam") / F.col("rate")
    facts = rates.join(cams, "user_id").select(
        "user_id",
        "rate",
        F.bround("rate").cast("bigint").alias("source_rate"),
        ratio.alias("ratio"),
        F.greatest(F.lit(1), F.bround(ratio).cast("bigint")).alias("camera_ratio"),
    )
    s = align_series(grid, {"cam": source(ev, "view")}, ["user_id"], "ts_us", "event_id")
    s = s.number("pos").join_keys(facts.select("user_id", "camera_ratio"))
    shift = s.frame().select(
        "user_id", (F.col("cam_index") - F.col("camera_ratio") * F.col("pos")).alias("shift")
    )
    offset = stats.exact_quantiles(shift, ["user_id"], "shift", {"median": 0.5})
    out = facts.join(offset, "user_id", "left")
    whole = F.col("source_rate")
    close = (F.abs(F.col("rate") - whole) <= 0.25) & (whole > 0)
    return out.select(
        "user_id",
        r6(F.col("rate")).alias("rate"),
        "source_rate",
        F.coalesce(close & (whole % 2 == 0), F.lit(False)).alias("rate_ok"),
        r6(F.col("ratio")).alias("ratio"),
        "camera_ratio",
        (F.abs(F.col("ratio") - F.col("camera_ratio")) <= 0.05).alias("ratio_ok"),
        F.bround("median").cast("bigint").alias("offset_frames"),
    )


@query(
    "byte_reconcile",
    """SELECT source, sum(n_chars)::BIGINT AS declared, sum(length(text))::BIGINT AS actual,
    (sum(length(text)) - sum(n_chars))::BIGINT AS overhead,
    sum(length(text)) - sum(n_chars) BETWEEN 0 AND 4096 AS within_overhead,
    sum(length(text)) = sum(n_chars) AS exact FROM documents GROUP BY 1""",
)
def byte_reconcile(spark, sf_dir):
    out = table(spark, sf_dir, "documents").groupBy("source").agg(
        F.sum("n_chars").alias("declared"), F.sum(F.length("text")).alias("actual")
    )
    out = out.withColumn("overhead", F.col("actual") - F.col("declared"))
    return out.withColumns(
        {"within_overhead": F.col("overhead").between(0, 4096), "exact": F.col("overhead") == 0}
    )


@query(
    "trajectory_qa",
    with_sql(
        [
            EM,
            """t AS (SELECT *, qw > -0.2 AS ok, 1000.0 * sqrt(px*px + py*py + pz*pz) AS step,
              degrees(2 * acos(least(1.0, abs(qw)))) AS turn,
              (vec_id - lag(vec_id) OVER (PARTITION BY label ORDER BY vec_id)) * 20.0 AS dt FROM em)""",
            """q AS (SELECT label, count(*) AS rows, count(*) FILTER (WHERE ok) AS valid_deltas,
              count(*) FILTER (WHERE NOT ok) AS invalid_deltas,
              coalesce(sum(step) FILTER (WHERE ok), 0) AS path_mm,
              coalesce(sum(turn) FILTER (WHERE ok), 0) AS rotation_deg,
              coalesce(max(step) FILTER (WHERE ok), 0) AS max_step_mm,
              coalesce(max(turn) FILTER (WHERE ok), 0) AS max_rotation_deg,
              coalesce(max(dt), 0) AS max_dt_ms,
              coalesce((count(*) - 1) / nullif((max(vec_id) - min(vec_id)) / 50.0, 0), 0) AS mean_rate_hz
              FROM t GROUP BY 1)""",
        ],
        "SELECT label, rows, valid_deltas, invalid_deltas, "
        + ", ".join(
            f"{r6_sql(c + '::DOUBLE')} AS {c}"
            for c in ("path_mm", "rotation_deg", "max_step_mm", "max_rotation_deg", "max_dt_ms", "mean_rate_hz")
        )
        + """, concat_ws(',', CASE WHEN max_dt_ms > 200 THEN 'long_interval' END,
        CASE WHEN path_mm < 1 THEN 'static' END, CASE WHEN max_step_mm > 100 THEN 'long_step' END,
        CASE WHEN max_rotation_deg > 90 THEN 'large_rotation' END) AS warnings FROM q""",
    ),
)
def trajectory_qa_rows(spark, sf_dir):
    s = pose_series(spark, sf_dir).with_columns({"ok": F.col("pose.qw") > -0.2})
    out = trajectory_qa(s, ["label"], "pose", "ok", "vec_id", 50)
    cols = ("path_mm", "rotation_deg", "max_step_mm", "max_rotation_deg", "max_dt_ms", "mean_rate_hz")
    return _rounded(out, *cols).withColumn("warnings", F.array_join("warnings", ","))


STREAMS = {"cam0": "view", "cam1": "purchase", "left": "error", "right": "signup"}
ALIGNED_SQL = [
    EV,
    *[kind_sql(k) for k in ("click", *STREAMS.values())],
    *[c for k in STREAMS.values() for c in asof_sql(k)],
    """al AS (SELECT v.user_id, v.event_id, v.ts_us, v.delta AS cam0, p.delta AS cam1, e.delta AS left_,
      s.delta AS right_, v.s_pos AS cam0_index, p.s_pos AS cam1_index FROM near_view v
      JOIN near_purchase p USING (user_id, event_id) JOIN near_error e USING (user_id, event_id)
      JOIN near_signup s USING (user_id, event_id))""",
]


def aligned(spark, sf_dir):
    ev = events(spark, sf_dir)
    grid = kind(ev, "click").select("user_id", "event_id", "ts_us")
    streams = {n: source(ev, k) for n, k in STREAMS.items()}
    return align_series(grid, streams, ["user_id"], "ts_us", "event_id")


@query(
    "alignment_extremes",
    with_sql(
        ALIGNED_SQL,
        " UNION ALL ".join(
            f"""SELECT '{n}' AS stream, max(abs({c})) AS max_abs_delta,
            count(*) FILTER (WHERE NOT coalesce(abs({c}) <= {TOLERANCE}, false)) AS over_limit,
            count(*) AS rows FROM al"""
            for n, c in zip(STREAMS, ("cam0", "cam1", "left_", "right_"))
        ),
    ),
)
def alignment_extremes(spark, sf_dir):
    rows = aligned(spark, sf_dir).frame()
    per = F.array(
        *[F.struct(F.lit(n).alias("stream"), F.col(f"{n}_delta").alias("delta")) for n in STREAMS]
    )
    long = rows.select(F.explode(per).alias("s")).select("s.*")
    return long.groupBy("stream").agg(
        F.max(F.abs("delta")).alias("max_abs_delta"),
        F.count_if(~fresh(F.col("delta"), TOLERANCE)).alias("over_limit"),
        F.count(F.lit(1)).alias("rows"),
    )


@query(
    "preflight_summary",
    with_sql(
        [
            *ALIGNED_SQL,
            f"""ep AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE
              coalesce(abs(cam0) <= {TOLERANCE} AND abs(cam1) <= {TOLERANCE}
              AND abs(left_) <= {TOLERANCE} AND abs(right_) <= {TOLERANCE}, false)) AS good,
              max(abs(cam0)) AS c0, max(abs(cam1)) AS c1, max(abs(left_)) AS l, max(abs(right_)) AS r
              FROM al GROUP BY 1)""",
        ],
        f"""SELECT count(*) AS episodes, sum(n)::BIGINT AS rows, min(n) AS min_rows, max(n) AS max_rows,
        max(c0) AS max_cam0, max(c1) AS max_cam1, max(l) AS max_left, max(r) AS max_right,
        {r6_sql('min(good / n::DOUBLE)')} AS worst_retention,
        count(*) FILTER (WHERE good = 0) AS failures,
        CASE WHEN count(*) FILTER (WHERE good = 0) = 0 THEN 'ok' ELSE 'failed' END AS status FROM ep""",
    ),
)
def preflight_summary(spark, sf_dir):
    ok = F.lit(True)
    for n in STREAMS:
        ok = ok & fresh(F.col(f"{n}_delta"), TOLERANCE)
    episodes = aligned(spark, sf_dir).frame().groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(ok).alias("good"),
        *[F.max(F.abs(f"{n}_delta")).alias(n) for n in STREAMS],
    )
    failures = F.count_if(F.col("good") == 0)
    return episodes.agg(
        F.count(F.lit(1)).alias("episodes"),
        F.sum("n").alias("rows"),
        F.min("n").alias("min_rows"),
        F.max("n").alias("max_rows"),
        *[F.max(n).alias(f"max_{n}") for n in STREAMS],
        r6(F.min(F.col("good") / F.col("n"))).alias("worst_retention"),
        failures.alias("failures"),
        F.when(failures == 0, "ok").otherwise("failed").alias("status"),
    )


@query(
    "padding_totals",
    with_sql(
        [LI, KS, "s AS (SELECT l_orderkey, pos, n, count(*) FILTER (WHERE pos + k >= n) AS pad FROM li, ks GROUP BY ALL)"],
        f"""SELECT count(*) FILTER (WHERE pad = 0) AS full_rows, count(*) FILTER (WHERE pad > 0) AS partial_rows,
        sum(pad)::BIGINT AS padded_slots, sum({HORIZON} - pad)::BIGINT AS real_slots,
        (SELECT count(*) FROM (SELECT l_orderkey FROM s GROUP BY 1 HAVING min(pad) > 0))
        AS episodes_without_full_row FROM s""",
    ),
)
def padding_totals(spark, sf_dir):
    s = future_chunk(order_frames(spark, sf_dir), F.lit(0), HORIZON, "pos")
    pad = F.size(F.filter("is_pad", lambda p: p))
    episodes = s.frame().groupBy("l_orderkey").agg(
        F.count_if(pad == 0).alias("full"),
        F.count_if(pad > 0).alias("partial"),
        F.sum(pad).alias("pad"),
        F.sum("real_slots").alias("real"),
    )
    return episodes.agg(
        F.sum("full").alias("full_rows"),
        F.sum("partial").alias("partial_rows"),
        F.sum("pad").alias("padded_slots"),
        F.sum("real").alias("real_slots"),
        F.count_if(F.col("full") == 0).alias("episodes_without_full_row"),
    )


@query(
    "review_counts",
    with_sql(
        [STATUS_SQL],
        """SELECT count(*) AS total, count(*) FILTER (WHERE status <> 'trashed') AS active,
        count(*) FILTER (WHERE status = 'pending') AS pending,
        count(*) FILTER (WHERE status = 'kept') AS kept,
        count(*) FILTER (WHERE status = 'skipped') AS skipped,
        count(*) FILTER (WHERE status = 'trashed') AS trashed,
        count(*) FILTER (WHERE status <> 'pending') AS reviewed FROM cat""",
    ),
)
def review_counts(spark, sf_dir):
    status = F.col("status")
    names = ("pending", "kept", "skipped", "trashed")
    return catalog_status(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status != "trashed").alias("active"),
        *[F.count_if(status == n).alias(n) for n in names],
        F.count_if(status != "pending").alias("reviewed"),
    )


@query(
    "joint_extremes",
    with_sql(
        [LI, ST],
        """SELECT dim, min(x) AS min, max(x) AS max,
        count(*) FILTER (WHERE x < 0 OR x > 100) AS outside FROM st GROUP BY 1""",
    ),
)
def joint_extremes(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.posexplode(F.array(*DIMS)).alias("dim", "x"))
    return rows.groupBy("dim").agg(
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        F.count_if(~F.col("x").between(0, 100)).alias("outside"),
    )


def bounds(spark, sf_dir):
    """Empirical 1 % and 99 % bounds of every state channel."""
    rows = table(spark, sf_dir, "lineitem").select(F.posexplode(F.array(*DIMS)).alias("dim", "x"))
    found = stats.selected_quantiles(rows, ["dim"], "x", {"q01": 0.01, "q99": 0.99})
    return found.select("dim", "q01", "q99")


def bounds_row(found):
    """The bounds as one map from dim to (q01, q99): four entries."""
    entry = F.struct("dim", F.struct("q01", "q99"))
    return found.agg(F.map_from_entries(F.collect_list(entry))).scalar()


BOUNDS_SQL = (
    "bd AS (SELECT dim, quantile_cont(x, 0.01) AS q01, quantile_cont(x, 0.99) AS q99 FROM st GROUP BY 1)"
)


@query(
    "target_energy",
    with_sql(
        [
            LI,
            ST,
            BOUNDS_SQL,
            "nz AS (SELECT l_orderkey, 2 * (x - q01) / (q99 - q01 + 1e-6) - 1 AS y FROM st JOIN bd USING (dim))",
        ],
        f"SELECT l_orderkey, {r6_sql('sum(y * y) / (count(*) / 4.0::DOUBLE) / 32')} AS energy FROM nz GROUP BY 1",
    ),
)
def target_energy(spark, sf_dir):
    """Sum of squared normalised channels per row, over 32 model dimensions."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", *DIMS)
    rows = rows.withColumn("_b", bounds_row(bounds(spark, sf_dir)))
    ys = [quantile_scale(F.col(c), F.col("_b")[i]["q01"], F.col("_b")[i]["q99"]) for i, c in enumerate(DIMS)]
    rows = rows.select("l_orderkey", sum((y * y for y in ys[1:]), ys[0] * ys[0]).alias("e"))
    return rows.groupBy("l_orderkey").agg(r6(F.avg("e") / 32).alias("energy"))


@query(
    "value_distribution",
    "SELECT l_returnflag, l_linestatus, count(*) AS rows FROM lineitem GROUP BY 1, 2",
)
def value_distribution(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "ordered_digest",
    with_sql(
        [
            """c AS (SELECT concat(conv_id, ':', turn) AS id,
              row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos FROM conversations)""",
            "d AS (SELECT pos // 1024 AS leaf, sha256(string_agg(id, chr(10) ORDER BY pos)) AS h FROM c GROUP BY 1)",
        ],
        """SELECT CASE WHEN count(*) = 1 THEN min(h) ELSE sha256(string_agg(h, chr(10) ORDER BY leaf))
        END AS tree_sha256, CASE WHEN count(*) = 1 THEN 1 ELSE 2 END AS levels, 1024 AS leaf FROM d""",
    ),
)
def ordered_digest(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(
        F.lit(1).alias("_all"), "conv_id", "turn", F.concat_ws(":", "conv_id", "turn").alias("id")
    )
    s = Series.plan(rows, ["_all"], ["conv_id", "turn"]).number("pos")
    return audit.chained_digest(s.frame(), "pos", "id")


def _quarter(i):
    return f"sum(('0x' || substr(h, {8 * i + 1}, 8))::BIGINT)::VARCHAR AS part{i}"


@query(
    "canonical_digest",
    with_sql(
        [
            """j AS (SELECT md5(to_json({'event_id': event_id, 'event_type': event_type, 'props': props,
              'ts': epoch_us(ts), 'user_id': user_id, 'value': round(value * 1000000)::BIGINT})::VARCHAR) AS h
              FROM events)"""
        ],
        "SELECT count(*) AS rows, " + ", ".join(_quarter(i) for i in range(4)) + " FROM j",
    ),
)
def canonical_digest(spark, sf_dir):
    """All six columns; instants and values as integers, whose text is the same everywhere."""
    rows = events(spark, sf_dir).withColumnRenamed("ts_us", "ts")
    rows = rows.withColumn("value", F.round(F.col("value") * 1_000_000).cast("bigint"))
    return audit.canonical_digest(rows, rows.columns)


@query(
    "masked_mean",
    with_sql(
        [LI, KS],
        f"""SELECT l_orderkey, k::INTEGER AS k, {r6_sql('coalesce(avg(t.l_extendedprice), 0)')} AS masked_mean,
        count(t.l_extendedprice) AS real_slots FROM li a CROSS JOIN ks
        LEFT JOIN (SELECT l_orderkey, pos, l_extendedprice FROM li) t
        ON t.l_orderkey = a.l_orderkey AND t.pos = a.pos + k GROUP BY ALL""".replace(
            "SELECT l_orderkey, k", "SELECT a.l_orderkey, k"
        ),
    ),
)
def masked_mean(spark, sf_dir):
    s = future_chunk(order_frames(spark, sf_dir), F.col("l_extendedprice"), HORIZON, "pos")
    rows = slots(s.frame(), ["l_orderkey"])
    out = stats.masked_mean(rows, ["l_orderkey", "k"], F.col("target"), F.col("padded"))
    return _rounded(out, "masked_mean")


@query(
    "failure_categories",
    with_sql(
        [EV, "u AS (SELECT user_id, count(*) AS n, max(value) AS v FROM ev GROUP BY 1)"],
        """SELECT category, count(*) AS episodes FROM (SELECT CASE WHEN n < 60 THEN 'too_short'
        WHEN v > 250 THEN 'out_of_range' ELSE 'ok' END AS category FROM u) WHERE category <> 'ok'
        GROUP BY 1""",
    ),
)
def failure_categories(spark, sf_dir):
    users = events(spark, sf_dir).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("v")
    )
    category = F.when(F.col("n") < 60, "too_short").when(F.col("v") > 250, "out_of_range")
    failed = users.select(category.alias("category")).filter("category IS NOT NULL")
    return failed.groupBy("category").agg(F.count(F.lit(1)).alias("episodes"))


@query(
    "image_error",
    with_sql(
        [LI, "e AS (SELECT l_quantity - floor(l_quantity * 0.9 + l_tax * 10) AS d FROM li)"],
        f"""SELECT 0::BIGINT AS one_sided, {r6_sql('avg(d * d)')} AS mse, {r6_sql('avg(abs(d))')} AS mae,
        {r6_sql('10 * log10(255.0 * 255.0 / avg(d * d))')} AS psnr FROM e""",
    ),
)
def image_error(spark, sf_dir):
    a = order_frames(spark, sf_dir, "l_tax").frame()
    b = a.withColumn("l_quantity", F.floor(F.col("l_quantity") * 0.9 + F.col("l_tax") * 10))
    pixel = ["l_orderkey", "pos"]
    out = stats.image_error(
        a.select(*pixel, "l_quantity"), b.select(*pixel, "l_quantity"), pixel, "l_quantity", 255.0
    )
    return _rounded(out, "mse", "mae", "psnr")
