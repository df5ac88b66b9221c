"""Streaming jobs over the events, which arrive in three slices of time.

Every job runs after each slice and resumes from its checkpoint; the result equals that of
the batch operator over all rows.
"""

from pyspark.sql import functions as F

from epiframe.functions.values import r6
from epiframe.plans.shared import new_path
from epiframe.queries.base import EV, asof_sql, events, kind_sql, query, r6_sql, with_sql
from epiframe.queries.io import ACTION_SQL, action_rows
from epiframe.queries.rows import KINDS
from epiframe.queries.sequence import DAY, W_EV
from epiframe.streaming import jobs, state

SLICES = 3


def deliver(df, order, path, each, closing=None):
    """Append the rows slice by slice in order of ``order``; call ``each`` after every slice."""
    low, high = df.agg(F.min(order), F.max(order)).first()
    width = (high - low) // SLICES + 1
    for i in range(SLICES):
        lo, hi = low + i * width, low + (i + 1) * width
        part = df.filter((F.col(order) >= lo) & (F.col(order) < hi))
        part.drop("_arrival").write.mode("append").parquet(path)
        each()
    if closing is not None:
        closing.write.mode("append").parquet(path)
        each()


@query(
    "stream_new_episodes",
    with_sql(
        [EV],
        """SELECT user_id, max(ts_us) AS changed_at FROM ev GROUP BY 1
        HAVING count(DISTINCT event_type) FILTER (WHERE value >= 30) = 5""",
    ),
)
def stream_new_episodes(spark, sf_dir):
    files = events(spark, sf_dir).select(
        "user_id", "event_type", F.floor(F.col("value") / 30).alias("size"), "ts_us"
    )
    path, out, mark = [new_path(spark, n) for n in ("files", "complete", "checkpoint")]

    def each():
        stream = jobs.arriving(spark, path, files.schema)
        found = state.new_episodes(stream, "user_id", "event_type", "size", "ts_us", KINDS)
        jobs.run_available(found, jobs.batch_writer(out), "update", mark, state.STATE)

    deliver(files, "ts_us", path, each)
    return jobs.latest(spark, out, ["user_id"])


_DECISIONS = with_sql(
    [EV, ACTION_SQL, "l AS (SELECT id, arg_max(action, seq) AS a, max(done_at) AS decided_at FROM ac GROUP BY 1)"],
    """SELECT id, decided_at, CASE a WHEN 'keep' THEN 'kept' WHEN 'skip' THEN 'skipped'
    WHEN 'trash' THEN 'trashed' ELSE 'pending' END AS status FROM l""",
)


@query("decision_state", _DECISIONS)
def decision_state(spark, sf_dir):
    return jobs.decision_state(action_rows(spark, sf_dir))


@query("stream_decision_state", _DECISIONS)
def stream_decision_state(spark, sf_dir):
    actions = action_rows(spark, sf_dir)
    path, out, mark = [new_path(spark, n) for n in ("actions", "decisions", "checkpoint")]

    def each():
        state = jobs.decision_state(jobs.arriving(spark, path, actions.schema))
        jobs.run_available(state, jobs.batch_writer(out), "update", mark)

    deliver(actions, "done_at", path, each)
    return jobs.latest(spark, out, ["id"])


@query(
    "stream_asof_backward",
    with_sql(
        [EV, kind_sql("click"), kind_sql("error"), asof_sql("error")[0]],
        """SELECT user_id, event_id, ts_us, s_id AS src_event_id, s_ts - ts_us AS src_delta FROM b_error""",
    ),
)
def stream_asof_backward(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        "user_id", "event_id", "ts_us", "event_type", F.timestamp_micros("ts_us").alias("at")
    )
    kind = F.col("event_type")
    path, out, mark = [new_path(spark, n) for n in ("rows", "matched", "checkpoint")]

    def each():
        stream = jobs.arriving(spark, path, rows.schema).filter(kind.isin("click", "error", "end"))
        found = state.asof_backward(stream, ["user_id"], "at", "ts_us", "event_id", kind == "click", ["event_id"], "1 day", DAY)
        jobs.run_available(found, jobs.batch_writer(out), "append", mark, state.STATE)

    deliver(rows, "ts_us", path, each, the_end(rows, event_id=-1, event_type="end"))
    return spark.read.parquet(out).drop(jobs.BATCH)


def the_end(rows, **values):
    """One late row of no user, which moves the watermark past everything that waits."""
    last = rows.agg((F.max("ts_us") + 30 * DAY).alias("m"))
    own = {"ts_us": F.col("m"), "at": F.timestamp_micros("m"), **{k: F.lit(v) for k, v in values.items()}}
    return last.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema])


IDLE = 2 * DAY
#: Rows arrive up to 20 hours after their time, out of order.
_ARRIVAL = "ts_us + event_id * 7919 % 72000 * 1000000"


@query(
    "stream_flag_runs",
    with_sql(
        [
            EV,
            f"""f AS (SELECT *, value >= 20 AS ok, coalesce(lag(value) {W_EV} >= 20, false) AS prev_ok,
              event_type <> 'signup' AND ts_us - lag(ts_us) {W_EV} <= {IDLE} AS edge FROM ev)""",
            f"r AS (SELECT *, sum((ok AND NOT (prev_ok AND coalesce(edge, false)))::INTEGER) {W_EV} - 1 AS run FROM f)",
        ],
        """SELECT user_id, run::BIGINT AS run, min(ts_us) AS first_ts, max(ts_us) AS last_ts, arg_min(event_id, (ts_us, event_id))
        AS first_row, arg_max(event_id, (ts_us, event_id)) AS last_row, count(*) AS samples FROM r WHERE ok GROUP BY user_id, run""",
    ),
)
def stream_flag_runs(spark, sf_dir):
    """Runs broken by low values, by sign-ups and by idle time; rows come late and out of order."""
    rows = events(spark, sf_dir).select(
        "user_id", "event_id", "ts_us", "event_type", "value", F.timestamp_micros("ts_us").alias("at")
    )
    path, out, mark = [new_path(spark, n) for n in ("rows", "runs", "checkpoint")]

    def each():
        stream = jobs.arriving(spark, path, rows.schema)
        runs = state.flag_runs(
            stream, ["user_id"], "at", "ts_us", "event_id", F.col("value") >= 20, F.col("event_type") != "signup", IDLE, "1 day", DAY
        )
        late = jobs.run_available(runs, jobs.batch_writer(out), "append", mark, state.STATE)
        if late:
            raise ValueError(f"{late} rows came after the watermark")

    deliver(rows.withColumn("_arrival", F.expr(_ARRIVAL)), "_arrival", path, each, the_end(rows, event_id=-1))
    return spark.read.parquet(out).drop(jobs.BATCH)


@query(
    "stream_gap_runs",
    with_sql(
        [
            EV,
            f"g AS (SELECT *, coalesce(ts_us - lag(ts_us) {W_EV} >= {DAY}, false)::INTEGER AS brk FROM ev)",
            f"r AS (SELECT *, sum(brk) {W_EV} AS run FROM g)",
        ],
        """SELECT user_id, min(ts_us) AS first_ts, max(ts_us) AS last_ts, count(*) AS rows
        FROM r GROUP BY user_id, run""",
    ),
)
def stream_gap_runs(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        "user_id", "ts_us", F.timestamp_micros("ts_us").alias("at")
    )
    path, out, mark = [new_path(spark, n) for n in ("rows", "runs", "checkpoint")]
    def each():
        stream = jobs.arriving(spark, path, rows.schema)
        runs = jobs.gap_runs(stream, ["user_id"], "at", "1 day", "ts_us", late="1 hour")
        jobs.run_available(runs, jobs.batch_writer(out), "append", mark, jobs.LOCAL_SESSIONS)

    deliver(rows, "ts_us", path, each, the_end(rows))
    return spark.read.parquet(out).drop(jobs.BATCH).filter("user_id IS NOT NULL")


@query(
    "stream_feature_stats",
    with_sql(
        [EV],
        f"""SELECT user_id, event_type, min(value) AS min, max(value) AS max, {r6_sql('avg(value)')} AS mean,
        {r6_sql('stddev_pop(value)')} AS std, count(*) AS n FROM ev GROUP BY 1, 2""",
    ),
)
def stream_feature_stats(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_type", "value", "ts_us")
    path, out, mark = [new_path(spark, n) for n in ("rows", "stats", "checkpoint")]

    def each():
        stream = jobs.arriving(spark, path, rows.schema)
        state = jobs.running_stats(stream, ["user_id", "event_type"], "value")
        jobs.run_available(state, jobs.batch_writer(out), "update", mark)

    deliver(rows, "ts_us", path, each)
    out = jobs.latest(spark, out, ["user_id", "event_type"])
    return out.withColumns({c: r6(F.col(c)) for c in ("mean", "std")})
