"""Joins: as-of, equi, positional, list, audit and multi-stream."""

from pyspark.sql import functions as F

from epiframe.functions import geometry as g
from epiframe.functions.values import r6
from epiframe.operators import audit
from epiframe.operators.align import align_tagged, flat, fresh
from epiframe.operators.pose import future_chunk, slots
from epiframe.plans.series import Series
from epiframe.plans.shared import new_path
from epiframe.sources.sinks import write_layout
from epiframe.queries.base import (
    EM,
    EV,
    HORIZON,
    LI,
    LI_ORDER,
    TOLERANCE,
    asof_sql,
    events,
    kind,
    kind_sql,
    order_frames,
    pose_rows,
    query,
    r6_sql,
    table,
    user_series,
    with_sql,
)

GRID = ["user_id", "event_id", "ts_us"]


def _asof(spark, sf_dir, name, policy):
    rows = tagged(events(spark, sf_dir), {"src": name}, policy)
    return flat(rows, PAYLOAD)


PAYLOAD = ["event_id", "value"]


def tagged(ev, names, policy="nearest"):
    """Clicks with their match from events of other types, all from one pass over the events."""
    streams = {n: (F.col("event_type") == k, PAYLOAD) for n, k in names.items()}
    s = align_tagged(ev, F.col("event_type") == "click", streams, ["user_id"], "ts_us", "event_id", GRID, policy)
    return s.frame().drop("_t", "_q", "_id")


@query(
    "asof_nearest",
    with_sql(
        [EV, kind_sql("click"), kind_sql("view"), *asof_sql("view")],
        """SELECT user_id, event_id, ts_us, s_id AS src_event_id, s_value AS src_value,
        s_pos AS src_index, delta AS src_delta FROM near_view""",
    ),
)
def asof_nearest(spark, sf_dir):
    return _asof(spark, sf_dir, "view", "nearest")


BUCKETS = 8


def stored_events(spark, sf_dir):
    """The events as a table bucketed by user and sorted by time."""
    ev = events(spark, sf_dir).select("user_id", "event_id", "ts_us", "value", "event_type")
    return write_layout(ev, new_path(spark, "events"), ["user_id"], ["ts_us", "event_id"], BUCKETS)


@query(
    "asof_stored",
    with_sql(
        [EV, kind_sql("click"), kind_sql("view"), *asof_sql("view")],
        """SELECT user_id, event_id, ts_us, s_id AS src_event_id, s_value AS src_value,
        s_pos AS src_index, delta AS src_delta FROM near_view""",
    ),
)
def asof_stored(spark, sf_dir):
    """The nearest match between rows of a stored table, without an exchange."""
    return flat(tagged(stored_events(spark, sf_dir), {"src": "view"}), PAYLOAD)


@query(
    "chunk_stored",
    with_sql(
        [EV, kind_sql("click"), f"k AS (SELECT unnest(range(1, {HORIZON + 1})) AS k)",
         "c AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM click)"],
        """SELECT a.user_id, a.event_id, k::INTEGER AS k, t.event_id AS target, a.pos + k >= a.n AS padded
        FROM c a CROSS JOIN k JOIN c t ON t.user_id = a.user_id AND t.pos = least(a.pos + k, a.n - 1)""",
    ),
)
def chunk_stored(spark, sf_dir):
    """Future chunks of a stored table, without an exchange."""
    clicks = kind(stored_events(spark, sf_dir), "click").drop("event_type")
    s = Series.plan(clicks, ["user_id"], ["ts_us", "event_id"]).number("pos")
    return slots(future_chunk(s, F.col("event_id"), HORIZON, "pos").frame(), ["user_id", "event_id"])


@query(
    "asof_backward",
    with_sql(
        [EV, kind_sql("click"), kind_sql("error"), *asof_sql("error")],
        f"""SELECT b.user_id, b.event_id, b.ts_us, coalesce(b.s_id, a.s_id) AS src_event_id,
        coalesce(b.s_value, a.s_value) AS src_value,
        CASE WHEN b.s_id IS NOT NULL THEN b.s_pos WHEN a.s_id IS NOT NULL THEN -1 END AS src_index,
        coalesce(b.s_ts, a.s_ts) - b.ts_us AS src_delta,
        coalesce(b.ts_us - b.s_ts BETWEEN 0 AND {TOLERANCE}, false) AS fresh
        FROM b_error b JOIN a_error a USING (event_id)""",
    ),
)
def asof_backward(spark, sf_dir):
    out = _asof(spark, sf_dir, "error", "causal")
    return out.withColumn("fresh", fresh(F.col("src_delta"), TOLERANCE, "causal"))


@query(
    "asof_backward_strict",
    with_sql(
        [EV, kind_sql("click"), kind_sql("error"), asof_sql("error")[0]],
        """SELECT user_id, event_id, ts_us, s_id AS src_event_id, s_value AS src_value,
        coalesce(s_pos, -1) AS src_index, s_ts - ts_us AS src_delta FROM b_error""",
    ),
)
def asof_backward_strict(spark, sf_dir):
    return _asof(spark, sf_dir, "error", "causal_strict")


@query(
    "asof_tolerance_flag",
    with_sql(
        [
            EV,
            *[kind_sql(k) for k in ("click", "error", "signup")],
            *asof_sql("error"),
            *asof_sql("signup"),
        ],
        f"""SELECT user_id, l.event_id, coalesce(abs(l.delta) <= {TOLERANCE}, false) AS left_fresh,
        coalesce(abs(r.delta) <= {TOLERANCE}, false) AS right_fresh,
        coalesce(abs(l.delta) <= {TOLERANCE}, false) AND coalesce(abs(r.delta) <= {TOLERANCE}, false)
          AS pair_fresh
        FROM near_error l JOIN near_signup r USING (user_id, event_id)""",
    ),
)
def asof_tolerance_flag(spark, sf_dir):
    rows = tagged(events(spark, sf_dir), {"left": "error", "right": "signup"})
    rows = rows.select(
        "user_id",
        "event_id",
        fresh(F.col("left_delta"), TOLERANCE).alias("left_fresh"),
        fresh(F.col("right_delta"), TOLERANCE).alias("right_fresh"),
    )
    return rows.withColumn("pair_fresh", F.col("left_fresh") & F.col("right_fresh"))


@query(
    "multi_stream_align",
    with_sql(
        [
            EV,
            *[kind_sql(k) for k in ("click", "view", "purchase", "error", "signup")],
            *[c for k in ("view", "purchase", "error", "signup") for c in asof_sql(k)],
        ],
        """SELECT user_id, v.event_id, v.ts_us,
        v.s_id AS cam0_id, v.s_pos AS cam0_index, v.delta AS cam0_delta,
        p.s_id AS cam1_id, p.s_pos AS cam1_index, p.delta AS cam1_delta,
        e.s_id AS left_id, e.s_pos AS left_index, e.delta AS left_delta,
        s.s_id AS right_id, s.s_pos AS right_index, s.delta AS right_delta
        FROM near_view v JOIN near_purchase p USING (user_id, event_id)
        JOIN near_error e USING (user_id, event_id) JOIN near_signup s USING (user_id, event_id)""",
    ),
)
def multi_stream_align(spark, sf_dir):
    names = {"cam0": "view", "cam1": "purchase", "left": "error", "right": "signup"}
    rows = tagged(events(spark, sf_dir), names)
    cols = [
        c
        for n in names
        for c in (F.col(f"{n}.event_id").alias(f"{n}_id"), f"{n}_index", f"{n}_delta")
    ]
    return rows.select(*GRID, *cols)


@query(
    "equi_join_timestamp",
    with_sql(
        [EV],
        """SELECT g.user_id, g.event_id, g.ts_us, p.value IS NOT NULL AS matched,
        coalesce(p.value, 0.0) AS value FROM ev g LEFT JOIN
        (SELECT user_id, ts_us, value FROM ev WHERE value >= 10) p USING (user_id, ts_us)""",
    ),
)
def equi_join_timestamp(spark, sf_dir):
    ev = events(spark, sf_dir)
    poses = ev.filter("value >= 10").select("user_id", "ts_us", "value")
    return audit.equi_join_timestamp(
        ev.select(*GRID), poses, ["user_id"], "ts_us", ["value"], {"value": 0.0}
    )


@query(
    "equi_join_counts",
    with_sql(
        [
            EV,
            "g AS (SELECT * FROM ev WHERE event_type <> 'signup')",
            "p AS (SELECT * FROM ev WHERE value >= 10)",
        ],
        """SELECT user_id, coalesce(matched, 0) AS matched, coalesce(unmatched, 0) AS unmatched,
        coalesce(outside, 0) AS outside FROM
        (SELECT g.user_id, count(p.event_id) AS matched, count(*) - count(p.event_id) AS unmatched
         FROM g LEFT JOIN p USING (user_id, ts_us) GROUP BY 1)
        FULL JOIN (SELECT user_id, count(*) FILTER (WHERE g.event_id IS NULL) AS outside
         FROM p LEFT JOIN g USING (user_id, ts_us) GROUP BY 1) USING (user_id)""",
    ),
)
def equi_join_counts(spark, sf_dir):
    ev = events(spark, sf_dir)
    return audit.join_counts(
        ev.filter("event_type <> 'signup'"), ev.filter("value >= 10"), ["user_id"], "ts_us"
    )


@query(
    "zip_join_verify",
    with_sql(
        [EV, kind_sql("click"), kind_sql("view")],
        """SELECT user_id, rows_a, rows_b, props_mismatches, CASE WHEN rows_a <> rows_b
        THEN 'row_count' WHEN props_mismatches > 0 THEN 'props_mismatch' END AS reject_reason FROM (
        SELECT user_id, count(a.event_id) AS rows_a, count(b.event_id) AS rows_b,
        count(*) FILTER (WHERE a.props <> b.props) AS props_mismatches
        FROM click a FULL JOIN view b USING (user_id, pos) GROUP BY user_id)""",
    ),
)
def zip_join_verify(spark, sf_dir):
    ev = events(spark, sf_dir)
    a, b = [user_series(kind(ev, k), "props").number("pos").frame() for k in ("click", "view")]
    return audit.zip_join_verify(a, b, ["user_id"], "pos", ["props"])


def listed(spark, sf_dir):
    """Documents marked good, as an ordered list with dense positions."""
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    good = good.withColumns({"_all": F.lit(1), "_down": -F.col("doc_id")})
    return Series.plan(good, ["_all"], ["_down"]).number("pos").frame().select("doc_id", "pos")


LISTED = """listed AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) - 1 AS pos
  FROM labels WHERE quality = 1)"""


@query(
    "select_by_list",
    with_sql(
        [LISTED, "en AS (SELECT doc_id FROM documents WHERE lang = 'en')"],
        """SELECT doc_id, pos, CASE WHEN pos IS NULL THEN 'unlisted' WHEN en.doc_id IS NULL
        THEN 'missing' ELSE 'selected' END AS status
        FROM listed FULL JOIN en USING (doc_id)""",
    ),
)
def select_by_list(spark, sf_dir):
    catalog = table(spark, sf_dir, "documents").filter("lang = 'en'")
    return audit.select_by_list(listed(spark, sf_dir), catalog, "doc_id", "pos")


def _inventory(ev):
    return ev.groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("size"), F.max("ts_us").alias("mtime")
    )


_MIDDLE = 1_705_276_800_000_000


@query(
    "snapshot_diff",
    with_sql(
        [
            EV,
            f"""a AS (SELECT user_id, event_type, count(*) AS size, max(ts_us) AS mtime
            FROM ev WHERE ts_us < {_MIDDLE} GROUP BY ALL)""",
            "b AS (SELECT user_id, event_type, count(*) AS size, max(ts_us) AS mtime FROM ev GROUP BY ALL)",
        ],
        """SELECT user_id, event_type, CASE WHEN a.size IS NULL THEN 'added'
        WHEN b.size IS NULL THEN 'removed' ELSE 'changed' END AS change
        FROM a FULL JOIN b USING (user_id, event_type)
        WHERE a.size IS DISTINCT FROM b.size OR a.mtime IS DISTINCT FROM b.mtime""",
    ),
)
def snapshot_diff(spark, sf_dir):
    ev = events(spark, sf_dir)
    before, after = _inventory(ev.filter(F.col("ts_us") < _MIDDLE)), _inventory(ev)
    return audit.snapshot_diff(before, after, ["user_id", "event_type"], ["size", "mtime"])


_FIELDS = ["l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(
    "dataset_equivalence",
    with_sql(
        [
            "d AS (SELECT count(*) AS rows, count(*) FILTER (WHERE l_tax <> round(l_tax / 2, 4)) AS c"
            " FROM lineitem)"
        ],
        """SELECT * FROM (SELECT 'l_discount' AS field, 0::BIGINT AS different, false AS may_differ,
          rows, 0::BIGINT AS one_sided, false AS violation FROM d
        UNION ALL SELECT 'l_tax', c, true, rows, 0, false FROM d
        UNION ALL SELECT 'l_returnflag', 0, false, rows, 0, false FROM d
        UNION ALL SELECT 'l_linestatus', 0, false, rows, 0, false FROM d
        UNION ALL SELECT 'l_shipdate', 0, false, rows, 0, false FROM d)""",
    ),
)
def dataset_equivalence(spark, sf_dir):
    a = order_frames(spark, sf_dir, *_FIELDS).frame()
    b = order_frames(spark, sf_dir, *_FIELDS).frame()
    b = b.withColumn("l_tax", F.round(F.col("l_tax") / 2, 4))
    key = ["l_orderkey", *LI_ORDER]
    return audit.dataset_equivalence(a, b, key, _FIELDS, {"l_tax"})


@query(
    "episode_equivalence",
    """SELECT l_orderkey, field, different, true AS same_type, rows, one_sided, one_sided > 0 OR field <> 'l_tax' AS violation
    FROM (SELECT l_orderkey, count(*) AS rows, count(*) FILTER (WHERE gone) AS one_sided,
        unnest(['l_discount', 'l_tax', 'l_returnflag', 'l_linestatus', 'l_shipdate']) AS field,
        unnest([count(*) FILTER (WHERE NOT gone AND l_linenumber = 7),
          count(*) FILTER (WHERE NOT gone AND l_tax <> round(l_tax / 2, 4)), 0, 0, 0]) AS different
      FROM (SELECT *, l_linenumber = 6 AND l_partkey % 2 = 0 AS gone FROM lineitem) GROUP BY l_orderkey)
    WHERE different > 0 OR one_sided > 0""",
)
def episode_equivalence(spark, sf_dir):
    """A copy with halved taxes, which may differ, other discounts in line 7, and rows missing."""
    a = order_frames(spark, sf_dir, *_FIELDS).frame()
    b = order_frames(spark, sf_dir, *_FIELDS).frame().withColumns(
        {
            "l_tax": F.round(F.col("l_tax") / 2, 4),
            "l_discount": F.when(F.col("l_linenumber") == 7, F.col("l_discount") + 1).otherwise(F.col("l_discount")),
        }
    )
    b = b.filter(~((F.col("l_linenumber") == 6) & (F.col("l_partkey") % 2 == 0)))
    return audit.episode_equivalence(a, b, ["l_orderkey"], LI_ORDER, _FIELDS, {"l_tax"})


def padded_slots(n, horizon):
    """Padded slots of an episode of ``n`` rows, in closed form."""
    h = F.lit(horizon)
    full = h * (h + 1) / 2
    short = n * h - n * (n - 1) / 2
    return F.when(n >= horizon, full).otherwise(short).cast("bigint")


@query(
    "contract_totals_verify",
    with_sql(
        [LI, f"k AS (SELECT unnest(range(1, {HORIZON + 1})) AS k)"],
        f"""SELECT episodes, frames, padded_slots, real_slots, padded_slots AS declared_padded,
        true AS slots_add_up, true AS padding_agrees FROM (SELECT
        (SELECT count(DISTINCT l_orderkey) FROM li) AS episodes, (SELECT count(*) FROM li) AS frames,
        count(*) FILTER (WHERE pos + k >= n) AS padded_slots,
        count(*) FILTER (WHERE pos + k < n) AS real_slots FROM li, k)""",
    ),
)
def contract_totals_verify(spark, sf_dir):
    s = future_chunk(order_frames(spark, sf_dir), F.col("l_partkey"), HORIZON, "pos")
    episodes = s.frame().groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.size(F.filter("is_pad", lambda p: p))).alias("padded"),
        F.sum("real_slots").alias("real"),
    )
    out = episodes.agg(
        F.count(F.lit(1)).alias("episodes"),
        F.sum("n").alias("frames"),
        F.sum("padded").alias("padded_slots"),
        F.sum("real").alias("real_slots"),
        F.sum(padded_slots(F.col("n"), HORIZON)).alias("declared_padded"),
    )
    total = F.col("padded_slots") + F.col("real_slots")
    return out.withColumns(
        {
            "slots_add_up": total == F.col("frames") * HORIZON,
            "padding_agrees": F.col("padded_slots") == F.col("declared_padded"),
        }
    )


@query(
    "contract_check",
    with_sql(
        [LI, f"k AS (SELECT unnest(range(1, {HORIZON + 1})) AS k)"],
        """SELECT * FROM (SELECT 'episodes' AS name, (SELECT count(DISTINCT l_orderkey) FROM li) AS declared,
          (SELECT count(DISTINCT l_orderkey) FROM li) AS actual, 'ok' AS verdict
        UNION ALL SELECT 'frames', (SELECT count(*) + 1 FROM li), (SELECT count(*) FROM li), 'differs'
        UNION ALL SELECT 'padded_slots', (SELECT count(*) FROM li, k WHERE pos + k >= n),
          (SELECT count(*) FROM li, k WHERE pos + k >= n), 'ok'
        UNION ALL SELECT 'real_slots', NULL, (SELECT count(*) FROM li, k WHERE pos + k < n), 'undeclared'
        UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders), 'ok'
        UNION ALL SELECT 'suppliers', (SELECT count(*) FROM supplier), NULL, 'not computed')""",
    ),
)
def contract_check(spark, sf_dir):
    """A declared contract with a wrong, a missing and a superfluous entry, against the data."""
    got = contract_totals_verify(spark, sf_dir).select("episodes", "frames", "padded_slots", "real_slots")
    got = got.withColumn("orders", table(spark, sf_dir, "orders").agg(F.count(F.lit(1))).scalar())
    said = got.withColumn("frames", F.col("frames") + 1).drop("real_slots")
    said = said.withColumn("suppliers", table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar())
    return audit.contract_check(audit.as_entries(said), audit.as_entries(got))


STATUS_SQL = """cat AS (SELECT d.doc_id, d.source, d.lang, d.text, d.n_chars, l.quality, l.toxic,
  CASE WHEN l.doc_id IS NULL THEN 'pending' WHEN toxic = 1 THEN 'trashed'
  WHEN quality = 1 THEN 'kept' ELSE 'skipped' END AS status
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def catalog_status(spark, sf_dir):
    """Documents as episodes with their review status."""
    decisions = table(spark, sf_dir, "labels").withColumn("_known", F.lit(True))
    status = (
        F.when(F.col("_known").isNull(), "pending")
        .when(F.col("toxic") == 1, "trashed")
        .when(F.col("quality") == 1, "kept")
        .otherwise("skipped")
    )
    rows = table(spark, sf_dir, "documents").join(decisions, "doc_id", "left")
    return rows.withColumn("status", status).drop("_known")


@query("decision_left_join", with_sql([STATUS_SQL], "SELECT doc_id, source, status FROM cat"))
def decision_left_join(spark, sf_dir):
    return catalog_status(spark, sf_dir).select("doc_id", "source", "status")


# A translation and a rotation about x for each side.
CALIBRATION = {
    "left": (0.1, -0.2, 0.3, 0.6, 0.0, 0.0, 0.8),
    "right": (-0.1, 0.2, 0.05, 0.0, 0.0, 0.6, 0.8),
}


def calibrations(spark):
    schema = f"side string, offset {g.POSE_TYPE}"
    return spark.createDataFrame(list(CALIBRATION.items()), schema)


@query(
    "calibration_join",
    with_sql(
        [
            EM,
            """c(side, cx, cy, cz) AS (VALUES ('left', 0.1::DOUBLE, -0.2::DOUBLE, 0.3::DOUBLE),
              ('right', -0.1, 0.2, 0.05))""",
            "s AS (SELECT *, CASE WHEN label < 5 THEN 'left' ELSE 'right' END AS side FROM em)",
        ],
        "SELECT vec_id, s.side, "
        + ", ".join(
            r6_sql(f"p{a} + r{i}0*cx + r{i}1*cy + r{i}2*cz") + f" AS p{a}"
            for i, a in enumerate("xyz")
        )
        + " FROM s JOIN c ON c.side = s.side",
    ),
)
def calibration_join(spark, sf_dir):
    side = F.when(F.col("label") < 5, "left").otherwise("right")
    rows = pose_rows(spark, sf_dir).withColumn("side", side)
    rows = rows.join(F.broadcast(calibrations(spark)), "side")  # two rows, one per side
    out = g.with_pose(rows, "hand", g.compose(F.col("pose"), F.col("offset")))
    return out.select("vec_id", "side", *[r6(F.col(f"hand.p{a}")).alias(f"p{a}") for a in "xyz"])
