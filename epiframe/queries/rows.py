"""Projections, filters and validation over whole tables."""

from pyspark.sql import functions as F

from epiframe.functions.values import (
    EPISODE_ID,
    channel_of,
    crop_right_half,
    decode_packet,
    episode_id_parts,
    first_integer,
    letterbox,
    matched_flag,
    parse_flag,
    resolve_column,
    trash_name_parts,
)
from epiframe.operators import validate as val
from epiframe.operators.pose import future_chunk, slots
from epiframe.queries.base import (
    EV,
    HORIZON,
    LI,
    events,
    order_frames,
    query,
    table,
    with_sql,
)
from epiframe.queries.joins import STATUS_SQL, catalog_status
from epiframe.queries.sequence import K_SQL, props_k
from epiframe.queries.stats import DIMS, KS, ST

FRAME_COLUMNS = ["frame_number", "frame_id", "sequence_number", "event_id"]
TIME_COLUMNS = ["timestamp_ns", "mid_exposure_ns", "ts_us"]


@query(
    "resolve_column",
    with_sql([EV], "SELECT user_id, event_id AS frame, ts_us AS clock, true AS matched FROM ev"),
)
def resolve_column_rows(spark, sf_dir):
    ev = val.require_columns(events(spark, sf_dir), ["user_id", "value"])
    return ev.select(
        "user_id",
        F.col(resolve_column(ev, FRAME_COLUMNS)).alias("frame"),
        F.col(resolve_column(ev, TIME_COLUMNS)).alias("clock"),
        matched_flag(ev, "auto").alias("matched"),
    )


@query(
    "require_columns",
    with_sql([EV], "SELECT event_type, count(*) AS rows FROM ev GROUP BY 1"),
)
def require_columns(spark, sf_dir):
    header = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    rows = val.require_columns(table(spark, sf_dir, "events"), header, exact=True)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "coalesce_first_nonempty",
    with_sql(
        [EV, f"k AS (SELECT event_id, event_type, {K_SQL} AS k FROM ev)"],
        """SELECT event_id, CASE event_type WHEN 'click' THEN k WHEN 'view' THEN k
        WHEN 'error' THEN 1000 + k ELSE k END AS clock FROM k""",
    ),
)
def coalesce_first_nonempty(spark, sf_dir):
    """The first clock is blank, malformed, padded or absent, by kind of row."""
    ev = events(spark, sf_dir).withColumn("k", F.get_json_object("props", "$.k"))
    first = (
        F.when(F.col("event_type") == "click", "")
        .when(F.col("event_type") == "view", "12.x")
        .when(F.col("event_type") == "error", F.concat(F.lit(" "), (F.col("k").cast("int") + 1000).cast("string"), F.lit(" ")))
    )
    return ev.select("event_id", first_integer(first, F.col("k")).alias("clock"))


@query(
    "parse_flag",
    with_sql([EV], "SELECT event_id, event_type IN ('click', 'view') AS flag FROM ev"),
)
def parse_flag_rows(spark, sf_dir):
    words = {"click": "TRUE", "view": " yes ", "purchase": "0", "error": "False", "signup": "no"}
    word = F.coalesce(*[F.when(F.col("event_type") == k, w) for k, w in words.items()])
    return events(spark, sf_dir).select("event_id", parse_flag(word).alias("flag"))


@query(
    "unit_scale",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice * 0.001::DOUBLE AS metres,
    l_quantity / 10 AS degrees FROM lineitem""",
)
def unit_scale(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        (F.col("l_extendedprice") * 0.001).alias("metres"),
        (F.col("l_quantity") / 10).alias("degrees"),
    )


@query(
    "channel_map",
    with_sql(
        [EV],
        """SELECT event_id, CASE event_type WHEN 'error' THEN 'left' ELSE 'right' END AS side,
        CASE event_type WHEN 'error' THEN 'right' ELSE 'left' END AS source_channel
        FROM ev WHERE event_type IN ('error', 'signup')""",
    ),
)
def channel_map(spark, sf_dir):
    rows = events(spark, sf_dir).filter(F.col("event_type").isin("error", "signup"))
    rows = rows.withColumn("side", F.when(F.col("event_type") == "error", "left").otherwise("right"))
    return rows.select("event_id", "side", channel_of(F.col("side"), "swapped").alias("source_channel"))


@query(
    "validity_gate",
    with_sql(
        [EV],
        f"""SELECT event_id, {K_SQL} >= 10 AND value >= 5 AND event_type <> 'error' AS valid,
        CASE WHEN {K_SQL} >= 10 AND value >= 5 AND event_type <> 'error' THEN value END AS px FROM ev""",
    ),
)
def validity_gate(spark, sf_dir):
    checks = [props_k() >= 10, F.col("value") >= 5, F.col("event_type") != "error"]
    valid, pose = val.validity_gate(checks, F.struct(F.col("value").alias("px")))
    rows = events(spark, sf_dir).select("event_id", valid.alias("valid"), pose.alias("pose"))
    return rows.select("event_id", "valid", "pose.px")


@query(
    "decode_packets",
    with_sql(
        [EV, f"p AS (SELECT event_id, {K_SQL} AS k, unnest(range(6)) AS joint FROM ev "
         "WHERE event_type IN ('error', 'signup') AND value >= 10)"],
        "SELECT event_id, joint::INTEGER AS joint, (k * joint) / 10.0::DOUBLE AS degrees FROM p",
    ),
)
def decode_packets(spark, sf_dir):
    kind = F.when(F.col("event_type").isin("error", "signup"), "HAND_STATE_FRAME").otherwise("OTHER")
    text = F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(24)), lambda i: (i * F.col("k")).cast("string")), ";"
    )
    packets = events(spark, sf_dir).withColumn("k", props_k()).select(
        "event_id",
        kind.alias("packet_type_name"),
        F.when(F.col("value") >= 10, "full").otherwise("partial").alias("payload_status"),
        text.alias("decoded_values"),
    )
    full = packets.filter("packet_type_name = 'HAND_STATE_FRAME' AND payload_status = 'full'")
    joints = decode_packet(F.col("decoded_values"))
    return full.select("event_id", F.posexplode(joints).alias("joint", "degrees"))


_ID_SQL = (
    "ids AS (SELECT event_id, event_type, strftime(ts, '%Y%m%d_%H%M%S') || '_' || user_id || '_' || "
    f"{K_SQL} AS id FROM events)"
)


def event_ids(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("k", props_k())
    return rows.select(
        "event_id",
        "event_type",
        F.concat_ws("_", F.date_format("ts", "yyyyMMdd_HHmmss"), "user_id", "k").alias("id"),
    )


@query(
    "valid_id_filter",
    with_sql(
        [_ID_SQL],
        "SELECT event_id, id FROM ids WHERE event_type <> 'view'",
    ),
)
def valid_id_filter(spark, sf_dir):
    """Ids of view rows get a stray letter and must be refused."""
    spoiled = F.when(F.col("event_type") == "view", F.concat("id", F.lit("x"))).otherwise(F.col("id"))
    rows = event_ids(spark, sf_dir).select("event_id", spoiled.alias("id"))
    return rows.filter(F.col("id").rlike(EPISODE_ID))


@query(
    "parse_ids",
    with_sql(
        [_ID_SQL],
        """SELECT event_id, substr(id, 1, 8) AS date, substr(id, 10, 6) AS time,
        split_part(id, '_', 3) AS major, split_part(id, '_', 4) AS minor,
        id AS trash_episode, substr(md5(id), 1, 8) AS nonce FROM ids""",
    ),
)
def parse_ids(spark, sf_dir):
    stamp = F.lit("__20240131T000000.000000Z__")
    trash = F.concat("id", stamp, F.substring(F.md5("id"), 1, 8))
    rows = event_ids(spark, sf_dir).select(
        "event_id",
        episode_id_parts(F.col("id")).alias("p"),
        trash_name_parts(trash).alias("t"),
    )
    return rows.select("event_id", "p.*", F.col("t.episode").alias("trash_episode"), "t.nonce")


KINDS = ["click", "view", "purchase", "error", "signup"]


@query(
    "complete_episodes",
    with_sql(
        ["f AS (SELECT user_id, event_type, floor(value / 60)::BIGINT AS size FROM events)"],
        """SELECT user_id, concat_ws(',', """
        + ", ".join(
            f"CASE WHEN count(*) FILTER (WHERE event_type = '{k}' AND size > 0) = 0 THEN '{k}' END"
            for k in sorted(KINDS)
        )
        + ") AS missing, "
        + " AND ".join(f"count(*) FILTER (WHERE event_type = '{k}' AND size > 0) > 0" for k in KINDS)
        + " AS complete FROM f GROUP BY 1",
    ),
)
def complete_episodes(spark, sf_dir):
    files = events(spark, sf_dir).withColumn("size", F.floor(F.col("value") / 60))
    out = val.complete_episodes(files, "user_id", "event_type", "size", KINDS)
    return out.withColumn("missing", F.array_join("missing", ","))


@query(
    "quality_warning",
    with_sql(
        [STATUS_SQL],
        """SELECT doc_id, coalesce(toxic = 1, false) OR coalesce(quality = 0, false)
        OR n_chars > 10000 AS has_warning FROM cat""",
    ),
)
def quality_warning(spark, sf_dir):
    rows = catalog_status(spark, sf_dir)
    codes = F.when(F.col("toxic") == 1, F.array(F.lit("toxic")))
    warnings = F.when(F.col("n_chars") > 10000, F.array(F.lit("long")))
    overall = F.when(F.col("quality") == 1, "OK").when(F.col("quality") == 0, "degraded")
    return rows.select(
        "doc_id", val.quality_warning(codes, warnings, overall).alias("has_warning")
    )


@query(
    "status_gate",
    with_sql(
        [EV],
        f"""SELECT event_id, CASE WHEN {K_SQL} >= 90 THEN 'status_not_ok'
        WHEN value > 100 THEN 'session_mismatch' END AS reject_reason FROM ev""",
    ),
)
def status_gate(spark, sf_dir):
    status = F.when(props_k() < 90, "ok").otherwise("failed")
    episode = F.col("user_id").cast("string")
    session = F.when(F.col("value") > 100, "another").otherwise(episode)
    return events(spark, sf_dir).select(
        "event_id", val.status_gate(status, session, episode).alias("reject_reason")
    )


@query(
    "range_check",
    with_sql(
        [LI, ST],
        """SELECT dim, count(*) FILTER (WHERE x < 0 OR x > 100) AS out_of_range, 0::BIGINT AS non_finite,
        0::BIGINT AS missing, count(*) AS rows FROM st GROUP BY 1""",
    ),
)
def range_check(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.posexplode(F.array(*DIMS)).alias("dim", "x"))
    return val.range_check(rows, "dim", "x", F.lit(0.0), F.lit(100.0))


@query(
    "search_filter",
    with_sql(
        [STATUS_SQL],
        "SELECT doc_id, source, status FROM cat WHERE status = 'kept' AND contains(lower(source), 'rc1')",
    ),
)
def search_filter(spark, sf_dir):
    rows = catalog_status(spark, sf_dir).select("doc_id", "source", "status")
    return val.search_filter(rows, "keep", "RC1", "status", F.col("source"))


@query(
    "mask_filter",
    with_sql(
        [LI, KS],
        """SELECT a.l_orderkey, a.pos, k::INTEGER AS k, t.l_partkey AS target FROM li a CROSS JOIN ks
        JOIN li t ON t.l_orderkey = a.l_orderkey AND t.pos = a.pos + k""",
    ),
)
def mask_filter(spark, sf_dir):
    s = future_chunk(order_frames(spark, sf_dir), F.col("l_partkey"), HORIZON, "pos")
    rows = slots(s.frame(), ["l_orderkey", "pos"]).filter(~F.col("padded"))
    return rows.select("l_orderkey", "pos", "k", "target")


@query(
    "rejects_report",
    with_sql(
        [
            EV,
            """u AS (SELECT user_id, count(*) AS n, max(value) AS v,
              count(*) FILTER (WHERE event_type = 'view') AS views FROM ev GROUP BY 1)""",
        ],
        """SELECT user_id, CASE WHEN n < 60 THEN 'too_short' WHEN views < 10 THEN 'few_frames'
        ELSE 'out_of_range' END AS category, CASE WHEN n < 60 THEN n || ' rows'
        WHEN views < 10 THEN views || ' frames' ELSE 'value above 250' END AS message
        FROM u WHERE n < 60 OR views < 10 OR v > 250""",
    ),
)
def rejects_report(spark, sf_dir):
    users = events(spark, sf_dir).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("value").alias("v"),
        F.count_if(F.col("event_type") == "view").alias("views"),
    )
    rules = [
        ("too_short", F.col("n") < 60, F.concat(F.col("n").cast("string"), F.lit(" rows"))),
        ("few_frames", F.col("views") < 10, F.concat(F.col("views").cast("string"), F.lit(" frames"))),
        ("out_of_range", F.col("v") > 250, F.lit("value above 250")),
    ]
    return val.rejects(users, "user_id", rules)


@query(
    "media_geometry",
    with_sql(
        [
            "m AS (SELECT page_id, length(html) AS w, 2 * length(url) AS h, length(html) // 16 * 16 AS dw FROM pages)",
            "b AS (SELECT *, least(640, (960 * w + h) // (2 * h)) AS bw, least(480, (1280 * h + w) // (2 * w)) AS bh FROM m)",
        ],
        """SELECT page_id, CASE WHEN w % 4 = 0 AND h % 2 = 0 THEN w // 2 END AS crop_x,
        CASE WHEN w % 4 = 0 AND h % 2 = 0 THEN w // 2 END AS crop_w,
        CASE WHEN w % 4 = 0 AND h % 2 = 0 THEN h END AS crop_h, dw = w AS dimensions_match,
        bw AS box_w, bh AS box_h, (640 - bw) // 2 AS pad_x, (480 - bh) // 2 AS pad_y FROM b""",
    ),
)
def media_geometry(spark, sf_dir):
    """Frame sizes taken from text lengths: crop of the right half, and fit into 640 x 480."""
    w, h = F.length("html").cast("bigint"), (F.length("url") * 2).cast("bigint")
    rows = table(spark, sf_dir, "pages").select("page_id", w.alias("w"), h.alias("h"))
    declared = F.call_function("div", F.col("w"), F.lit(16)) * 16
    rows = rows.select(
        "page_id",
        crop_right_half(F.col("w"), F.col("h")).alias("c"),
        (declared == F.col("w")).alias("dimensions_match"),
        letterbox(F.col("w"), F.col("h"), 640, 480).alias("b"),
    )
    return rows.select(
        "page_id",
        F.col("c.x").alias("crop_x"),
        F.col("c.w").alias("crop_w"),
        F.col("c.h").alias("crop_h"),
        "dimensions_match",
        F.col("b.w").alias("box_w"),
        F.col("b.h").alias("box_h"),
        "b.pad_x",
        "b.pad_y",
    )


@query("content_hash", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


@query(
    "json_fields",
    with_sql(
        [EV],
        f"""SELECT event_id, {K_SQL} AS k, NULL::VARCHAR AS status, 0::INTEGER AS warnings,
        1::INTEGER AS codes FROM ev""",
    ),
)
def json_fields(spark, sf_dir):
    """Optional fields of a report; a lone value is read as a list of one."""
    fields = F.from_json("props", "k BIGINT, status STRING, warnings ARRAY<STRING>")
    lone = F.get_json_object("props", "$.k")
    codes = F.coalesce(F.from_json(lone, "ARRAY<STRING>"), F.array_compact(F.array(lone)))
    rows = events(spark, sf_dir).select("event_id", fields.alias("f"), codes.alias("c"))
    return rows.select(
        "event_id",
        "f.k",
        "f.status",
        F.size(F.coalesce("f.warnings", F.array().cast("array<string>"))).alias("warnings"),
        F.size("c").alias("codes"),
    )
