"""Sources and sinks: whole tables written in one form and read back."""

from pyspark.sql import functions as F

from epiframe.operators import audit, stats
from epiframe.operators.pose import future_chunk
from epiframe.plans.shared import new_path
from epiframe.queries.base import (
    EM,
    EV,
    HORIZON,
    LI,
    LI_ORDER,
    events,
    order_frames,
    pose_series,
    query,
    r6_sql,
    table,
    with_sql,
)
from epiframe.queries.sequence import props_k, K_SQL
from epiframe.queries.stats import DIMS
from epiframe.functions.values import r6
from epiframe.sources import readers, sinks

EVENT_SCHEMA = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING, ts_us BIGINT"
_EVENT_SQL = with_sql([EV], "SELECT event_id, user_id, event_type, value, props, ts_us FROM ev")


def event_rows(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "props", "ts_us")


@query("scan_csv", _EVENT_SQL)
def scan_csv(spark, sf_dir):
    path = new_path(spark, "events-csv")
    event_rows(spark, sf_dir).write.option("escape", '"').csv(path, header=True)
    return readers.scan_csv(spark, path, EVENT_SCHEMA)


@query(
    "scan_json_object",
    "SELECT n_nationkey::BIGINT AS n_nationkey, n_name, n_regionkey::BIGINT AS n_regionkey FROM nation",
)
def scan_json_object(spark, sf_dir):
    """Each nation as a file of its own, one JSON object over several lines."""
    path = new_path(spark, "nations-json")
    rows = table(spark, sf_dir, "nation")
    text = F.to_json(F.struct("n_nationkey", "n_name", "n_regionkey"), {"pretty": "true"})
    rows.select("n_nationkey", text.alias("value")).repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    schema = "n_nationkey BIGINT, n_name STRING, n_regionkey BIGINT"
    files = f"{path}/n_nationkey=*"
    return readers.scan_json_object(spark, files, schema)


@query("scan_jsonl", _EVENT_SQL)
def scan_jsonl(spark, sf_dir):
    path = new_path(spark, "events-jsonl")
    event_rows(spark, sf_dir).write.json(path)
    return readers.scan_jsonl(spark, path, EVENT_SCHEMA)


@query("scan_parquet_projected", "SELECT l_orderkey, l_quantity FROM lineitem")
def scan_parquet_projected(spark, sf_dir):
    return readers.scan_parquet(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity"])


@query(
    "scan_ordered_id_list",
    """SELECT row_number() OVER (ORDER BY conv_id, turn) AS line, conv_id::VARCHAR AS id,
    CASE WHEN row_number() OVER (PARTITION BY conv_id ORDER BY turn) > 1 THEN 'duplicate' END AS problem
    FROM conversations""",
)
def scan_ordered_id_list(spark, sf_dir):
    """The conversation of every turn as a list file; later turns repeat an id."""
    path = new_path(spark, "id-list")
    rows = table(spark, sf_dir, "conversations")
    rows.orderBy("conv_id", "turn").select(F.col("conv_id").cast("string")).write.text(path)
    return readers.scan_ordered_id_list(spark, path, r"^\d+$")


@query("scan_file_inventory")
def scan_file_inventory(spark, sf_dir):
    rows = readers.file_inventory(spark, sf_dir)
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("name"), "size")


@query("discover_sources")
def discover_sources(spark, sf_dir):
    rows = readers.discover_sources(spark, sf_dir, "*.parquet")
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("name"), "size")


@query(
    "scan_log_metrics",
    with_sql(
        [EV],
        """SELECT count(*) AS steps, max(event_id) AS last_step, max_by(value / 20, event_id) AS last_loss,
        0::BIGINT AS non_finite, count(*) FILTER (WHERE event_id >= 50 AND value / 20 >= 5) AS too_high,
        false AS traceback FROM ev WHERE event_type <> 'signup'""",
    ),
)
def scan_log_metrics(spark, sf_dir):
    """A log with one line per event; lines of signup events carry no metric."""
    path = new_path(spark, "log")
    metric = F.concat(
        F.lit("Step "), F.col("event_id").cast("string"), F.lit(": grad=1.0, loss="),
        (F.col("value") / 20).cast("string"), F.lit(", lr=0.1"),
    )
    line = F.when(F.col("event_type") == "signup", "saving").otherwise(metric)
    events(spark, sf_dir).orderBy("event_id").select(line.alias("value")).write.text(path)
    return readers.scan_log_metrics(readers.ordered_lines(spark, path))


@query(
    "sink_episode_parquet",
    with_sql(
        [LI],
        f"""SELECT l_linenumber, count(*) AS rows, sum(l_partkey)::BIGINT AS partkeys,
        sum(greatest(0, {HORIZON} - (n - 1 - pos)))::BIGINT AS padded FROM li GROUP BY 1""",
    ),
)
def sink_episode_parquet(spark, sf_dir):
    """Chunks written in one folder per line number and read back."""
    s = future_chunk(order_frames(spark, sf_dir), F.col("l_partkey"), HORIZON, "pos")
    path = new_path(spark, "samples")
    rows = s.frame().select("l_linenumber", "l_orderkey", "pos", "l_partkey", "chunk", "is_pad")
    sinks.write_episodes(rows, path, "l_linenumber", "l_orderkey")
    back = spark.read.schema(rows.schema).parquet(path)
    return back.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("l_partkey").alias("partkeys"),
        F.sum(F.size(F.filter("is_pad", lambda p: p))).alias("padded"),
    )


@query(
    "sink_csv_exact",
    with_sql([EM], "SELECT count(*) AS rows, 0::BIGINT AS lost, 0::BIGINT AS gained FROM em"),
)
def sink_csv_exact(spark, sf_dir):
    rows = pose_series(spark, sf_dir).frame().select("label", "vec_id", "pose.*")
    return sinks.write_csv_exact(rows, new_path(spark, "poses-csv"))


@query(
    "sink_json_audit",
    """SELECT '{"flag":"' || l_returnflag || '","note":null,"rows":' || count(*) || '}' AS line
    FROM lineitem GROUP BY l_returnflag""",
)
def sink_json_audit(spark, sf_dir):
    path = new_path(spark, "audit")
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(None).cast("string").alias("note")
    )
    sinks.write_json_audit(rows, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


ACTIONS = {"click": "keep", "view": "skip", "purchase": "trash", "error": "restore"}
ACTION_SCHEMA = "action STRING, id BIGINT, done_at BIGINT, seq BIGINT"


def action_rows(spark, sf_dir):
    """Events as review actions on users; signup events are none."""
    action = F.coalesce(*[F.when(F.col("event_type") == k, a) for k, a in ACTIONS.items()])
    return events(spark, sf_dir).filter("event_type <> 'signup'").select(
        action.alias("action"),
        F.col("user_id").alias("id"),
        F.col("ts_us").alias("done_at"),
        F.col("event_id").alias("seq"),
    )


ACTION_SQL = (
    "ac AS (SELECT CASE event_type "
    + " ".join(f"WHEN '{k}' THEN '{a}'" for k, a in ACTIONS.items())
    + " END AS action, user_id AS id, ts_us AS done_at, event_id AS seq FROM ev WHERE event_type <> 'signup')"
)


@query("sink_append_log", with_sql([EV, ACTION_SQL], "SELECT action, id, done_at, seq FROM ac"))
def sink_append_log(spark, sf_dir):
    path = new_path(spark, "log")
    rows = action_rows(spark, sf_dir)
    sinks.append_log(rows.filter("action IN ('keep', 'skip')"), path)
    sinks.append_log(rows.filter("action NOT IN ('keep', 'skip')"), path)
    return readers.scan_jsonl(spark, path, ACTION_SCHEMA)


@query(
    "sink_write_once",
    "SELECT true AS first_write, false AS second_write, count(*) AS rows FROM events",
)
def sink_write_once(spark, sf_dir):
    path = new_path(spark, "once")
    rows = event_rows(spark, sf_dir)
    first, second = sinks.write_once(rows, path), sinks.write_once(rows, path)
    return spark.read.parquet(path).agg(
        F.lit(first).alias("first_write"),
        F.lit(second).alias("second_write"),
        F.count(F.lit(1)).alias("rows"),
    )


@query(
    "declare_feature_schema",
    """SELECT unnest(['state', 'action', 'action_is_pad']) AS feature,
    unnest([n, 0, 0]) AS violations, rows
    FROM (SELECT count(*) AS rows, count(*) FILTER (WHERE l_linenumber = 7) AS n FROM lineitem)""",
)
def declare_feature_schema(spark, sf_dir):
    """States of line 7 are one channel short; actions are padded to their shape and pass."""
    s = order_frames(spark, sf_dir, *DIMS).with_columns({"state": F.array(*DIMS)})
    s = future_chunk(s, F.col("state"), HORIZON, "pos")
    short = F.when(F.col("l_linenumber") == 7, F.slice("state", 1, len(DIMS) - 1)).otherwise(F.col("state"))
    rows = s.frame().select(
        short.alias("state"), F.col("chunk").alias("action"), F.col("is_pad").alias("action_is_pad")
    )
    return sinks.shape_violations(rows, sinks.feature_shapes(len(DIMS), HORIZON, 640, 480))


_SPOILED = {
    "state": ("array<float>", "array<float>", "4", "4", "count(*) FILTER (WHERE l_linenumber = 7)"),
    "action": ("array<array<float>>", "array<array<float>>", "3x4", "3x4", "count(*) FILTER (WHERE l_linenumber = 6)"),
    "action_is_pad": ("array<boolean>", "array<boolean>", "3", "3", "0"),
    "pose_timestamp": ("bigint", "double", "1", "1", "count(*)"),
    "frame_index": ("bigint", "int", "1", "1", "count(*)"),
    "timestamp": ("float", "float", "1", "1", "count(*) FILTER (WHERE l_linenumber = 5)"),
    "index": ("bigint", "bigint", "1", "2", "0"),
    "task_index": ("bigint", None, "1", None, "count(*)"),
}


def _contract_sql():
    def text(v):
        return "NULL" if v is None else f"'{v}'"

    rows = []
    for name in sinks.sample_schema().fieldNames():
        kind, stored, shape, kept, broken = _SPOILED.get(name, ("bigint", "bigint", "1", "1", "0"))
        rows.append(
            f"SELECT '{name}' AS feature, '{kind}' AS declared_type, {text(stored)} AS stored_type, '{shape}' AS declared_shape, "
            f"{text(kept)} AS stored_shape, ({broken})::BIGINT AS violations, count(*) AS rows FROM lineitem"
        )
    return " UNION ALL ".join(rows)


@query("feature_contract", _contract_sql())
def feature_contract(spark, sf_dir):
    """All 17 features written with their declaration and read back: some are of another type,
    shape or size, some values are null, and one feature is absent."""
    s = order_frames(spark, sf_dir, *DIMS).with_columns({"state": F.array(*DIMS).cast("array<float>")})
    rows = future_chunk(s, F.col("state"), HORIZON, "pos").frame()

    def line(n, spoiled, right):
        return F.when(F.col("l_linenumber") == n, spoiled).otherwise(right)

    flat = {
        "state": line(7, F.slice("state", 1, len(DIMS) - 1), F.col("state")),
        "action": line(6, F.transform("chunk", lambda v: F.slice(v, 1, len(DIMS) - 1)), F.col("chunk")),
        "action_is_pad": F.col("is_pad"),
        "pose_timestamp": F.col("pos").cast("double"),
        "frame_index": F.col("pos").cast("int"),
        "timestamp": line(5, F.lit(None), F.col("pos")).cast("float"),
    }
    schema = sinks.declared(sinks.sample_schema(), sinks.feature_shapes(len(DIMS), HORIZON, 640, 480))
    names = [n for n in schema.fieldNames() if n != "task_index"]
    rows = rows.select(*[flat.get(n, F.col("pos").cast("bigint")).alias(n) for n in names])
    rows = sinks.with_declaration(rows, schema)
    rows = rows.withColumn("index", F.col("index").alias("index", metadata={"shape": [2]}))
    path = new_path(spark, "samples")
    rows.write.parquet(path)
    return sinks.contract_violations(spark.read.parquet(path), schema)


MANIFEST_SQL = """WITH f AS (SELECT event_type, event_id % 3 AS part, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT CASE event_type WHEN 'view' THEN 'size' WHEN 'error' THEN 'sha256' WHEN 'signup' THEN 'unlisted'
      ELSE 'ok' END AS verdict, count(*) AS files, sum(n)::BIGINT AS rows FROM f GROUP BY 1
    UNION ALL SELECT unnest(['missing', 'outside']), unnest([2, 1]), NULL"""


def manifest_verdicts(spark, sf_dir, leaf=None):
    """Events written as files, listed with their hashes, and checked against a spoiled list.

    A file holds the events of one type and a third of the ids.
    """
    path = new_path(spark, "manifest")
    rows = event_rows(spark, sf_dir)
    rows = rows.withColumn("part", F.col("event_id") % 3)
    rows.repartition("event_type", "part").write.partitionBy("event_type", "part").parquet(path)
    listed = new_path(spark, "listed")
    sinks.file_manifest(spark, path, leaf=leaf).write.parquet(listed)
    rows = spark.read.parquet(listed)

    def of(kind):
        return F.contains("path", F.lit(f"event_type={kind}/"))

    spoiled = rows.filter(~of("signup")).withColumns(
        {
            "size": F.when(of("view"), F.col("size") + 1).otherwise(F.col("size")),
            "sha256": F.when(of("error"), F.lit("0")).otherwise(F.col("sha256")),
        }
    )
    extra = [(f"{path}/{n}.parquet", 1, "0") for n in ("nothing", "more")] + [(f"/other{path}/a.parquet", 1, "0")]
    spoiled = spoiled.unionByName(spark.createDataFrame(extra, "path string, size bigint, sha256 string"))
    checked = sinks.manifest_verify(spark, spoiled, path, leaf=leaf)
    held = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    held = held.withColumn("path", sinks.plain_path(F.col("path")))
    checked = checked.withColumn("path", sinks.plain_path(F.col("path"))).join(held, "path", "left")
    return checked.groupBy("verdict").agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows"))


@query("manifest_verify", MANIFEST_SQL)
def manifest_verify(spark, sf_dir):
    return manifest_verdicts(spark, sf_dir)


@query("manifest_verify_tree", MANIFEST_SQL)
def manifest_verify_tree(spark, sf_dir):
    """The same with files read in ranges by several tasks."""
    return manifest_verdicts(spark, sf_dir, leaf=1 << 14)


_HALF = "round(l_tax / 2, 4)"


@query(
    "patch_columns",
    f"""SELECT 'l_tax' AS field, count(*) AS rows, count(*) FILTER (WHERE l_tax <> {_HALF}) AS different,
    false AS violation, min({_HALF}) AS min, max({_HALF}) AS max, {r6_sql(f'avg({_HALF})')} AS mean,
    {r6_sql(f'stddev_pop({_HALF})')} AS std FROM lineitem
    UNION ALL SELECT 'l_discount', count(*), 0, false, min(l_discount), max(l_discount),
    round(avg(l_discount), 5) + 0.0, round(stddev_pop(l_discount), 5) + 0.0 FROM lineitem
    UNION ALL SELECT unnest(['l_returnflag', 'l_linestatus', 'l_shipdate']), n, 0, false, NULL, NULL, NULL, NULL
    FROM (SELECT count(*) AS n FROM lineitem)""".replace(
        r6_sql(f"avg({_HALF})"), f"round(avg({_HALF}), 5) + 0.0"
    ).replace(r6_sql(f"stddev_pop({_HALF})"), f"round(stddev_pop({_HALF}), 5) + 0.0"),
)
def patch_columns(spark, sf_dir):
    """A new version with one column replaced, its statistics, and proof the rest is unchanged."""
    numbers = ["l_tax", "l_discount"]
    fields = [*numbers, "l_returnflag", "l_linestatus", "l_shipdate"]
    old = order_frames(spark, sf_dir, *fields).frame().drop("pos")
    path = new_path(spark, "patched")
    sinks.write_once(old.withColumn("l_tax", F.round(F.col("l_tax") / 2, 4)), path)
    new = spark.read.parquet(path)
    key = ["l_orderkey", *LI_ORDER]
    proof = audit.dataset_equivalence(old, new, key, fields, {"l_tax"})
    named = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("x")) for f in numbers])
    long = new.select(F.inline(named))
    fresh = stats.scalar_stats(long, ["field"], "x")
    out = proof.join(fresh, "field", "left").select(
        "field", "rows", "different", "violation", "min", "max", "mean", "std"
    )
    return out.withColumns({c: F.round(c, 5) + 0.0 for c in ("mean", "std")})
