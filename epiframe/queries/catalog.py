"""Ordering, paging, set operations and merges over catalogs."""

from pyspark.sql import functions as F

from epiframe.operators import audit
from epiframe.operators import validate as val
from epiframe.plans.series import Series
from epiframe.queries.base import EV, events, query, table, with_sql
from epiframe.queries.joins import LISTED, STATUS_SQL, catalog_status, listed


@query(
    "ordered_listing",
    """SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS by_name,
    row_number() OVER (ORDER BY turn DESC, conv_id) - 1 AS newest_first FROM conversations""",
)
def ordered_listing(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.lit(1).alias("_all"), (-F.col("turn")).alias("_down")
    )
    by_name = Series.plan(rows, ["_all"], ["conv_id", "turn"]).number("by_name").frame()
    newest = Series.plan(by_name, ["_all"], ["_down", "conv_id"]).number("newest_first").frame()
    return newest.select("conv_id", "turn", "by_name", "newest_first")


@query(
    "page",
    with_sql(
        [STATUS_SQL],
        """SELECT doc_id, status, (SELECT count(*) FROM cat WHERE status = 'pending') AS total
        FROM cat WHERE status = 'pending' ORDER BY doc_id LIMIT 20 OFFSET 40""",
    ),
)
def page(spark, sf_dir):
    rows = catalog_status(spark, sf_dir).select("doc_id", "status", "source")
    rows = val.search_filter(rows, "pending", "", "status", F.col("source")).drop("source")
    return val.page(rows, ["doc_id"], 3, 20)


@query(
    "page_after",
    with_sql(
        [STATUS_SQL],
        """SELECT source, doc_id, status FROM cat WHERE (source, doc_id) > ('src1', 20)
        ORDER BY source, doc_id LIMIT 20""",
    ),
)
def page_after(spark, sf_dir):
    rows = catalog_status(spark, sf_dir).select("source", "doc_id", "status")
    return val.page_after(rows, ["source", "doc_id"], ["src1", 20], 20)


@query(
    "seeded_pick",
    "SELECT arg_min(user_id, md5('17:' || user_id)) AS user_id FROM events",
)
def seeded_pick(spark, sf_dir):
    return val.seeded_pick(events(spark, sf_dir).select("user_id"), "user_id", 17)


_REAL_SQL = (
    "pt AS (SELECT url, regexp_replace(regexp_replace(regexp_replace(url, '^https?://', ''), "
    "'[?#].*$', ''), '/$', '') AS path FROM pages)"
)


def page_paths(spark, sf_dir):
    """Pages as entries of a directory tree; the path is the address without its extras."""
    path = F.regexp_replace("url", r"^https?://", "")
    path = F.regexp_replace(F.regexp_replace(path, r"[?#].*$", ""), r"/$", "")
    return table(spark, sf_dir, "pages").select("url", path.alias("path"))


@query(
    "union_dedup",
    with_sql(
        [_REAL_SQL],
        """SELECT path, min(url) AS url FROM (SELECT * FROM pt WHERE path LIKE '%/en/%'
        UNION ALL SELECT * FROM pt WHERE path LIKE 'm.%') GROUP BY path""",
    ),
)
def union_dedup(spark, sf_dir):
    rows = page_paths(spark, sf_dir)
    matches = rows.filter(F.col("path").like("%/en/%")).unionByName(
        rows.filter(F.col("path").like("m.%"))
    )
    return matches.groupBy("path").agg(F.min("url").alias("url"))


@query(
    "partition_check",
    with_sql(
        [LISTED, "j AS (SELECT listed.*, toxic FROM listed JOIN labels USING (doc_id))"],
        """SELECT count(*) AS original, count(*) FILTER (WHERE toxic = 0) AS selected,
        count(*) FILTER (WHERE toxic = 1) AS excluded, 0::BIGINT AS in_both, 0::BIGINT AS in_neither,
        0::BIGINT AS unknown, 0::BIGINT AS repeated, 0::BIGINT AS order_breaks FROM j""",
    ),
)
def partition_check(spark, sf_dir):
    marks = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    rows = listed(spark, sf_dir).join(marks, "doc_id")
    return audit.partition_check(
        rows, rows.filter("toxic = 0"), rows.filter("toxic = 1"), "doc_id", "pos"
    )


@query(
    "inventory_minus",
    with_sql(
        [EV],
        """SELECT DISTINCT user_id, event_type FROM ev EXCEPT
        SELECT DISTINCT user_id, event_type FROM ev WHERE value > 200 EXCEPT
        SELECT DISTINCT user_id, event_type FROM ev WHERE event_type = 'signup'""",
    ),
)
def inventory_minus(spark, sf_dir):
    """Files of the original dataset that were neither changed nor are metadata."""
    ev = events(spark, sf_dir)
    key = ["user_id", "event_type"]
    original = ev.select(*key)
    changed = ev.filter("value > 200").select(*key)
    metadata = ev.filter("event_type = 'signup'").select(*key)
    return original.subtract(changed).subtract(metadata)


_MERGE = [
    _REAL_SQL,
    "en AS (SELECT DISTINCT path, split_part(path, '/', -1) AS name FROM pt)",
    "ex AS (SELECT doc_id::VARCHAR AS name FROM documents WHERE lang <> 'en')",
    """rk AS (SELECT en.*, ex.name IS NOT NULL AS there,
      row_number() OVER (PARTITION BY en.name ORDER BY path) - 1 AS r FROM en LEFT JOIN ex USING (name))""",
]


def _merge_sql(outcome):
    return with_sql(
        _MERGE,
        f"""SELECT path, name, CASE WHEN there OR r > 0 THEN '{outcome}' ELSE 'placed' END AS outcome,
        CASE WHEN there OR r > 0 THEN NULL ELSE name END AS target FROM rk""",
    )


def merge_of(spark, sf_dir, policy):
    entries = page_paths(spark, sf_dir).select("path").distinct()
    existing = table(spark, sf_dir, "documents").filter("lang <> 'en'")
    existing = existing.select(F.col("doc_id").cast("string").alias("name"))
    return audit.merge_plan(entries, existing, "path", policy)


@query("merge_conflict_error", _merge_sql("error"))
def merge_conflict_error(spark, sf_dir):
    return merge_of(spark, sf_dir, "error")


@query("merge_conflict_skip", _merge_sql("skipped"))
def merge_conflict_skip(spark, sf_dir):
    return merge_of(spark, sf_dir, "skip")


@query(
    "merge_conflict_rename",
    with_sql(
        _MERGE,
        """SELECT path, name, CASE WHEN there OR r > 0 THEN 'renamed' ELSE 'placed' END AS outcome,
        CASE WHEN there OR r > 0 THEN regexp_extract(name, '^(.+?)(\\.[^.]*)?$', 1) || '__' ||
        (r + CASE WHEN there THEN 1 ELSE 0 END) || regexp_extract(name, '^(.+?)(\\.[^.]*)?$', 2)
        ELSE name END AS target FROM rk""",
    ),
)
def merge_conflict_rename(spark, sf_dir):
    return merge_of(spark, sf_dir, "rename")


@query(
    "merge_outcomes",
    with_sql(
        _MERGE,
        """SELECT CASE WHEN there OR r > 0 THEN 'skipped' ELSE 'placed' END AS outcome,
        count(*) AS entries FROM rk GROUP BY 1""",
    ),
)
def merge_outcomes(spark, sf_dir):
    rows = merge_of(spark, sf_dir, "skip")
    return rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("entries"))


@query(
    "nested_entries",
    with_sql(
        [
            _REAL_SQL,
            """en AS (SELECT DISTINCT path FROM pt UNION
              SELECT DISTINCT split_part(path, '/', 1) || '/fr' FROM pt)""",
        ],
        """SELECT i.path AS "inner", o.path AS "outer" FROM en i JOIN en o
        ON starts_with(i.path, o.path || '/')""",
    ),
)
def nested_entries(spark, sf_dir):
    paths = page_paths(spark, sf_dir).select("path")
    folders = paths.select(F.concat(F.split_part("path", F.lit("/"), F.lit(1)), F.lit("/fr")).alias("path"))
    return audit.nested_entries(paths.unionByName(folders).distinct(), "path")
