"""Dataset audits: verified joins, inventories, equivalence, contracts and digests."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.plans.series import Series


def equi_join_timestamp(
    grid: DataFrame, poses: DataFrame, keys: list[str], ts: str, values: list[str], defaults: dict
) -> DataFrame:
    """Left join on the exact instant. A repeated instant on the right is an error.

    Rows without a match get ``defaults`` and ``matched`` false. The right side is merged
    on the join key first, so the join needs no further exchange for it.
    """
    once = poses.groupBy(*keys, ts).agg(
        F.count(F.lit(1)).alias("_copies"), F.first(F.struct(*values)).alias("_row")
    )
    message = F.concat(F.lit("duplicate instant "), F.col(ts).cast("string"))
    checked = once.withColumn(
        "_row",
        F.when(F.col("_copies") == 1, F.col("_row")).otherwise(
            F.raise_error(message).cast(once.schema["_row"].dataType)
        ),
    ).drop("_copies")
    out = grid.join(checked, [*keys, ts], "left")
    return out.select(
        *grid.columns,
        F.col("_row").isNotNull().alias("matched"),
        *[F.coalesce(F.col(f"_row.{v}"), F.lit(defaults[v])).alias(v) for v in values],
    )


def join_counts(grid: DataFrame, poses: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Per key: grid rows with and without a pose, and poses outside the grid."""
    a = grid.select(*keys, ts, F.lit(1).alias("_g"), F.lit(0).alias("_p"))
    b = poses.select(*keys, ts, F.lit(0).alias("_g"), F.lit(1).alias("_p"))
    at = a.unionByName(b).groupBy(*keys, ts).agg(
        F.sum("_g").alias("_g"), F.max("_p").alias("_p"), F.sum("_p").alias("_np")
    )
    return at.groupBy(*keys).agg(
        F.sum(F.col("_g") * F.col("_p")).alias("matched"),
        F.sum(F.col("_g") * (1 - F.col("_p"))).alias("unmatched"),
        F.sum(F.when(F.col("_g") == 0, F.col("_np")).otherwise(0)).alias("outside"),
    )


def zip_join_verify(
    a: DataFrame, b: DataFrame, keys: list[str], pos: str, equal: list[str]
) -> DataFrame:
    """Two files joined by row position must have equal length and equal ``equal`` columns."""
    left = a.select(*keys, pos, F.struct(*equal).alias("_a"))
    right = b.select(*keys, pos, F.struct(*equal).alias("_b"))
    both = left.join(right, [*keys, pos], "full")
    out = both.groupBy(*keys).agg(
        F.count("_a").alias("rows_a"),
        F.count("_b").alias("rows_b"),
        *[
            F.count_if(
                F.col("_a").isNotNull()
                & F.col("_b").isNotNull()
                & ~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}"))
            ).alias(f"{c}_mismatches")
            for c in equal
        ],
    )
    reason = F.when(F.col("rows_a") != F.col("rows_b"), "row_count")
    for c in equal:
        reason = reason.when(F.col(f"{c}_mismatches") > 0, f"{c}_mismatch")
    return out.withColumn("reject_reason", reason)


def select_by_list(listed: DataFrame, catalog: DataFrame, key: str, pos: str) -> DataFrame:
    """``selected`` rows carry their list position; ``missing`` and ``unlisted`` are reported."""
    known = catalog.select(key, F.lit(True).alias("_known"))
    out = listed.select(key, pos).join(known, key, "full")
    status = (
        F.when(F.col(pos).isNull(), "unlisted").when(F.col("_known").isNull(), "missing")
    ).otherwise("selected")
    return out.select(key, pos, status.alias("status"))


def snapshot_diff(a: DataFrame, b: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Entries added, removed or changed between two inventories; empty if they are equal."""
    left = a.select(*key, F.struct(*fields).alias("_a"))
    right = b.select(*key, F.struct(*fields).alias("_b"))
    change = (
        F.when(F.col("_a").isNull(), "added")
        .when(F.col("_b").isNull(), "removed")
        .when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    )
    both = left.join(right, key, "full").withColumn("change", change).filter("change IS NOT NULL")
    return both.select(*key, "change")


def dataset_equivalence(
    a: DataFrame, b: DataFrame, key: list[str], fields: list[str], may_differ: set[str]
) -> DataFrame:
    """One row per field: rows compared and different, and whether that breaks the contract."""
    left = a.select(*key, F.struct(*fields).alias("_a"))
    right = b.select(*key, F.struct(*fields).alias("_b"))
    both = left.join(right, key, "full")
    one_side = F.col("_a").isNull() | F.col("_b").isNull()
    facts = [F.count(F.lit(1)).alias("rows"), F.count_if(one_side).alias("one_sided")]
    for f in fields:
        differ = ~one_side & ~F.col(f"_a.{f}").eqNullSafe(F.col(f"_b.{f}"))
        facts.append(F.count_if(differ).alias(f"_d_{f}"))
    total = both.agg(*facts)
    entries = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"_d_{f}").alias("different"),
                F.lit(f in may_differ).alias("may_differ"),
            )
            for f in fields
        ]
    )
    out = total.select("rows", "one_sided", F.explode(entries).alias("_e"))
    broken = (F.col("one_sided") > 0) | ((F.col("_e.different") > 0) & ~F.col("_e.may_differ"))
    return out.select("_e.*", "rows", "one_sided", broken.alias("violation"))


def episode_equivalence(
    a: DataFrame, b: DataFrame, episode: list[str], key: list[str], fields: list[str], may_differ: set[str]
) -> DataFrame:
    """One row per episode and field that differ in value, type or presence of rows.

    Empty if the datasets are equivalent but for the fields that may differ, whose rows
    have ``violation`` false.
    """
    kinds = {f: (a.schema[f].dataType, b.schema[f].dataType) for f in fields}
    left = a.select(*episode, *key, F.struct(*fields).alias("_a"))
    right = b.select(*episode, *key, F.struct(*fields).alias("_b"))
    both = left.join(right, [*episode, *key], "full")
    one_side = F.col("_a").isNull() | F.col("_b").isNull()
    facts = [F.count(F.lit(1)).alias("rows"), F.count_if(one_side).alias("one_sided")]
    for f in fields:
        same = kinds[f][0] == kinds[f][1]
        equal = F.col(f"_a.{f}").eqNullSafe(F.col(f"_b.{f}")) if same else F.lit(False)
        facts.append(F.count_if(~one_side & ~equal).alias(f"_d_{f}"))
    entry = [
        F.struct(
            F.lit(f).alias("field"),
            F.col(f"_d_{f}").alias("different"),
            F.lit(kinds[f][0] == kinds[f][1]).alias("same_type"),
            F.lit(f in may_differ).alias("_may"),
        )
        for f in fields
    ]
    out = both.groupBy(*episode).agg(*facts).select(*episode, "rows", "one_sided", F.inline(F.array(*entry)))
    out = out.filter((F.col("different") > 0) | (F.col("one_sided") > 0))
    return out.withColumn("violation", (F.col("one_sided") > 0) | ~F.col("_may")).drop("_may")


def spans_check(spans: DataFrame | Series, index: str, start: str, length: str) -> DataFrame:
    """One row: is a declared list of spans dense from zero, by its own index and by rows?

    ``index_breaks`` counts entries whose index is not one above the entry before (or not
    zero at first), ``start_breaks`` those that do not begin where the entry before ends.
    Entries are taken by index and start; a series, which has one key, in its own order.
    """
    if isinstance(spans, Series):
        s = spans
    else:
        s = Series.plan(spans.select(index, start, length, F.lit(1).alias("_all")), ["_all"], [index, start])
    s = s.shift({"_i": F.col(index), "_end": F.col(start) + F.col(length)})
    at = F.coalesce(F.col("_i") + 1, F.lit(0))
    return s.frame().agg(
        F.count(F.lit(1)).alias("spans"),
        F.sum(length).alias("rows"),
        F.count_if(~F.col(index).eqNullSafe(at)).alias("index_breaks"),
        F.count_if(~F.col(start).eqNullSafe(F.coalesce("_end", F.lit(0)))).alias("start_breaks"),
    )


def as_entries(row: DataFrame) -> DataFrame:
    """A one-row table of numbers as (name, value)."""
    each = [F.struct(F.lit(c).alias("name"), F.col(c).cast("bigint").alias("value")) for c in row.columns]
    return row.select(F.inline(F.array(*each)))


def contract_check(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """One row per entry of either table (name, value): ok, differs, undeclared, not computed."""
    left, right = declared.select("name", F.col("value").alias("declared")), actual.select("name", F.col("value").alias("actual"))
    both = left.withColumn("_d", F.lit(True)).join(right.withColumn("_a", F.lit(True)), "name", "full")
    verdict = (
        F.when(F.col("_d").isNull(), "undeclared")
        .when(F.col("_a").isNull(), "not computed")
        .when(F.col("declared").eqNullSafe(F.col("actual")), "ok")
        .otherwise("differs")
    )
    return both.select("name", "declared", "actual", verdict.alias("verdict"))


def partition_check(
    original: DataFrame, selected: DataFrame, excluded: DataFrame, key: str, pos: str
) -> DataFrame:
    """One row: is ``selected`` plus ``excluded`` an exact, ordered partition of ``original``?"""

    def tagged(df, is_original, is_selected, is_excluded):
        at = F.col(pos).cast("bigint")
        null = F.lit(None).cast("bigint")
        return df.select(
            key,
            F.lit(is_original).alias("_no"),
            F.lit(is_selected).alias("_ns"),
            F.lit(is_excluded).alias("_nx"),
            (at if is_original else null).alias("_o"),
            (at if is_selected else null).alias("_s"),
        )

    ids = (
        tagged(original, 1, 0, 0)
        .unionByName(tagged(selected, 0, 1, 0))
        .unionByName(tagged(excluded, 0, 0, 1))
        .groupBy(key)
        .agg(
            F.sum("_no").alias("_no"),
            F.sum("_ns").alias("_ns"),
            F.sum("_nx").alias("_nx"),
            F.min("_o").alias("_o"),
            F.min("_s").alias("_s"),
        )
    )
    kept = ids.filter("_s IS NOT NULL AND _o IS NOT NULL").withColumn("_all", F.lit(1))
    steps = Series.plan(kept, ["_all"], ["_s"]).shift({"_before": F.col("_o")}).frame()
    breaks = steps.agg(F.count_if(F.col("_o") <= F.col("_before")))
    used = F.col("_ns") + F.col("_nx")
    return ids.agg(
        F.sum("_no").alias("original"),
        F.sum("_ns").alias("selected"),
        F.sum("_nx").alias("excluded"),
        F.count_if((F.col("_ns") > 0) & (F.col("_nx") > 0)).alias("in_both"),
        F.count_if((F.col("_no") > 0) & (used == 0)).alias("in_neither"),
        F.count_if((F.col("_no") == 0) & (used > 0)).alias("unknown"),
        F.count_if(F.greatest("_no", "_ns", "_nx") > 1).alias("repeated"),
    ).withColumn("order_breaks", breaks.scalar())


def nested_entries(entries: DataFrame, path: str) -> DataFrame:
    """Entries that lie inside another entry, with the nearest such ancestor.

    Each path names its own few ancestors, which are joined back to the entries; no pair
    of paths is compared otherwise.
    """
    parts = F.split(F.col(path), "/")
    levels = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(parts) - 1))
    above = entries.filter(F.size(parts) > 1).select(
        F.col(path).alias("inner"),
        F.explode(F.transform(levels, lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("outer"),
    )
    hits = above.join(entries.select(F.col(path).alias("outer")).distinct(), "outer")
    return hits.groupBy("inner").agg(F.max_by("outer", F.length("outer")).alias("outer"))


def require_separate(source: str, target: str) -> None:
    """A merge must not write into what it reads: the target is neither the source nor in it."""
    a, b = (re.sub(r"/+", "/", re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:", "", p)).rstrip("/") for p in (source, target))
    if a == b:
        raise ValueError("the source is the target")
    if b.startswith(a + "/"):
        raise ValueError("the target lies inside the source")


def merge_plan(
    entries: DataFrame, existing: DataFrame, path: str, policy: str, directory: Column | None = None
) -> DataFrame:
    """Bring entries into one namespace by their last path part.

    The first entry of a name in path order takes it, unless it exists already. Others are
    conflicts: reported (``error``), left out (``skip``) or given the lowest free
    ``stem__n`` (``rename``), before the suffix of a file; an entry that is a ``directory``
    keeps its whole name before the number. A number is free if neither an existing name nor the own name
    of any entry has it. Columns: path, name, outcome, target.
    """
    if policy not in ("error", "skip", "rename"):
        raise ValueError(f"unsupported conflict policy {policy}")
    name = F.element_at(F.split(F.col(path), "/"), -1)
    # existing names come first within a name, so one scan tells both facts about an entry
    whole = F.lit(False) if directory is None else F.coalesce(directory, F.lit(False))
    rows = entries.select(path, name.alias("name"), F.lit(1).alias("_entry"), whole.alias("_dir")).unionByName(
        existing.select(F.lit("").alias(path), "name", F.lit(0).alias("_entry"), F.lit(False).alias("_dir")).distinct()
    )
    s = Series.plan(rows, ["name"], ["_entry", path]).cumulate(
        {"_there": 1 - F.col("_entry"), "_nth": F.col("_entry")}
    )
    rank = F.col("_nth") - 1
    conflict = F.when(F.col("_there") > 0, rank).when(rank > 0, rank - 1)
    rows = s.frame().filter("_entry = 1").withColumn("_conflict", conflict)
    free = rows.filter("_conflict IS NULL").select(
        path, "name", F.lit("placed").alias("outcome"), F.col("name").alias("target")
    )
    clash = rows.filter("_conflict IS NOT NULL")
    if policy != "rename":
        outcome = "error" if policy == "error" else "skipped"
        none = F.lit(None).cast("string")
        clash = clash.select(path, "name", F.lit(outcome).alias("outcome"), none.alias("target"))
        return free.unionByName(clash)

    # own numbers: names of the form stem__n.suffix use up n for stem.suffix
    used = existing.select("name").unionByName(entries.select(name.alias("name"))).distinct()
    form = r"^(.*)__([1-9]\d*)(\.[^.]*)?$"
    used = used.filter(F.col("name").rlike(form)).select(
        F.concat(F.regexp_extract("name", form, 1), F.regexp_extract("name", form, 3)).alias("name"),
        F.regexp_extract("name", form, 2).try_cast("bigint").alias("_n"),
    )
    used = Series.plan(used.filter("_n IS NOT NULL"), ["name"], ["_n"]).number("_i").frame()
    # the n-th used number is passed over by every conflict whose rank reaches the count of
    # free numbers below it
    marks = used.select("name", (F.col("_n") - 1 - F.col("_i")).alias("_at"), F.lit(0).alias("_t"),
                        F.lit("").alias(path), F.lit(False).alias("_dir"))
    asks = clash.select("name", F.col("_conflict").alias("_at"), F.lit(1).alias("_t"), path, "_dir")
    both = Series.plan(asks.unionByName(marks), ["name"], ["_at", "_t"])
    both = both.cumulate({"_passed": (F.col("_t") == 0).cast("bigint")}).frame().filter("_t = 1")
    number = (F.col("_at") + 1 + F.col("_passed")).cast("string")
    stem = F.when(F.col("_dir"), F.col("name")).otherwise(F.regexp_extract("name", r"^(.+?)(\.[^.]*)?$", 1))
    suffix = F.when(F.col("_dir"), F.lit("")).otherwise(F.regexp_extract("name", r"^(.+?)(\.[^.]*)?$", 2))
    renamed = both.select(
        path,
        "name",
        F.lit("renamed").alias("outcome"),
        F.concat(stem, F.lit("__"), number, suffix).alias("target"),
    )
    return free.unionByName(renamed)


def canonical_digest(df: DataFrame, cols: list[str]) -> DataFrame:
    """Order-free digest of a record set: row count and sums of four hash quarters.

    Each record is hashed as JSON with sorted keys. Sums merge map-side, so no list of
    records is ever collected. They have 38 digits, printed, which 10**27 rows don't fill.
    Equal sets have equal digests; the digest is ours.
    """
    text = F.to_json(F.struct(*sorted(cols)), {"ignoreNullFields": "false"})
    parts = [F.conv(F.substring("_h", 8 * i + 1, 8), 16, 10).cast("decimal(20,0)") for i in range(4)]
    sums = [F.sum(p).cast("decimal(38,0)").cast("string").alias(f"part{i}") for i, p in enumerate(parts)]
    return df.select(F.md5(text).alias("_h")).agg(F.count(F.lit(1)).alias("rows"), *sums)


def ordered_digest(df: DataFrame, keys: list[str], text: str, pos: str) -> DataFrame:
    """SHA-256 per key of a bounded list of texts joined by newline in order of ``pos``."""
    lines = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(text).alias("t"))))
    joined = F.array_join(F.transform(lines, lambda x: x.t), "\n")
    return df.groupBy(*keys).agg(
        F.sha2(joined, 256).alias("digest"), F.count(F.lit(1)).alias("items")
    )


def chained_digest(df: DataFrame, pos: str, text: str, leaf: int = 1024) -> DataFrame:
    """Digest of an ordered list of any length: a SHA-256 tree of bounded leaves.

    ``pos`` is dense. Each leaf hashes ``leaf`` consecutive lines; the hashes of the
    leaves are the lines of the next level, until one remains. ``levels`` and ``leaf`` are
    part of the result, since they define the digest; it is no hash of the list itself.
    """
    level = df.select(F.col(pos).alias("_p"), F.col(text).alias("_t"))
    longest, levels = (level.agg(F.max("_p")).first()[0] or 0) + 1, 0
    while True:
        levels += 1
        level = ordered_digest(
            level.withColumn("_l", F.floor(F.col("_p") / leaf)), ["_l"], "_t", "_p"
        ).select(F.col("_l").alias("_p"), F.col("digest").alias("_t"))
        longest = -(-longest // leaf)
        if longest <= 1:
            return level.select(F.col("_t").alias("tree_sha256"), F.lit(levels).alias("levels"), F.lit(leaf).alias("leaf"))
