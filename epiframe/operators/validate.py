"""Row and episode checks that report rejects instead of stopping a scan."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.plans.series import Series

# Statuses that raise no warning, and names of the status filters.
HEALTHY = ("ok", "OK", "healthy")
STATUS_ALIASES = {
    "keep": "kept",
    "kept": "kept",
    "skip": "skipped",
    "skipped": "skipped",
    "pending": "pending",
    "all": "all",
    "": "all",
}


def require_columns(df: DataFrame, required: Sequence[str], exact: bool = False) -> DataFrame:
    """The table itself, if its header is sound; an error before any job otherwise."""
    repeated = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if repeated:
        raise ValueError(f"duplicate columns: {repeated}")
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if exact and list(df.columns) != list(required):
        raise ValueError(f"header {df.columns} is not {list(required)}")
    return df


def validity_gate(checks: Sequence[Column], value: Column) -> tuple[Column, Column]:
    """(valid, value or null): a row keeps its pose only if every check holds."""
    valid = F.lit(True)
    for c in checks:
        valid = valid & F.coalesce(c, F.lit(False))
    return valid, F.when(valid, value)


def complete_episodes(
    files: DataFrame, key: str, name: str, size: str, required: Sequence[str]
) -> DataFrame:
    """Per episode the required files it lacks or has empty. The set is bounded by the list."""
    wanted = F.array(*[F.lit(r) for r in required])
    got = F.collect_set(F.when((F.col(size) > 0) & F.col(name).isin(*required), F.col(name)))
    out = files.groupBy(key).agg(F.array_sort(F.array_except(wanted, got)).alias("missing"))
    return out.withColumn("complete", F.size("missing") == 0)


def quality_warning(codes: Column, warnings: Column, *statuses: Column) -> Column:
    """Codes or warnings present, or a status that is set and not healthy."""
    flag = (F.size(F.coalesce(codes, F.array())) > 0) | (F.size(F.coalesce(warnings, F.array())) > 0)
    for s in statuses:
        flag = flag | F.coalesce(~s.isin(*HEALTHY), F.lit(False))
    return flag


def status_gate(status: Column, session: Column, episode: Column) -> Column:
    """Reason to reject a report, or null."""
    return F.when(~status.eqNullSafe(F.lit("ok")), "status_not_ok").when(
        ~session.eqNullSafe(episode), "session_mismatch"
    )


def range_check(df: DataFrame, channel: str, x: str, low: Column, high: Column) -> DataFrame:
    v = F.col(x).cast("double")
    infinite = F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return df.groupBy(channel).agg(
        F.count_if((v < low) | (v > high)).alias("out_of_range"),
        F.count_if(infinite).alias("non_finite"),
        F.count_if(v.isNull()).alias("missing"),
        F.count(F.lit(1)).alias("rows"),
    )


def search_filter(df: DataFrame, status: str, text: str, status_col: str, search: Column) -> DataFrame:
    """Status filter with aliases, then a substring without regard to case."""
    wanted = STATUS_ALIASES.get(status)
    if wanted is None:
        raise ValueError(f"unknown status filter: {status}")
    if wanted != "all":
        df = df.filter(F.col(status_col) == wanted)
    return df.filter(F.contains(F.lower(search), F.lit(text.lower()))) if text else df


def rejects(df: DataFrame, key: str, rules: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """One row per failed episode: category and message of the first rule that hits."""
    hit = F.coalesce(
        *[
            F.when(bad, F.struct(F.lit(name).alias("category"), message.alias("message")))
            for name, bad, message in rules
        ]
    )
    return df.select(key, hit.alias("_r")).filter("_r IS NOT NULL").select(key, "_r.*")


def page(df: DataFrame, order: list[str], number: int, limit: int) -> DataFrame:
    """One page of an ordered listing, with the total of the whole listing on each row.

    Rows are numbered in order, in blocks if they are many, so that a late page gathers no
    more than an early one.
    """
    if number < 1 or not 1 <= limit <= 500:
        raise ValueError("page must be at least 1 and limit in 1..500")
    total = df.agg(F.count(F.lit(1))).scalar()
    s = Series.plan(df.withColumn("_all", F.lit(1)), ["_all"], order).number("_pos")
    first = (number - 1) * limit
    return s.frame().filter(F.col("_pos").between(first, first + limit - 1)).drop("_all", "_pos").withColumn("total", total)


def page_after(df: DataFrame, order: list[str], last: Sequence | None, limit: int) -> DataFrame:
    """The page that follows the row with the values ``last`` in ``order``; the first if None.

    Every task keeps at most ``limit`` rows, whatever the page.
    """
    if not 1 <= limit <= 500:
        raise ValueError("limit must be in 1..500")
    if last is not None:
        df = df.filter(F.struct(*order) > F.struct(*[F.lit(v).alias(c) for c, v in zip(order, last)]))
    return df.orderBy(*order).limit(limit)


def seeded_pick(df: DataFrame, key: str, seed: int) -> DataFrame:
    """One id chosen by a seed: the least hash of seed and id, merged map-side."""
    rank = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.agg(F.min(F.struct(rank.alias("rank"), F.col(key))).alias("_m")).select(f"_m.{key}")
