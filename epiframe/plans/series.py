"""Ordered scans over keyed rows that stay parallel when one key is huge.

Most keys are small, so their rows go through ordinary windows partitioned by the key:
one exchange and one sort. If the plan and the footers of its files prove that all rows fit
one task (``plans.bounds``), nothing is looked at before. Otherwise one pass over the key
columns alone looks for keys with more rows than a task should sort; if there is none, the
rows themselves are read once, by the query.

Only if there are such hot keys are all rows written once, hot ones apart. The hot rows are
range-partitioned on the full order into blocks of at most about half a million rows, scanned per block, and
joined to the summaries of the blocks before (or after) them. The summaries are a series of
their own, one row per key and block, and are scanned in the same way, so a key of any length
is carried up a tree of blocks.

No size is guessed, and no number of keys or blocks is capped: a table of n rows has at most
n / MAX_ROWS hot keys and about n / BLOCK_ROWS summaries. Joins with them are broadcast only if
that number is small, else they share the exchange of the windows that follow.
"""

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from epiframe.plans.bounds import rows_within
from epiframe.plans.shared import settle

MAX_ROWS = 4_000_000
#: Rows of a block of a hot key: small beside a task's memory, and many blocks for many cores.
BLOCK_ROWS = 500_000
BROADCAST_ROWS = 500_000
STEPS = 3
BLOCK = "_blk"


def key_hash(keys: list[str]) -> Column:
    """Keys are told apart by hash here; a cold key that collides is merely treated as hot."""
    return F.xxhash64(*keys)


def hot_keys(df: DataFrame, keys: list[str], max_rows: int) -> tuple[DataFrame, int, int] | None:
    """(table of ``_h``, its rows, the rows of these keys) of keys with more than ``max_rows``
    rows; None if there are none. The counts are exact."""
    if rows_within(df, max_rows) is not None:
        return None
    counts = df.groupBy(key_hash(keys).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    if (counts.agg(F.max("_n")).first()[0] or 0) <= max_rows:
        return None
    names = settle(counts.filter(F.col("_n") > max_rows))
    row = names.agg(F.count(F.lit(1)).alias("keys"), F.sum("_n").alias("rows")).first()
    return names.select("_h"), row["keys"], row["rows"]


def few(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if the counted rows are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


@dataclass(frozen=True)
class Series:
    """Rows grouped by ``keys`` and totally ordered by ``order`` within a group."""

    keys: list[str]
    order: list[str]
    cold: DataFrame
    hot: DataFrame | None = None
    names: DataFrame | None = None
    n_names: int = 0
    n_blocks: int = 0
    pending: int = 0

    @staticmethod
    def plan(
        df: DataFrame, keys: list[str], order: list[str], max_rows: int | None = None, like: "Series | None" = None
    ) -> "Series":
        """Split hot keys off. ``like`` is a planned series that has all rows of each key of
        ``df`` and maybe more; its hot keys are used, and nothing is counted again."""
        max_rows = max_rows or MAX_ROWS
        block_rows = min(max_rows, BLOCK_ROWS)
        if like is not None:
            found = None if like.names is None else (like.names, like.n_names, like.n_blocks * block_rows)
        else:
            found = hot_keys(df, keys, max_rows)
        if found is None:
            return Series(keys, order, df)
        names, n_names, n_rows = found
        # one pass over the rows: both kinds are written by it, and read apart from there
        marked = few(names.withColumn("_hot", F.lit(True)), n_names)
        rows = df.withColumn("_h", key_hash(keys)).join(marked, "_h", "left").drop("_h")
        rows = settle(rows.withColumn("_hot", F.col("_hot").isNotNull()), by="_hot")
        n_blocks = max(2, -(-n_rows // block_rows))
        hot = rows.filter("_hot").drop("_hot").repartitionByRange(n_blocks, *keys, *order)
        hot = settle(hot.withColumn(BLOCK, F.spark_partition_id()))
        cold = rows.filter("NOT _hot").drop("_hot")
        return Series(keys, order, cold, hot, names, n_names, n_blocks)

    # -- row-wise steps ---------------------------------------------------------------

    def map(self, fn: Callable[[DataFrame], DataFrame]) -> "Series":
        """Apply a row-wise DataFrame function that keeps the key, order and block columns."""
        return replace(self, cold=fn(self.cold), hot=None if self.hot is None else fn(self.hot))

    def with_columns(self, cols: dict[str, Column]) -> "Series":
        return self.map(lambda d: d.withColumns(cols))

    def filter(self, condition) -> "Series":
        return self.map(lambda d: d.filter(condition))

    def join_keys(self, facts: DataFrame) -> "Series":
        """Add columns of a table with one row per key."""
        cold = self.cold.join(facts, self.keys, "left")
        if self.hot is None:
            return replace(self, cold=cold)
        own = facts.withColumn("_h", key_hash(self.keys))
        own = own.join(few(self.names, self.n_names), "_h", "left_semi").drop("_h")
        return replace(self, cold=cold, hot=self.hot.join(few(own, self.n_names), self.keys, "left"))

    def settled(self) -> "Series":
        """The same rows from shared storage, for chains that are read more than once."""
        return replace(self, cold=settle(self.cold), hot=None if self.hot is None else settle(self.hot), pending=0)

    def frame(self) -> DataFrame:
        if self.hot is None:
            return self.cold
        return self.cold.unionByName(self.hot.drop(BLOCK))

    # -- windows ----------------------------------------------------------------------

    def _over(self, blocked: bool) -> str:
        def quoted(names):
            return ", ".join(f"`{n}`" for n in names)

        keys = [*self.keys, BLOCK] if blocked else self.keys
        return f"OVER (PARTITION BY {quoted(keys)} ORDER BY {quoted(self.order)})"

    def _window(self, blocked: bool):
        keys = [*self.keys, BLOCK] if blocked else self.keys
        return W.partitionBy(*keys).orderBy(*self.order)

    def _next(self, cold: DataFrame, hot_step: Callable[[DataFrame], DataFrame]) -> "Series":
        if self.hot is None:
            return replace(self, cold=cold)
        # a step reads the hot rows twice, for the summaries and for the rows; a few steps
        # share one exchange, more are cut by a write
        full = self.pending >= STEPS
        base = settle(self.hot) if full else self.hot
        return replace(self, cold=cold, hot=hot_step(base), pending=1 if full else self.pending + 1)

    def scan(
        self,
        number: str | None = None,
        total: Mapping[str, Column] | None = None,
        held: Mapping[str, Column] | None = None,
        ahead: Mapping[str, Column] | None = None,
        previous: Mapping[str, Column] | None = None,
        following: Mapping[str, Column] | None = None,
    ) -> "Series":
        """Add ordered values, all from one pass in one ordering.

        * ``number``: zero-based position within the key.
        * ``total``: running sum up to and including the row.
        * ``held``: last non-null value at or before the row; ``ahead``: first one after it.
        * ``previous`` / ``following``: value of the row before / after.
        """
        groups = {
            "total": dict(total or {}),
            "held": dict(held or {}),
            "ahead": dict(ahead or {}),
            "previous": dict(previous or {}),
            "following": dict(following or {}),
        }
        inputs = {f"_v_{n}": c for cols in groups.values() for n, c in cols.items()}
        kinds = {n: kind for kind, cols in groups.items() for n in cols}

        def local(df: DataFrame, blocked: bool) -> dict[str, Column]:
            w, over = self._window(blocked), self._over(blocked)
            upto = w.rowsBetween(W.unboundedPreceding, 0)
            make = {
                "total": lambda v: F.coalesce(F.sum(v).over(upto), F.lit(0)),
                "held": lambda v: F.last(v, ignorenulls=True).over(upto),
                "ahead": lambda v: F.expr(f"lead(`{v}`) IGNORE NULLS {over}"),
                "previous": lambda v: F.lag(v).over(w),
                "following": lambda v: F.lead(v).over(w),
            }
            cols = {n: make[kind](f"_v_{n}") for n, kind in kinds.items()}
            if number is not None:
                cols[number] = (F.row_number().over(w) - 1).cast("bigint")
            return cols

        def hot_step(hot: DataFrame) -> DataFrame:
            temp = hot.withColumns(inputs) if inputs else hot
            at = F.struct(*self.order)
            aggs = [F.count(F.lit(1)).alias("_n")]
            for n, kind in kinds.items():
                v = F.col(f"_v_{n}")
                present = F.when(v.isNotNull(), at)
                # edge rows are wrapped, since their value itself may be null
                edge = F.struct(v.alias("v"))
                agg = {
                    "total": lambda: F.sum(v),
                    "held": lambda: F.max_by(v, present),
                    "ahead": lambda: F.min_by(v, present),
                    "previous": lambda: F.max_by(edge, at),
                    "following": lambda: F.min_by(edge, at),
                }[kind]()
                aggs.append(agg.alias(f"_e_{n}"))
            blocks = settle(temp.groupBy(*self.keys, BLOCK).agg(*aggs))
            moved = self._carried(blocks, kinds)
            out = temp.join(few(moved, self.n_names + self.n_blocks), [*self.keys, BLOCK], "left")

            w = self._window(True)
            here = local(out, True)
            cols = {}
            for n, kind in kinds.items():
                e = F.col(f"_e_{n}")
                cols[n] = {
                    "total": lambda: here[n] + F.coalesce(e, F.lit(0)),
                    "held": lambda: F.coalesce(here[n], e),
                    "ahead": lambda: F.coalesce(here[n], e),
                    "previous": lambda: F.when(F.lag(F.lit(1)).over(w).isNull(), e["v"]).otherwise(here[n]),
                    "following": lambda: F.when(F.lead(F.lit(1)).over(w).isNull(), e["v"]).otherwise(here[n]),
                }[kind]()
            if number is not None:
                cols[number] = here[number] + F.col("_n")
            extra = [*(f"_e_{n}" for n in kinds), "_n"]
            return out.withColumns(cols).drop(*inputs, *extra)

        cold = self.cold.withColumns(inputs) if inputs else self.cold
        cold = cold.withColumns(local(cold, False)).drop(*inputs)
        return self._next(cold, hot_step)

    def _carried(self, blocks: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
        """What each block gets from the blocks before it, or after it. The summaries are
        scanned as a series over (key, block)."""
        # names by position, so that a summary of summaries has no column twice
        edges = [F.col(f"_e_{n}").alias(f"_x{i}") for i, n in enumerate(kinds)]
        rows = blocks.select(*self.keys, F.col(BLOCK).alias("_at"), F.col("_n").alias("_x"), *edges)
        taken: dict[str, dict[str, Column]] = {}
        for i, kind in enumerate(kinds.values()):
            edge = F.col(f"_x{i}")
            taken.setdefault(kind, {})[f"_t{i}"] = F.coalesce(edge, F.lit(0)) if kind == "total" else edge
        sums = {"_t": F.col("_x"), **taken.pop("total", {})}
        s = Series.plan(rows, self.keys, ["_at"]).scan(total=sums, **taken)
        # sums and held values of all blocks before are those at the block before
        running = [*sums, *taken.get("held", {})]
        s = s.shift({n.replace("_t", "_b"): F.col(n) for n in running})
        cols = [F.coalesce("_b", F.lit(0)).alias("_n")]
        cols += [F.col(f"_b{i}" if f"_t{i}" in running else f"_t{i}").alias(f"_e_{n}") for i, n in enumerate(kinds)]
        return s.frame().select(*self.keys, F.col("_at").alias(BLOCK), *cols)

    def number(self, name: str = "pos") -> "Series":
        return self.scan(number=name)

    def cumulate(self, cols: Mapping[str, Column]) -> "Series":
        return self.scan(total=cols)

    def shift(self, cols: Mapping[str, Column], forward: bool = False) -> "Series":
        return self.scan(following=cols) if forward else self.scan(previous=cols)

    def future(self, name: str, value: Column, horizon: int, pos: str) -> "Series":
        """Array of the values of the next ``horizon`` rows, nulls too (shorter at the end).

        ``pos`` is the dense position. For hot keys, rows are regrouped by position and
        the first ``horizon`` rows of a group are also sent to the group before it.
        """

        held = F.struct(value.alias("v"))  # a list leaves out nulls, but not structs that hold them
        plain = F.transform(name, lambda x: x["v"])

        def hot_step(hot):
            size = max(MAX_ROWS // 4, horizon)
            block = F.floor(F.col(pos) / size)
            rows = hot.withColumns({"_v": held, BLOCK: block, "_halo": F.lit(False)})
            halo = rows.filter((F.col(pos) % size < horizon) & (F.col(BLOCK) > 0)).withColumns(
                {BLOCK: F.col(BLOCK) - 1, "_halo": F.lit(True)}
            )
            w = W.partitionBy(*self.keys, BLOCK).orderBy(pos).rowsBetween(1, horizon)
            out = rows.unionByName(halo).withColumn(name, F.collect_list("_v").over(w))
            return out.filter(~F.col("_halo")).drop("_v", "_halo").withColumn(name, plain)

        w = self._window(False).rowsBetween(1, horizon)
        cold = self.cold.withColumn(name, F.collect_list(held).over(w)).withColumn(name, plain)
        return self._next(cold, hot_step)
