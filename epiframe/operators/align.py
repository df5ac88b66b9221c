"""Alignment of streams that run on different clocks onto the rows of a grid."""

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.plans.series import BLOCK, Series

POLICIES = ("nearest", "causal", "causal_strict")


@dataclass(frozen=True)
class Stream:
    """Source rows: clock column ``ts`` (one row per key and instant) and payload columns."""

    df: DataFrame
    ts: str
    payload: list[str]


def align_series(
    grid: DataFrame,
    streams: Mapping[str, Stream],
    keys: list[str],
    ts: str,
    row_id: str,
    policy: str | Mapping[str, str] = "nearest",
    max_rows: int | None = None,
    number: str | None = None,
) -> Series:
    """Grid rows in time order, each with its match from every stream.

    All streams and the grid go through one tagged union, so any number of streams costs
    one exchange and one sort. Per stream ``s`` the result has ``s`` (payload struct),
    ``s_delta`` (source clock minus grid clock) and ``s_index`` (rank of the source row).

    * ``nearest``: the closer neighbour, the earlier one on a tie.
    * ``causal``: last row at or before; before the first row the first one fills in, with
      index -1 and a positive delta.
    * ``causal_strict``: as causal, null before the first row.

    ``number`` names a column for the position of the grid row.
    """
    chosen = {n: policy if isinstance(policy, str) else policy[n] for n in streams}
    for name, value in chosen.items():
        if value not in POLICIES:
            raise ValueError(f"{name}: unsupported alignment policy {value}")
    base = [F.col(k) for k in keys]
    payloads = {
        name: F.struct(F.col(s.ts).alias("ts"), F.struct(*s.payload).alias("row"))
        for name, s in streams.items()
    }
    tagged = [
        grid.select(
            *base,
            F.col(ts).alias("_t"),
            F.lit(1).alias("_q"),
            F.col(row_id).alias("_id"),
            F.struct(*grid.columns).alias("_g"),
        )
    ]
    for name, stream in streams.items():
        tagged.append(
            stream.df.select(
                *base,
                F.col(stream.ts).alias("_t"),
                F.lit(0).alias("_q"),
                payloads[name].alias(f"_s_{name}"),
            )
        )
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return _matched(union, grid.columns, chosen, keys, max_rows, number)


def align_tagged(
    rows: DataFrame,
    is_grid: Column,
    streams: Mapping[str, tuple[Column, list[str]]],
    keys: list[str],
    ts: str,
    row_id: str,
    grid: list[str],
    policy: str | Mapping[str, str] = "nearest",
    max_rows: int | None = None,
    number: str | None = None,
) -> Series:
    """As ``align_series`` for a grid and streams that are rows of one table.

    ``is_grid`` and the condition of each stream say which rows are whose; a stream also
    names its payload, and ``grid`` the columns of a grid row. No row may be two of them. The
    table is read once, and not exchanged if it is stored by these keys (``write_layout``).
    """
    chosen = {n: policy if isinstance(policy, str) else policy[n] for n in streams}
    for name, value in chosen.items():
        if value not in POLICIES:
            raise ValueError(f"{name}: unsupported alignment policy {value}")
    wanted = is_grid
    for of, _ in streams.values():
        wanted = wanted | of
    tagged = rows.filter(wanted).select(
        *keys,
        F.col(ts).alias("_t"),
        F.when(is_grid, 1).otherwise(0).alias("_q"),
        F.when(is_grid, F.col(row_id)).alias("_id"),
        F.when(is_grid, F.struct(*grid)).alias("_g"),
        *[
            F.when(of, F.struct(F.col(ts).alias("ts"), F.struct(*payload).alias("row"))).alias(f"_s_{n}")
            for n, (of, payload) in streams.items()
        ],
    )
    return _matched(tagged, grid, chosen, keys, max_rows, number)


def _matched(
    tagged: DataFrame, grid: list[str], chosen: Mapping[str, str], keys: list[str], max_rows: int | None, number: str | None
) -> Series:
    """Grid rows with their matches, from rows tagged as grid (_q, _id, _g) or stream (_s_name)."""
    base = [F.col(k) for k in keys]
    series = Series.plan(tagged, keys, ["_t", "_q", "_id"], max_rows)
    rows = {n: F.col(f"_s_{n}") for n in chosen}
    counts = {f"_c_{n}": c.isNotNull().cast("bigint") for n, c in rows.items()}
    if number is not None:
        counts["_grid"] = F.col("_q").cast("bigint")
    series = series.scan(
        total=counts,
        held={f"_b_{n}": c for n, c in rows.items()},
        ahead={f"_a_{n}": c for n, c in rows.items()},
    )
    series = series.filter(F.col("_q") == 1)

    def pick(df: DataFrame) -> DataFrame:
        cols = {} if number is None else {number: F.col("_grid") - 1}
        for name, rule in chosen.items():
            cols.update(_choose(name, rule))
        extra = [c for c in grid if c not in keys]
        block = [BLOCK] if BLOCK in df.columns else []
        return df.select(
            *base,
            *block,
            "_t",
            "_q",
            "_id",
            *[F.col(f"_g.{c}").alias(c) for c in extra],
            *[c.alias(n) for n, c in cols.items()],
        )

    return series.map(pick)


def _choose(name: str, rule: str) -> dict[str, Column]:
    back, ahead = F.col(f"_b_{name}"), F.col(f"_a_{name}")
    count = F.col(f"_c_{name}")
    if rule == "nearest":
        earlier = ahead.isNull() | ((F.col("_t") - back.ts) <= (ahead.ts - F.col("_t")))
        use_back = back.isNotNull() & earlier
        match = F.when(use_back, back).otherwise(ahead)
        index = F.when(use_back, count - 1).when(ahead.isNotNull(), count)
    elif rule == "causal":
        match = F.coalesce(back, ahead)
        index = F.when(match.isNotNull(), count - 1)
    else:
        match = back
        index = count - 1
    return {
        name: match["row"],
        f"{name}_delta": match["ts"] - F.col("_t"),
        f"{name}_index": index,
    }


def align(grid, streams, keys, ts, row_id, policy="nearest", max_rows=None) -> DataFrame:
    return align_series(grid, streams, keys, ts, row_id, policy, max_rows).frame().drop(
        "_t", "_q", "_id"
    )


def flat(rows: DataFrame, payload: list[str]) -> DataFrame:
    """The matched columns of the stream ``src`` with that prefix."""
    return rows.select("*", *[F.col(f"src.{c}").alias(f"src_{c}") for c in payload]).drop("src")


def asof(grid, source: Stream, keys, ts, row_id, policy="nearest", max_rows=None) -> DataFrame:
    """One-stream alignment with the matched payload columns prefixed ``src_``."""
    out = align(grid, {"src": source}, keys, ts, row_id, policy, max_rows)
    return flat(out, source.payload)


def fresh(delta: Column, tolerance: int, policy: str = "nearest") -> Column:
    """Tolerance flag: absolute for nearest; the age from 0 up for the causal policies."""
    inside = F.abs(delta) <= tolerance if policy == "nearest" else (-delta).between(0, tolerance)
    return F.coalesce(inside, F.lit(False))
