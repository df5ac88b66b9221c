"""Operators with state of their own per key, kept by the engine in RocksDB.

Each is a ``StatefulProcessor`` over shards of keys, since a call to a processor and a look at
its state cost the same for one row as for thousands: their number grows with the shards that a
batch touches, not with its keys. Rows of a key come in any order, wait in map state until the
watermark has passed them, and are then taken in time order. A batch writes the rows that came
to it, once, and removes the buckets of time that are done; what goes on waiting is not written
again but for a bucket that the watermark is in and that late rows come to. Rows older than the
watermark are dropped by the engine and counted in its progress.

A shard has one timer at a time, at its earliest waiting row. Python sees the rows of one shard
and batch; what a shard holds is bounded by its rows within the watermark's delay, and a few
numbers per key. The number of shards is part of a job's checkpoint: take several per core.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, IntegralType, LongType, StructField, StructType

#: Settings of a query with such state.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


#: Microseconds of a bucket of waiting rows; about the delay of the watermark or less.
HOUR = 3_600_000_000
SHARDS = 1024
SHARD = "_shard"
NEVER = -(1 << 63)


def milliseconds(ts: int) -> int:
    """Timer for a time in microseconds: fires once the watermark has passed it."""
    return -(-ts // 1000)


def longs(*names: str) -> StructType:
    """Schemas are made from parts, since a worker can't parse their text."""
    return StructType([StructField(n, LongType()) for n in names])


PACKED = StructType([StructField("rows", BinaryType())])


def packed(frame: pd.DataFrame) -> tuple[bytes]:
    """Rows as one state value."""
    table, out = pa.Table.from_pandas(frame, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as to:
        to.write_table(table)
    return (out.getvalue().to_pybytes(),)


def unpacked(value: tuple) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(value[0])).read_pandas()


class Carried:
    """Columns of any type and with nulls on their way through pandas, which would turn whole
    numbers with nulls into floats: a value and a mark for null each."""

    def __init__(self, rows: DataFrame, names: Sequence[str], prefix: str):
        self.names, self.kinds = list(names), [rows.schema[n].dataType for n in names]
        self.whole = [isinstance(k, IntegralType) for k in self.kinds]
        self.values = [f"{prefix}{i}" for i in range(len(self.names))]
        self.nulls = [f"{prefix}{i}_null" for i in range(len(self.names))]
        self.columns = [*self.values, *self.nulls]

    def sent(self) -> list[Column]:
        cols = []
        for name, kind, whole, value, null in zip(self.names, self.kinds, self.whole, self.values, self.nulls):
            c = F.col(name)
            cols.append((F.coalesce(c, F.lit(0).cast(kind)) if whole else c).alias(value))
            cols.append(c.isNull().alias(null))
        return cols

    def restored(self, frame: pd.DataFrame, missing=None) -> dict[str, pd.Series]:
        """The columns by name; null in rows that are ``missing`` too."""
        out = {}
        for name, whole, value, null in zip(self.names, self.whole, self.values, self.nulls):
            gone = frame[null].to_numpy(bool)
            gone = gone if missing is None else gone | missing
            v = frame[value].reset_index(drop=True)
            out[name] = pd.Series(pd.array(v.to_numpy("int64"), dtype="Int64")).mask(gone) if whole else v.mask(gone) if gone.any() else v
        return out


def codes(frame: pd.DataFrame, columns: Sequence[str]) -> np.ndarray:
    """A number per distinct key, from 0 in the order of first rows; nulls are a key."""
    return pd.factorize(frame.groupby(list(columns), sort=False, dropna=False).ngroup().to_numpy())[0]


def joined(frames: Sequence[pd.DataFrame | None]) -> pd.DataFrame | None:
    """The rows of all frames that have any; None if there are none."""
    some = [f for f in frames if f is not None and len(f)]
    return (pd.concat(some, ignore_index=True) if len(some) > 1 else some[0].reset_index(drop=True)) if some else None


class Waiting(StatefulProcessor):
    """Holds the rows of a shard until the watermark passes them, then hands them on in order.

    Rows are named by (key, time, row id), time and row id not null; a repeated name keeps the
    last row. They are kept in buckets of ``span`` microseconds, and a batch adds a part to each
    bucket that rows come to. ``taken`` gets the rows that are due and yields frames; ``state``
    opens more state.
    """

    def __init__(self, keys: Carried, held: Sequence[str], span: int):
        self.keys, self.span = keys, span
        self.columns = ["ts", "row", *keys.columns, *held]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", longs("bucket", "part"), PACKED)
        self.timer = handle.getValueState("timer", longs("at", "upto"))
        self.state(handle)

    def state(self, handle: StatefulProcessorHandle) -> None:
        pass

    def taken(self, rows: pd.DataFrame | None, passed: int) -> Iterator[pd.DataFrame]:
        """rows: those that are due, in any order; passed: the watermark in microseconds."""
        raise NotImplementedError

    def pause(self) -> int | None:
        """A time at which the shard is looked at even if no row waits."""
        return None

    def handleInputRows(self, key, rows, timerValues):
        new = joined([part[self.columns] for part in rows])
        yield from self._due(timerValues.getCurrentWatermarkInMs() * 1000, new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._due(timerValues.getCurrentWatermarkInMs() * 1000, None)

    def _due(self, passed: int, new: pd.DataFrame | None) -> Iterator[pd.DataFrame]:
        at, upto = self.timer.get() if self.timer.exists() else (None, NEVER)
        there: dict[int, list[int]] = {}
        for b, part in self.waiting.keys():
            there.setdefault(b, []).append(part)
        came = {} if new is None else {int(b): rows for b, rows in new.groupby(new["ts"].to_numpy() // self.span)}
        due, later = [], []
        for b in sorted(there.keys() | came.keys()):
            parts = sorted(there.get(b, []))
            if b > passed // self.span:
                later.append(b * self.span)
                if b in came:
                    self.waiting.updateValue((b, parts[-1] + 1 if parts else 0), packed(came[b]))
                continue
            # rows up to the watermark of the last call were taken then
            rows = [r[r["ts"] > upto] for r in (unpacked(self.waiting.getValue((b, p))) for p in parts)]
            rows = joined([*rows, *([came[b]] if b in came else [])])
            due.append(rows[rows["ts"] <= passed])
            rest = rows[rows["ts"] > passed]
            if len(rest):
                later.append(int(rest["ts"].min()))
            if len(rest) and (b in came or len(parts) > 1):
                self.waiting.updateValue((b, parts[0] if parts else 0), packed(rest))
            for p in parts[1:] if len(rest) else parts:
                self.waiting.removeKey((b, p))
        rows = joined(due)
        if rows is not None:
            rows = rows.drop_duplicates(["ts", "row", *self.keys.columns], keep="last")
        yield from self.taken(rows, passed)
        self._wake(at, upto, later + [t for t in [self.pause()] if t is not None], passed)

    def _wake(self, at: int | None, upto: int, times: list[int], passed: int) -> None:
        new = milliseconds(min(times)) if times else None
        if at != new:
            if at is not None:
                self.handle.deleteTimer(at)
            if new is not None:
                self.handle.registerTimer(new)
        if (at, upto) != (new, passed):
            self.timer.update((new, passed))


def keyed_state(rows: DataFrame, processor: StatefulProcessor, fields: StructType, mode: str = "append", time: str = "eventTime") -> DataFrame:
    return rows.groupBy(SHARD).transformWithStateInPandas(processor, fields, mode, time)


def shard(keys: Sequence[str], shards: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(shards)).cast("int").alias(SHARD)


def output(keys: Carried, fields: str) -> StructType:
    own = [StructField(n, k) for n, k in zip(keys.names, keys.kinds)]
    return StructType([*own, *StructType.fromDDL(fields).fields])


# -- runs broken by a flag or a bad edge ---------------------------------------------------


class FlagRuns(Waiting):
    """Runs of valid samples joined by valid transitions, put out when they end.

    A run ends before an invalid sample, before a row whose incoming edge is bad, and when no
    row has followed for ``idle``. Runs are numbered within a key.
    """

    OPEN = ("run", "first_ts", "last_ts", "first_row", "last_row", "samples", "seen")

    def __init__(self, keys: Carried, span: int, idle: int):
        super().__init__(keys, ["ok", "edge"], span)
        self.idle = idle

    def state(self, handle):
        self.open = handle.getValueState("open", PACKED)

    def taken(self, rows, passed):
        self._until = None
        names = self.keys.columns
        before = unpacked(self.open.get()) if self.open.exists() else None
        keys = joined([None if f is None else f[names] for f in (before, rows)])
        if keys is None:
            return
        # the keys seen before come first, one row each
        at = codes(keys, names)
        runs = {} if before is None else dict(enumerate(zip(*[before[c].tolist() for c in self.OPEN])))
        changed, out = rows is not None, []
        for k, ts, row, ok, edge in self._in_order(rows, at[len(runs) :]):
            run, first, last, a, z, n, seen = runs.get(k, (-1, 0, 0, 0, 0, 0, ts))
            if n and not (ok and edge and ts - seen <= self.idle):
                out.append((k, run, first, last, a, z, n))
                n = 0
            if ok and not n:
                run, first, a = run + 1, ts, row
            if ok:
                last, z, n = ts, row, n + 1
            runs[k] = (run, first, last, a, z, n, ts)
        ends = []
        for k, (*run, n, seen) in runs.items():
            if n and seen + self.idle < passed:  # what may still come is later than the watermark
                out.append((k, *run, n))
                runs[k], changed = (*run, 0, seen), True
            elif n:
                ends.append(seen + self.idle + 1)
        self._until = min(ends, default=None)
        keys = keys.iloc[np.unique(at, return_index=True)[1]]
        if changed:
            facts = dict(zip(self.OPEN, zip(*[runs[k] for k in range(len(keys))])))
            self.open.update(packed(keys.assign(**facts)))
        if out:
            k, *facts = zip(*out)
            yield pd.DataFrame({**self.keys.restored(keys.iloc[list(k)]), **dict(zip(self.OPEN, facts))})

    def _in_order(self, rows, at):
        if rows is None:
            return []
        order = np.lexsort((rows["row"], rows["ts"], at))
        return zip(*[c[order].tolist() for c in (at, *[rows[n].to_numpy() for n in ("ts", "row", "ok", "edge")])])

    def pause(self):
        return self._until


def flag_runs(
    rows: DataFrame, keys: Sequence[str], time: str, ts: str, row_id: str, sample: Column, transition: Column,
    idle: int, late: str, span: int = HOUR, shards: int = SHARDS,
) -> DataFrame:
    """Streaming form of ``valid_runs`` with ``run_records``; null flags are not valid.

    ``time`` is the event time, ``ts`` the same in microseconds. Run it with ``STATE``.
    """
    flags = {"ok": F.coalesce(sample, F.lit(False)), "edge": F.coalesce(transition, F.lit(False))}
    own = Carried(rows, keys, "k")
    rows = rows.withWatermark(time, late).select(
        shard(keys, shards), F.col(time).alias("_time"), F.col(ts).alias("ts"), F.col(row_id).alias("row"), *own.sent(), *[c.alias(n) for n, c in flags.items()]
    )
    fields = "run bigint, first_ts bigint, last_ts bigint, first_row bigint, last_row bigint, samples bigint"
    return keyed_state(rows, FlagRuns(own, span, idle), output(own, fields))


# -- causal as-of --------------------------------------------------------------------------


class AsofBackward(Waiting):
    """The last source row at or before each query, put out once the watermark has passed it.

    Of the source rows that were passed only the last one of each key is kept.
    """

    def __init__(self, keys: Carried, payload: Carried, span: int, ts: str, row_id: str):
        super().__init__(keys, ["is_query", *payload.columns], span)
        self.payload, self.named = payload, {"row": row_id, "ts": ts}

    def state(self, handle):
        self.last = handle.getValueState("last", PACKED)

    def taken(self, rows, passed):
        if rows is None:
            return
        rows = joined([unpacked(self.last.get()) if self.last.exists() else None, rows])
        at = codes(rows, self.keys.columns)
        # at one instant sources come before queries
        order = np.lexsort((rows["row"], rows["is_query"], rows["ts"], at))
        rows, at = rows.iloc[order].reset_index(drop=True), at[order]
        query = rows["is_query"].to_numpy(bool)
        here = np.arange(len(rows))
        before = np.maximum.accumulate(np.where(query, -1, here))
        missing = (before < 0) | (at[before] != at)
        ends = np.append(at[1:] != at[:-1], True) & ~missing
        if not query.all():
            self.last.update(packed(rows.iloc[before[ends]]))
        if query.any():
            asked, missing, found = rows[query], missing[query], rows.iloc[before[query]]
            delta = pd.array(found["ts"].to_numpy() - asked["ts"].to_numpy(), dtype="Int64")
            out = {**self.keys.restored(asked), **{n: asked[c].reset_index(drop=True) for c, n in self.named.items()}}
            out["src_delta"] = pd.Series(delta).mask(missing)
            yield pd.DataFrame({**out, **{f"src_{n}": c for n, c in self.payload.restored(found, missing).items()}})


def asof_backward(
    rows: DataFrame, keys: Sequence[str], time: str, ts: str, row_id: str, is_query: Column, payload: Sequence[str], late: str,
    span: int = HOUR, shards: int = SHARDS,
) -> DataFrame:
    """Streaming as-of join of the queries among ``rows`` to the sources among them, on ``ts``
    in microseconds, of which ``time`` is the event time. Run it with ``STATE``."""
    own, carried = Carried(rows, keys, "k"), Carried(rows, payload, "p")
    rows = rows.withWatermark(time, late).select(
        shard(keys, shards), F.col(time).alias("_time"), F.col(ts).alias("ts"), F.col(row_id).alias("row"), *own.sent(),
        F.coalesce(is_query, F.lit(False)).alias("is_query"), *carried.sent(),
    )
    fields = output(own, f"`{row_id}` bigint, `{ts}` bigint, src_delta bigint")
    fields = StructType([*fields.fields, *[StructField(f"src_{n}", k) for n, k in zip(carried.names, carried.kinds)]])
    return keyed_state(rows, AsofBackward(own, carried, span, ts, row_id), fields)


# -- newly complete episodes ---------------------------------------------------------------


class NewEpisodes(StatefulProcessor):
    """Which required files of an episode are there, when they last changed, and what was said.

    An episode that nobody has touched for ``keep`` milliseconds is forgotten, if given.
    """

    def __init__(self, keys: Carried, required: Sequence[str], keep: int | None):
        self.keys, self.keep = keys, keep
        self.bits = {name: 1 << i for i, name in enumerate(required)}

    def init(self, handle):
        self.known = handle.getValueState("known", PACKED, self.keep)

    def handleInputRows(self, key, rows, timerValues):
        names = self.keys.columns
        now = 0 if self.keep is None else timerValues.getCurrentProcessingTimeInMs()
        before = unpacked(self.known.get()) if self.known.exists() else None
        if before is not None and self.keep is not None:
            before = before[before["touched"] > now - self.keep]
        parts = [before]
        for part in rows:
            bits = part["name"].map(self.bits).fillna(0).astype("int64").where(part["size"] > 0, 0)
            parts.append(part[[*names, "changed"]].assign(seen=bits, said=NEVER, touched=now))
        all_rows = joined(parts)
        at = codes(all_rows, names)
        keys = all_rows.iloc[np.unique(at, return_index=True)[1]][names]
        facts = {n: np.full(len(keys), NEVER) for n in ("changed", "said", "touched")}
        for n, of in facts.items():
            np.maximum.at(of, at, all_rows[n].to_numpy())
        seen = np.zeros(len(keys), "int64")
        np.bitwise_or.at(seen, at, all_rows["seen"].to_numpy())
        new = (seen == (1 << len(self.bits)) - 1) & (facts["changed"] != facts["said"])
        facts["said"][new] = facts["changed"][new]
        self.known.update(packed(keys.assign(seen=seen, **facts)))
        if new.any():
            yield pd.DataFrame({**self.keys.restored(keys[new]), "changed_at": facts["changed"][new]})


def new_episodes(
    files: DataFrame, key: str, name: str, size: str, changed: str, required: Sequence[str], keep_days: int | None = None,
    shards: int = SHARDS,
) -> DataFrame:
    """An episode when its required files are there, and again only after its files have changed.

    What was put out is part of the key's state, so no earlier output is read. Run it with
    ``STATE``. ``keep_days`` is for jobs that run all the time: the engine then looks for old
    state in batches of their own, and a job that only takes what has arrived never ends.
    """
    own = Carried(files, [key], "k")
    rows = files.filter(F.col(changed).isNotNull()).select(
        shard([key], shards), *own.sent(), F.col(name).alias("name"), F.coalesce(size, F.lit(0)).alias("size"), F.col(changed).alias("changed")
    )
    keep = None if keep_days is None else keep_days * 86_400_000
    processor = NewEpisodes(own, required, keep)
    return keyed_state(rows, processor, output(own, "changed_at bigint"), "update", "none" if keep is None else "processingTime")
