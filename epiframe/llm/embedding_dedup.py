"""Near-duplicate embeddings by lattice hashing.

1. Vectors become unit vectors in double precision. Equal vectors form a class; from here on
   a class stands for its rows and carries their number.
2. A table projects the unit vectors at random onto 8 dimensions a level, shifts and scales
   them, and decodes each level to the nearest point of the E8 lattice; the points together
   are the cell. A vector lies in its home cell and probes the cells reached by the least
   costly steps to neighbouring lattice points. Two vectors are candidates if the home of one
   is the home or a probe of the other in any table.
3. The vectors are sent to their cells in rounds of one or more tables, so that the rows under
   way are about as many as the vectors they come from, whatever the number of tables; what a
   round has shuffled is given back before the next. Cells are counted before: those with more
   rows than two blocks of bounded size are cut into blocks, and the unit of work is a pair of
   blocks. Neither candidates nor links are ever paired off as rows.
4. The vectors of each unit are compared by matrix products (those of more than 128 dimensions
   only if the signs of 128 projections agree well enough). Links that an earlier table has met
   are left out, which the cells of both vectors tell. A unit puts out, for every vector, its
   number of links there and the smallest vector of its component there; Spark adds up the
   first and merges the second.

``SETTINGS`` has for each number of levels the scale, the probes and the tables that miss a
pair at the threshold with probability below 1e-4 (measured on random pairs, see the tests);
pairs above it are missed less. Few probes of large cells cost less than many of small ones,
as a comparison costs some nanoseconds and a probe a row. More rows take more levels, so that
cells stay small; what is found doesn't depend on that. Nothing is capped.

Defined results
* Vectors that are null, empty, zero or hold null or non-finite components link with nothing:
  n_links 0, component_id their own id. Vectors are linked only with those of their length.
* n_links counts rows: copies of a vector, also under the same vec_id, count one each.
* Rows without vec_id take no part: n_links 0, component_id null, kept true.
* An empty table gives an empty result. Other columns are ignored.
"""

from collections.abc import Iterator
from functools import cache, reduce
from hashlib import blake2b
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm.common import compact, query, rows_a_batch, settle, small, table
from epiframe.llm.near_dedup import components, labelled
from epiframe.llm.scan import U, mixed
from epiframe.plans.shared import give_back, remove

COSINE = 0.95
#: levels: (scale of the cells, steps looked at for each level, probes, tables)
SETTINGS = {1: (1.8, 1, 1, 9), 2: (2.4, 1, 1, 15), 3: (3.2, 1, 1, 17)}
#: Rows up to which a number of levels is used.
ROWS = {1: 1 << 20, 2: 1 << 25}
SIGNS = 128
#: Unequal signs up to which vectors of many dimensions are compared: over six standard errors.
UNEQUAL = 34
#: Numbers in the matrix of a block.
BLOCK = 1 << 18
#: Numbers of the vectors that are sent in a round, if a table has fewer.
SENT = 1 << 26
#: Rows compared with others at once, and numbers of the vectors held at once.
STRIP, HELD = 256, 1 << 19
#: Numbers of the vectors that are packed or unpacked at once.
PACKED = 1 << 22
SEED = 20250301


@cache
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: (+-1, +-1, 0, ...) and (+-1/2, ...) with even signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest whole points with an even sum (D8), of points in columns."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(axis=0) % 2)
    if len(odd):
        rest = x[:, odd] - r[:, odd]
        worst = np.abs(rest).argmax(axis=0)
        r[worst, odd] += np.where(rest[worst, np.arange(len(odd))] >= 0, 1.0, -1.0)
    return r


def in_columns(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8, the union of D8 and D8 + 1/2, of points in columns."""
    a, b = nearest_even(x), nearest_even(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=0) <= ((x - b) ** 2).sum(axis=0)
    return np.where(nearer, a, b)


def decoded(x: np.ndarray) -> np.ndarray:
    """``in_columns`` of points in rows."""
    return in_columns(np.ascontiguousarray(x.T)).T


def least_step(rest: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the least costly of the 240 steps adds to the squared distance, and its hash, for points
    in columns at ``rest`` from their home: two steps of one along the largest coordinates, or eight
    of a half, of which the least goes against its sign if an odd number is negative."""
    size, at = np.abs(rest), np.arange(rest.shape[1])
    signed = np.where(rest < 0, -1, 1) * weights[:, None]
    small = size.argmin(axis=0)
    odd = (rest < 0).sum(axis=0) % 2 == 1
    halves = size.sum(axis=0) / 2 - np.where(odd, size[small, at], 0)
    by_halves = signed.sum(axis=0) - np.where(odd, 2 * signed[small, at], 0)
    large = size.argmax(axis=0)
    ones, by_ones = size[large, at], signed[large, at]
    size[large, at] = -1
    large = size.argmax(axis=0)
    ones, by_ones = ones + size[large, at], 2 * (by_ones + signed[large, at])
    return 2 - 2 * np.maximum(ones, halves), np.where(ones >= halves, by_ones, by_halves)


@cache
def projections(dim: int, levels: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tables, dim, 8 * levels) projections, shifts, hash weights, and those of the signs."""
    rng = np.random.default_rng([SEED, dim, levels])
    out = []
    for _ in range(tables):
        g = rng.normal(size=(dim, 8 * levels))
        out.append(np.linalg.qr(g)[0] * dim**0.5 if dim >= 8 * levels else g)
    shifts = rng.random((tables, 8 * levels)) * 2
    weights = rng.integers(1, 1 << 62, (tables, levels, 8), dtype=np.int64) | 1
    return np.array(out), shifts, weights, rng.normal(size=(dim, SIGNS))


def cells(unit: np.ndarray, at: int, levels: int, tables: int, scale: float, steps: int, probes: int) -> np.ndarray:
    """The home cell of each vector in a table and the probed ones, as hashes (n x up to 1 + probes)."""
    project, shifts, weights, _ = projections(unit.shape[1], levels, tables)
    # singles from here on, after the only step whose last bits depend on the other rows
    points = np.ascontiguousarray((unit @ project[at] / scale + shifts[at]).T.astype(np.float32))
    cost = hashes = None
    for level in range(levels):
        x = points[8 * level : 8 * level + 8]
        home = in_columns(x)
        if steps == 1:
            price, step = (v[:, None] for v in least_step(x - home, weights[at, level]))
        else:
            gain = (x - home).T @ neighbours().T
            best = np.argpartition(-gain, steps, axis=1)[:, :steps]
            price = 2 - 2 * np.take_along_axis(gain, best, 1)  # what a step adds to the squared distance
            step = ((2 * neighbours()).astype(np.int64) @ weights[at, level])[best]
        price = np.concatenate([np.zeros((len(price), 1), price.dtype), price], axis=1)
        h = ((2 * home).astype(np.int64) * weights[at, level][:, None]).sum(axis=0)[:, None]
        h = np.concatenate([h, h + step], axis=1)
        if cost is None:
            cost, hashes = price, h
        else:
            cost = (cost[:, :, None] + price[:, None, :]).reshape(len(price), -1)
            hashes = (hashes[:, :, None] * 1_000_003 + h[:, None, :]).reshape(len(price), -1)
    least = np.argsort(cost, axis=1, kind="stable")[:, : probes + 1]  # staying costs nothing, so home is first
    return np.take_along_axis(hashes, least, 1)


def places(unit: np.ndarray, at: int, levels: int) -> np.ndarray:
    """``cells`` of a table, apart from those of other tables and lengths."""
    scale, steps, probes, tables = SETTINGS[levels]
    found = cells(unit, at, levels, tables, scale, steps, probes)
    return found + np.array([at]) * 0x9E3779B97F4A7C1 + np.array([unit.shape[1]]) * 0xC2B2AE3D27D4EB


def keep_memory() -> None:
    """Have the C library keep freed memory from now on (as it does once 32 MB were freed at once):
    else each table of numbers is mapped anew, which costs several times as much as filling it."""
    np.empty(1 << 25, np.uint8)


def unit_vectors(x: np.ndarray) -> np.ndarray:
    """The rows as unit vectors in doubles; NaN if they are zero."""
    x = x.astype(np.float64)
    with np.errstate(invalid="ignore"):
        x /= np.abs(x).max(axis=1)[:, None]  # first, so that squares neither overflow nor vanish
        return x / np.sqrt((x * x).sum(axis=1))[:, None]


def lengths(column: pa.Array) -> np.ndarray:
    """Where each value of a column of bytes starts, and the last one ends."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]


def matrices(column: pa.Array, kind: str, held: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of a column of bytes by their length: (rows, matrix), in order and in parts."""
    at = lengths(column)
    flat = np.frombuffer(column.buffers()[2], np.uint8)
    size = np.diff(at)
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        most = max(1, (held or HELD) * np.dtype(kind).itemsize // int(n))
        for first in range(0, len(rows), most):
            some = rows[first : first + most]
            if len(rows) == len(size):
                yield some, flat[at[some[0]] : at[some[-1] + 1]].view(kind).reshape(len(some), -1)
            else:
                yield some, flat[at[some][:, None] + np.arange(n)].view(kind)


def keyed(vectors: DataFrame, kind: str) -> DataFrame:
    """vec_id, key (a digest of the unit vector) and v, the bytes of the vector; null if it can't
    be compared or has no vec_id; v is empty then."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        for batch in batches:
            lists = batch.column(1)
            key, flat, at = [None] * batch.num_rows, lists.values, lists.offsets.to_numpy()
            numbers = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(batch.num_rows), np.diff(at))
            numbers = numbers[at[0] : at[-1]]
            fine = np.bincount(of, numbers != 0, batch.num_rows) > 0
            fine &= np.bincount(of, ~np.isfinite(numbers), batch.num_rows) == 0
            fine &= ~batch.column(0).is_null().to_numpy(zero_copy_only=False)
            size = np.where(fine, np.diff(at), 0)
            numbers = numbers[fine[of]].astype(kind)
            begin = np.concatenate([[0], np.cumsum(size)])
            for n in np.unique(size[size > 0]):
                rows = np.flatnonzero(size == n)
                most = max(1, HELD // int(n))
                for first in range(0, len(rows), most):
                    some = rows[first : first + most]
                    u = unit_vectors(numbers[begin[some][:, None] + np.arange(n)]) + 0.0  # one zero only
                    data, width = u.tobytes(), 8 * int(n)
                    for k, i in enumerate(some.tolist()):
                        key[i] = blake2b(data[k * width : (k + 1) * width], digest_size=16).digest()
            ends = pa.py_buffer((begin * np.dtype(kind).itemsize).astype(np.int32))
            v = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends, pa.py_buffer(numbers)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key, pa.binary()), v], ["vec_id", "key", "v"])

    id_kind = vectors.schema["vec_id"].dataType.simpleString()
    v = F.col("embedding").cast("array<float>" if kind == "f4" else "array<double>")
    return vectors.select("vec_id", v.alias("v")).mapInArrow(digest, f"vec_id {id_kind}, key binary, v binary")


def gathered(batches: Iterator[pa.RecordBatch], kind: str, column: int) -> Iterator[pa.RecordBatch]:
    """Larger batches, of about PACKED numbers in a column of vectors."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= PACKED * np.dtype(kind).itemsize:
            yield pa.concat_batches(held)
            held, size = [], 0
    if size:
        yield pa.concat_batches(held)


def placed(x: np.ndarray, tables: range, levels: int) -> list[np.ndarray]:
    """``places`` in each of the tables."""
    found = [[] for _ in tables]
    for k in range(0, len(x), 1024):
        unit = unit_vectors(x[k : k + 1024])
        for t, out in zip(tables, found):
            out.append(places(unit, t, levels))
    return [np.concatenate(out) for out in found]


def counted(classes: DataFrame, levels: int, kind: str) -> DataFrame:
    """cell, t (its table), n (rows sent to it) of the cells with more rows than two blocks hold, parts."""
    tables = SETTINGS[levels][3]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        for batch in gathered(batches, kind, 0):
            for _, x in matrices(batch.column(0), kind, PACKED):
                for t, cell in enumerate(placed(x, range(tables), levels)):
                    cell, n = np.unique(cell, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell), pa.array(np.full(len(cell), t, np.int32)), pa.array(np.full(len(cell), x.shape[1], np.int32)), pa.array(n)],
                        ["cell", "t", "dim", "n"],
                    )

    found = classes.select("v").mapInArrow(count, "cell bigint, t int, dim int, n bigint")
    found = found.groupBy("cell", "t", "dim").agg(F.sum("n").alias("n"))
    most = F.greatest(F.lit(1), F.floor(F.lit(BLOCK) / F.col("dim")))
    return found.filter(F.col("n") > 2 * most).select("cell", "t", "n", F.ceil(F.col("n") / most).alias("parts"))


def sent(classes: DataFrame, levels: int, kind: str, tables: range, cut: dict, groups: int, share: int, shares: int) -> DataFrame:
    """grp, dim, pack: the vectors with the units they are sent to by some tables, packed by group of
    units and length; one share of the units. cut: by table, the cells that are cut and their parts.

    A row for each of them would cost several times as much as the comparison."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        for batch in gathered(batches, kind, 2):
            for rows, x in matrices(batch.column(2), kind, PACKED):
                node, weight = (batch.column(c).to_numpy()[rows] for c in range(2))
                for t, cell in zip(tables, placed(x, tables, levels)):
                    role = np.zeros(cell.shape, np.int32) + 8 * t
                    role[:, 0] += 4
                    row = np.repeat(np.arange(len(x)), cell.shape[1])
                    yield from dealt(t, row, cell.ravel(), role.ravel(), node, weight, x)

    def dealt(t, row, cell, role, node, weight, x) -> Iterator[pa.RecordBatch]:
        parts = np.ones(len(row), np.int64)
        if t in cut:
            cells, n = cut[t]
            at = np.minimum(np.searchsorted(cells, cell), len(cells) - 1)
            parts = np.where(cells[at] == cell, n[at], 1)
        ends, first = np.cumsum(parts), 0
        while first < len(row):  # a cell of many blocks gets its rows as many times
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + 2 * len(row), "right")))
            some = np.repeat(np.arange(first, last), parts[first:last])
            other = np.arange(len(some)) - np.repeat(ends[first:last] - parts[first:last] - (ends[first - 1] if first else 0), parts[first:last])
            at, of, k = row[some], cell[some], parts[some]
            part = (mixed(node[at].view(U)) % k.view(U)).view(np.int64)
            first = last
            pair = (np.minimum(part, other) << 32 | np.maximum(part, other)).view(U)
            unit = np.where(k > 1, (of.view(U) ^ mixed(pair + U(1))).view(np.int64), of)
            side = np.where((k == 1) | (part == other), 2, part > other)
            hashed = mixed(unit.view(U))
            group = (hashed % U(groups)).astype(np.int32)
            of_share = np.flatnonzero((hashed >> U(40)) % U(shares) == U(share))
            order = of_share[np.argsort(group[of_share], kind="stable")]
            if not len(order):
                continue
            group, at = group[order], at[order]
            columns = unit[order], (role[some] + side)[order].astype(np.int32), node[at], weight[at], x[at]
            ends_of = np.flatnonzero(np.diff(group, append=-1)) + 1
            begins = np.concatenate([[0], ends_of[:-1]])
            packs = [b"".join(c[a:z].tobytes() for c in columns) for a, z in zip(begins.tolist(), ends_of.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(group[begins]), pa.array(np.full(len(packs), x.shape[1], np.int32)), pa.array(packs, pa.binary())], ["grp", "dim", "pack"]
            )

    return classes.select("node", "weight", "v").mapInArrow(send, "grp int, dim int, pack binary")


def unpacked(packs: list[bytes], dim: int, kind: str) -> list[np.ndarray]:
    """unit, role, node, weight and vectors of packs of one length."""
    kinds = [np.int64, np.int32, np.int64, np.int64, np.dtype((kind, (dim,)))]
    out = [[] for _ in kinds]
    for pack in packs:
        n, at = len(pack) // sum(np.dtype(k).itemsize for k in kinds), 0
        for column, k in zip(out, kinds):
            column.append(np.frombuffer(pack, k, n, at))
            at += n * np.dtype(k).itemsize
    return [np.concatenate(c) for c in out]


def compared(packs: DataFrame, levels: int, kind: str, cosine: float) -> DataFrame:
    """node, n (rows linked with it) and root (smallest node of its component), by unit; links that
    an earlier table has met are left out."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        held, group = {}, None
        for batch in batches:
            for of, dim, pack in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if of != group:
                    yield from found(held)
                    held, group = {}, of
                held.setdefault(dim, []).append(pack)
        yield from found(held)

    def found(held: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        for dim, packs in held.items():
            unit, role, node, weight, x = unpacked(packs, dim, kind)
            packs.clear()
            order = np.lexsort((role // 4 % 2 == 0, unit))  # homes first
            unit = unit[order]
            starts = np.concatenate([[0], np.flatnonzero(unit[1:] != unit[:-1]) + 1, [len(unit)]])
            k = 0
            while k < len(starts) - 1:  # whole units, up to HELD numbers or one unit
                end = max(k + 1, int(np.searchsorted(starts, starts[k] + HELD // dim, "right")) - 1)
                some = order[starts[k] : starts[end]]
                out = links(unit[starts[k] : starts[end]], role[some], node[some], weight[some], x[some], starts[k : end + 1] - starts[k])
                if out is not None:
                    yield out
                k = end

    def links(unit, role, node, weight, x, starts) -> pa.RecordBatch | None:
        dim = x.shape[1]
        table_of, home, side = role // 8, role // 4 % 2 == 1, role % 4
        narrow = (x / np.abs(x).max(axis=1)[:, None]).astype(np.float32)
        narrow /= np.sqrt((narrow * narrow).sum(axis=1))[:, None]
        low = np.float32(cosine - (dim + 4) * 2.0**-23)  # no single is below it if its double reaches the cosine
        bits = None
        if dim > SIGNS:
            signs = projections(dim, levels, SETTINGS[levels][3])[3]
            bits = np.packbits(narrow @ signs > 0, axis=1).view(np.uint64)
        tables_of, pairs, first = [], [], 0  # links as tables where they are dense, else as pairs
        while first < len(unit):  # small units are multiplied together
            last = int(starts[min(np.searchsorted(starts, first + STRIP), len(starts) - 1)])
            for a in range(first, last, STRIP):
                b = min(a + STRIP, last)
                if not home[a:b].any():  # the probes of a large unit
                    continue
                if bits is None:
                    near, bar = narrow[a:b] @ narrow[a:last].T, low
                else:
                    near = -sum(np.bitwise_count(bits[a:b, None, w] ^ bits[None, a:last, w]).astype(np.int16) for w in range(SIGNS // 64))
                    bar = -UNEQUAL
                near[:, : b - a] -= before(b - a, near.dtype.str)
                highest = near.max(axis=1)
                i = np.flatnonzero(highest >= bar)
                if not len(i):
                    continue
                near = near[i]
                j = np.flatnonzero(near.max(axis=0) >= bar)
                near = near[:, j]
                i, j = i + a, j + a
                link = (near >= bar) & (unit[i][:, None] == unit[j])
                link &= (home[i][:, None] | home[j]) & ((side[i][:, None] != side[j]) | (side[j] == 2)) & (node[i][:, None] != node[j])
                k = np.count_nonzero(link)
                if 0 < 8 * k < link.size:
                    ri, rj = np.nonzero(link)
                    pairs.append((i[ri], j[rj]))
                elif k:
                    tables_of.append((i, j, link))
            first = last
        out, some = [], np.zeros(len(unit), bool)
        for i, j, *_ in pairs + tables_of:
            some[i] = some[j] = True
        u = np.empty(x.shape)
        u[some] = unit_vectors(x[some])
        tables_of = [(i, j, link & (u[i] @ u[j].T >= cosine)) for i, j, link in tables_of]
        if pairs:
            i, j = (np.concatenate(p) for p in zip(*pairs))
            reached = np.concatenate([(u[i[k : k + 4096]] * u[j[k : k + 4096]]).sum(axis=1) >= cosine for k in range(0, len(i), 4096)])
            i, j = (np.concatenate(p) for p in list(zip(*unmet([(i[reached], j[reached], None)], u, table_of, home)))[:2])
            n = np.bincount(i, weight[j], len(unit)) + np.bincount(j, weight[i], len(unit))
            root, was = node.copy(), None
            while was is None or (root != was).any():
                was = root.copy()
                least = np.minimum(root[i], root[j])
                np.minimum.at(root, i, least)
                np.minimum.at(root, j, least)
            some = np.flatnonzero(n)
            out.append((node[some], n[some], root[some]))
        for i, j, link in unmet(tables_of, u, table_of, home):
            ri, rj = roots(link, node[i], node[j])
            times = link.astype(np.float64)
            for nodes, n, root in ((node[i], times @ weight[j], ri), (node[j], times.T @ weight[i], rj)):
                out.append((nodes[n > 0], n[n > 0], root[n > 0]))
        if not out:
            return None
        nodes, n, root = (np.concatenate(x) for x in zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array(n.astype(np.int64)), pa.array(root, pa.int64())], ["node", "n", "root"]
        )

    def unmet(met, u, table_of, home):
        """The links (i, j, table of all of i by all of j, or None for pairs) that no earlier table has
        met, nor the other of two cells of the same table."""
        last = max((int(table_of[i].max()) for i, _, _ in met if len(i)), default=-1)
        at = np.zeros(len(u), np.int64)
        for t in range(last + 1):
            due, left = [], []
            for i, j, link in met:
                now = table_of[i] >= t
                if link is None:
                    left.append((i[~now], j[~now], None))
                    due.append((i[now], j[now], None))
                else:
                    (due if now.any() else left).append((i, j, link))
            some = np.zeros(len(u), bool)
            for i, j, _ in due:
                some[i] = some[j] = True
            some = np.flatnonzero(some)
            if not len(some):
                break
            at[some] = np.arange(len(some))
            h = places(u[some], t, levels)
            for i, j, link in due:
                a, b = (i, j) if link is None else (i[:, None], j[None, :])
                ha, hb = h[at[a]], h[at[b]]
                of, own = table_of[a], home[a]
                both = ha[..., 0] == hb[..., 0]
                by_a = (ha[..., 1:] == hb[..., :1]).any(axis=-1)
                by_b = (ha[..., :1] == hb[..., 1:]).any(axis=-1)
                # where each probes the home of the other, the pair counts in the smaller cell
                larger = np.where(own, ha[..., 0] > hb[..., 0], hb[..., 0] > ha[..., 0])
                gone = (of > t) & (both | by_a | by_b) | (of == t) & ~both & by_a & by_b & larger
                if link is None:
                    left.append((i[~gone], j[~gone], None))
                elif (link := link & ~gone).any():
                    rows, columns = link.any(axis=1), link.any(axis=0)
                    left.append((i[rows], j[columns], link[np.ix_(rows, columns)]))
            met = left
        return met

    return packs.mapInArrow(compare, "node bigint, n bigint, root bigint")


@cache
def before(n: int, kind: str) -> np.ndarray:
    """Takes the pairs of a square that aren't in order out of any bar."""
    return np.tri(n, dtype=kind) * np.dtype(kind).type(4 * SIGNS)


def roots(link: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest node that each row and column of a table of links can reach."""
    none = np.iinfo(np.int64).max
    ra, rb = na.copy(), nb.copy()
    while True:
        before = ra.copy(), rb.copy()
        ra = np.minimum(ra, np.where(link, rb, none).min(axis=1))
        rb = np.minimum(rb, np.where(link, ra[:, None], none).min(axis=0))
        if (ra == before[0]).all() and (rb == before[1]).all():
            return ra, rb


def linked(classes: DataFrame, levels: int, kind: str, cosine: float, n: int, longest: int) -> list[DataFrame]:
    """node, n, root of all tables (see ``compared``), in rounds."""
    _, _, probes, tables = SETTINGS[levels]
    rows, more, hot, out = n * (1 + probes), {}, None, []
    if n > 2 * max(1, BLOCK // longest):  # else no cell has as many
        hot = compact(counted(classes, levels, kind))
        extra = F.sum(F.col("n") * (F.col("parts") - 1))  # a row goes to as many units as its cell has blocks
        more = dict(map(tuple, hot.groupBy("t").agg(extra).collect()))
    first, most, spark = 0, max(1, SENT // longest, rows * 5 // 4), classes.sparkSession
    while first < tables:
        last, total = first + 1, rows + more.get(first, 0)
        while last < tables and total + rows + more.get(last, 0) <= most:
            total, last = total + rows + more.get(last, 0), last + 1
        cut = {}
        for t in [t for t in range(first, last) if t in more]:
            of = sorted(map(tuple, hot.filter(F.col("t") == t).select("cell", "parts").collect()))
            cut[t] = tuple(np.array(of, np.int64).T)
        shares = max(1, -(-total // most))
        groups = max(4 * spark.sparkContext.defaultParallelism, -(-total * longest // shares // PACKED))
        for share in range(shares):
            with rows_a_batch(spark):  # a row is a pack
                some = sent(classes, levels, kind, range(first, last), cut, groups, share, shares)
                some = some.repartition("grp").sortWithinPartitions("grp")
                out.append(compact(compared(some, levels, kind, cosine), 4))
            del some
            give_back(spark)
        first = last
    return out


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, levels: int | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    kind = "f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "f8"
    rows = settle(keyed(vectors, kind).withColumn("node", F.monotonically_increasing_id()))
    fine = rows.filter("key IS NOT NULL")
    reps = fine.groupBy("key").agg(
        F.min("node").alias("node"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least")
    )
    reps = compact(reps, 4)
    again = reps.filter("weight > 1").select("key", F.col("node").alias("first"), "weight")
    classes = fine.join(small(again), "key", "left").filter("first IS NULL OR node = first")
    classes = settle(classes.select("node", F.coalesce("weight", F.lit(1)).alias("weight"), "v"))
    ids = settle(rows.select("vec_id", "key"))
    remove(rows)
    n, longest = classes.agg(F.count(F.lit(1)), F.max(F.octet_length("v"))).first()
    if levels is None:
        levels = next((k for k, most in ROWS.items() if n <= most), max(SETTINGS))
    give_back(vectors.sparkSession)
    parts = linked(classes, levels, kind, cosine, n, (longest or 8) // np.dtype(kind).itemsize)
    remove(classes)
    found = reduce(DataFrame.unionByName, parts)
    links = found.groupBy("node").agg(F.sum("n").alias("n"))
    labels = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    named = labelled(reps, labels, "node", "root")
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(least, "root").join(links, "node", "left")
    named = compact(named.select("key", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"), "component"), 4)
    for part in parts:
        remove(part)
    out = ids.join(named, "key", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


#: Exact, by all pairs; for small tables only.
DEDUP_SQL = f"""WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE list_dot_product(e, e) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_dot_product(a.e, b.e) >= {COSINE} * a.n * b.n),
r(vec_id, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.v, r.c FROM r JOIN l ON l.u = r.vec_id),
c AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY vec_id),
k AS (SELECT u AS vec_id, count(*) AS k FROM l GROUP BY u)
SELECT vec_id, coalesce(k, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN k USING (vec_id)"""


@query("op11_embedding_dedup", DEDUP_SQL)
def op11_embedding_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))
