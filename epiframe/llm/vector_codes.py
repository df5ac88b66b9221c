"""Vector code compression: one codebook per part, trained over anchors-hierarchy trees.

Vectors are scaled to integers and cut into ``PARTS`` equal parts. They are dealt into shards
of about ``SHARD`` by hash. A shard builds a metric tree for each part position from the
middle out: about sqrt(n) anchors each own the points nearest to them and steal points from
the others, which need not be looked at once they are nearer to their owner than half the way
to the new anchor. Anchors are then merged in pairs, the smallest ball first, up to the root,
and the points of an anchor form a hierarchy of their own below it. Every ball caches the
count and the sum of its points. The trees are written once.

A round walks each tree with the list of codebook entries that may own points of a ball. A
child inherits the list of its parent. An entry leaves it if the whole ball lies on the other
side of the plane half way to the entry nearest to the centre. A ball with one entry left is
wholly owned: its cached sum and count are added. Leaves with several entries compare their
points with those alone. Spark adds up the sums of all shards.

All results are exact: distances between integers are computed in doubles below 2**53 and
with Python's integers beyond, and an entry leaves a list only by a margin above rounding.

What travels: a codebook is PARTS * ENTRIES entries of a part's length, whatever the table
holds; the driver and each task hold one. A row of the tree table is one shard.

Defined results
* Vectors that are null or hold null or non-finite components are dropped. So are vectors
  whose length isn't that of the first codebook row, or isn't a positive multiple of PARTS.
* Codebooks start as the rows of the smallest vec_ids, those with equal ids in the order of
  their vectors, null ids last; with fewer rows there are fewer entries. Equal entries keep
  the lowest index busy, the others stay as they are.
* Repeated rows are coded each. Components beyond 64 bits are cut to them, sums of errors too.
* An empty table gives an empty result; other columns are ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm.common import query, rows_a_batch, settle, table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
SHARD = 2048
LEAF = 16
EXACT = 2.0**53
LONG = 2**63 - 1


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label, x (array of bigint) of the rows that are kept, but for their lengths."""
    v = F.col("embedding").cast("array<double>")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    return vectors.filter(fine).select("vec_id", label.alias("label"), F.transform(v, lambda x: F.floor(x * SCALE).cast("bigint")).alias("x"))


# -- trees ------------------------------------------------------------------------------


def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


def anchors(points: np.ndarray, wanted: int) -> tuple[np.ndarray, list[list]]:
    """The anchors' rows, and of each the [rows, distances] it owns, the furthest first."""
    d = distances(points, points[0])
    order = np.argsort(-d, kind="stable")
    at, owned = [0], [[order, d[order]]]
    while len(at) < wanted:
        widest = max(range(len(at)), key=lambda i: owned[i][1][0])
        if owned[widest][1][0] <= 0:
            break  # only copies of anchors are left
        new = int(owned[widest][0][0])
        apart = distances(points[at], points[new])
        rows, dist = [], []
        for i, (mine, far) in enumerate(owned):
            # owned points nearer than half the way to the new anchor stay without a look
            look = int(np.searchsorted(-far, -apart[i] / 2, side="left"))
            if not look:
                continue
            to_new = distances(points[mine[:look]], points[new])
            gone = to_new < far[:look]
            if gone.any():
                rows.append(mine[:look][gone]), dist.append(to_new[gone])
                stay = np.concatenate([~gone, np.ones(len(mine) - look, bool)])
                owned[i] = [mine[stay], far[stay]]
        rows, dist = np.concatenate(rows), np.concatenate(dist)
        order = np.argsort(-dist, kind="stable")
        at.append(new), owned.append([rows[order], dist[order]])
    return np.array(at), owned


class Tree:
    """Balls in arrays: children (or -1), the range of points, centre, radius, sum."""

    def __init__(self, points: np.ndarray):
        self.points, self.order, self.placed = points, [], 0
        self.left, self.right, self.first, self.last = [], [], [], []
        self.grow(np.arange(len(points)))
        self.order = np.concatenate(self.order)
        self.points = points[self.order]
        self.left, self.right = np.array(self.left, np.int32), np.array(self.right, np.int32)
        self.first, self.last = np.array(self.first, np.int32), np.array(self.last, np.int32)
        run = np.concatenate([np.zeros((1, points.shape[1]), points.dtype), np.cumsum(self.points, axis=0)])
        self.sums = run[self.last] - run[self.first]
        self.centre = self.sums / (self.last - self.first)[:, None]
        spans = zip(self.first.tolist(), self.last.tolist(), self.centre)
        self.radius = np.array([distances(self.points[a:z], c).max() for a, z, c in spans])

    def node(self) -> int:
        for column in (self.left, self.right, self.first, self.last):
            column.append(-1)
        return len(self.left) - 1

    def grow(self, rows: np.ndarray) -> int:
        """Adds the hierarchy of some points and returns its root."""
        wanted = int(np.ceil(len(rows) ** 0.5))
        owned = anchors(self.points[rows], wanted)[1] if len(rows) > LEAF else []
        if len(owned) < 2:  # few points, or all alike
            return self.leaf(rows)
        # the order of points has to follow the tree, so balls are merged before they are filled
        plan = merged([self.points[rows[mine]] for mine, _ in owned])
        return self.fill(plan, [rows[mine] for mine, _ in owned])

    def leaf(self, rows: np.ndarray) -> int:
        n = self.node()
        self.first[n], self.last[n] = self.placed, self.placed + len(rows)
        self.placed = self.last[n]
        self.order.append(rows)
        return n

    def fill(self, plan, owned: list[np.ndarray]) -> int:
        if isinstance(plan, int):
            return self.grow(owned[plan])
        n, begin = self.node(), self.placed
        self.left[n] = self.fill(plan[0], owned)
        self.right[n] = self.fill(plan[1], owned)
        self.first[n], self.last[n] = begin, self.placed
        return n


def merged(balls: list[np.ndarray]):
    """Pairs of pairs of ball numbers: the two whose joint ball is smallest meet first."""
    k = len(balls)
    count = np.array([len(b) for b in balls], float)
    centre = np.array([b.mean(axis=0) for b in balls])
    radius = np.array([distances(b, c).max() for b, c in zip(balls, centre)])
    plan: list = list(range(k))

    def joint(i):
        """Radius around the common centre of ball i with every other one."""
        share = count / (count + count[i])
        apart = distances(centre, centre[i])
        return np.maximum(apart * share + radius[i], apart * (1 - share) + radius)

    cost = np.array([joint(i) for i in range(k)])
    cost[np.arange(k), np.arange(k)] = np.inf
    for _ in range(k - 1):
        i, j = divmod(int(cost.argmin()), k)
        both = cost[i, j]
        centre[i] = (centre[i] * count[i] + centre[j] * count[j]) / (count[i] + count[j])
        count[i], radius[i], plan[i] = count[i] + count[j], both, (plan[i], plan[j])
        cost[j], cost[:, j], radius[j], count[j] = np.inf, np.inf, np.inf, 1
        gone = np.isinf(cost[i]) & (np.arange(k) != i)
        cost[i] = np.where(gone, np.inf, joint(i))
        cost[i, i] = np.inf
        cost[:, i] = cost[i]
        last = i
    return plan[last]


# -- assignment -------------------------------------------------------------------------


def exact_type(*arrays: np.ndarray) -> type:
    """Doubles if squared distances stay whole in them, else Python's integers."""
    most = max((float(np.abs(a.astype(float)).max()) for a in arrays if a.size), default=0.0)
    return np.float64 if (2 * most) ** 2 * arrays[0].shape[1] < EXACT else object


def nearest(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """For each point the first of the entries with the least distance."""
    if points.dtype == object:
        return np.array([min(range(len(entries)), key=lambda e: ((p - entries[e]) ** 2).sum()) for p in points], np.int64)
    # |p|**2 is the same for all entries
    return ((entries**2).sum(axis=1) - 2 * (points @ entries.T)).argmin(axis=1)


def walk(tree: dict, codebook: np.ndarray, own) -> None:
    """Calls own(first, last, entry, ball) for balls wholly owned, and for runs of leaf points
    own(first, last, entries of the points, None). ``codebook`` has no equal entries."""
    points = tree["points"]
    kind = exact_type(points, codebook)
    if kind is object:
        own(0, len(points), nearest(points.astype(object), codebook.astype(object)), None)
        return
    points, entries = points.astype(float), codebook.astype(float)
    slack = 1e-9 * (1 + float(np.abs(points).max()) + float(np.abs(entries).max())) ** 2 * points.shape[1]
    centre, radius, left, right = tree["centre"], tree["radius"], tree["left"], tree["right"]
    first, last = tree["first"], tree["last"]
    open_ = [(0, np.arange(len(entries)))]
    while open_:
        n, may = open_.pop()
        if len(may) > 1:
            near = entries[may]
            d = ((near - centre[n]) ** 2).sum(axis=1)
            best = int(d.argmin())
            apart = np.sqrt(((near - near[best]) ** 2).sum(axis=1))
            may = may[(d - d[best]) - 2 * radius[n] * apart <= slack]
        if len(may) == 1:
            own(int(first[n]), int(last[n]), int(may[0]), n)
        elif left[n] >= 0:
            open_ += [(int(left[n]), may), (int(right[n]), may)]
        else:
            a, z = int(first[n]), int(last[n])
            own(a, z, may[nearest(points[a:z], entries[may])], None)


def distinct(codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries without later copies, and their indexes, ascending."""
    _, first = np.unique(codebook, axis=0, return_index=True)
    first.sort()
    return codebook[first], first


def shard_sums(tree: dict, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and count of the points of each entry of one part of a shard."""
    entries, index = distinct(codebook)
    sums = np.zeros(codebook.shape, object if tree["sums"].dtype == object else np.int64)
    counts = np.zeros(len(codebook), np.int64)

    def own(a, z, entry, ball):
        if ball is not None:
            sums[index[entry]] += tree["sums"][ball]
            counts[index[entry]] += z - a
        else:
            np.add.at(sums, index[entry], tree["points"][a:z])
            np.add.at(counts, index[entry], 1)

    walk(tree, entries, own)
    return sums, counts


def shard_codes(tree: dict, codebook: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Code and squared distance of every point of one part of a shard, in the rows' order."""
    entries, index = distinct(codebook)
    n = len(tree["points"])
    found = np.zeros(n, np.int64)

    def own(a, z, entry, ball):
        found[a:z] = index[entry]

    walk(tree, entries, own)
    kind = exact_type(tree["points"], codebook)
    away = ((tree["points"].astype(kind) - codebook[found].astype(kind)) ** 2).sum(axis=1)
    codes, errors = np.empty(n, np.int64), np.empty(n, object)
    codes[tree["order"]] = found
    errors[tree["order"]] = [int(e) for e in away]
    return codes, errors


# -- the tree table ---------------------------------------------------------------------

_NODES = {"left": "i4", "right": "i4", "first": "i4", "last": "i4", "order": "i4", "radius": "f8", "centre": "f8", "points": "i8"}
_TREE = "struct<" + ",".join(f"{c}:binary" for c in _NODES) + ">"


def stored(tree: Tree) -> dict:
    return {c: np.ascontiguousarray(getattr(tree, c), "<" + kind).tobytes() for c, kind in _NODES.items()}


def loaded(row: dict, width: int) -> dict:
    tree = {c: np.frombuffer(row[c], "<" + kind) for c, kind in _NODES.items()}
    tree["centre"], tree["points"] = tree["centre"].reshape(-1, width), tree["points"].reshape(-1, width)
    wide = float(np.abs(tree["points"].astype(float)).max()) * len(tree["points"]) >= 2.0**62
    points = tree["points"].astype(object) if wide else tree["points"]
    run = np.concatenate([np.zeros((1, width), points.dtype), np.cumsum(points, axis=0)])
    tree["sums"] = run[tree["last"]] - run[tree["first"]]
    return tree


def planted(rows: DataFrame, parts: int, length: int, shard_rows: int, n: int) -> DataFrame:
    """One row per shard: items (as dealt), and the trees of its parts."""
    shards = max(1, -(-n // shard_rows))

    def grow(pdf):
        import pandas as pd

        x = np.array(pdf["x"].tolist(), np.int64).reshape(len(pdf), parts, length // parts)
        big = float(np.abs(x.astype(float)).max()) * len(x) >= 2.0**53
        trees = [stored(Tree(x[:, p].astype(float) if big else x[:, p])) for p in range(parts)]
        if big:  # a tree over rounded points is as good, the points themselves are whole
            for p, t in enumerate(trees):
                t["points"] = np.ascontiguousarray(x[np.frombuffer(t["order"], "<i4"), p], "<i8").tobytes()
                t["radius"] = (np.frombuffer(t["radius"]) * (1 + 1e-9)).tobytes()
        return pd.DataFrame({"items": [pdf["item"].tolist()], "trees": [trees]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards)))
    dealt = dealt.select("shard", "item", "x").groupBy("shard")
    return dealt.applyInPandas(grow, f"items array<bigint>, trees array<{_TREE}>")


def trees_of(batch, width: int) -> Iterator[tuple[list, list[dict]]]:
    """(items, trees) of the shards of a batch, one at a time."""
    for i in range(batch.num_rows):
        yield batch.column(0)[i].as_py(), [loaded(t, width) for t in batch.column(1)[i].as_py()]


def refined(trees: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round; parts x entries x width."""
    import pyarrow as pa

    width = codebooks.shape[2]

    def run(batches):
        for batch in batches:
            for _, of_parts in trees_of(batch, width):
                out = []
                for p, tree in enumerate(of_parts):
                    sums, counts = shard_sums(tree, codebooks[p])
                    out += [(p, int(e), int(counts[e]), [str(s) for s in sums[e].tolist()]) for e in np.flatnonzero(counts)]
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
                        pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.list_(pa.string())),
                    ],
                    ["part", "entry", "n", "s"],
                )

    found = trees.mapInArrow(run, "part int, entry int, n bigint, s array<string>")
    sums = [F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    out = codebooks.copy()
    with rows_a_batch(trees.sparkSession):  # a row is a shard
        rows = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect()  # parts x entries of them
    for row in rows:
        out[row["part"], row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    return out


def coded(trees: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """item, code, error of every vector."""
    import pyarrow as pa

    width = codebooks.shape[2]

    def run(batches):
        for batch in batches:
            for items, of_parts in trees_of(batch, width):
                codes, errors = zip(*(shard_codes(t, codebooks[p]) for p, t in enumerate(of_parts)))
                text = ["".join(f"{c:02x}" for c in row) for row in np.stack(codes, axis=1).tolist()]
                error = [min(LONG, sum(e)) for e in zip(*errors)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, pa.int64()), pa.array(text, pa.string()), pa.array(error, pa.int64())],
                    ["item", "code", "error"],
                )

    return trees.mapInArrow(run, "item bigint, code string, error bigint")


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compressed(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, shard_rows: int = SHARD
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error of each kept vector; the codebooks, parts x entries x width)."""
    rows = settle(whole_vectors(vectors).withColumn("item", F.monotonically_increasing_id()))
    begin = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(1).select(F.size("x").alias("d")).collect()
    length = begin[0]["d"] if begin else 0
    if not length or length % parts:
        nothing = rows.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
        return nothing, np.zeros((parts, 0, 0), np.int64)
    rows = rows.filter(F.size("x") == length)
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).select("x").collect()
    codebooks = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    trees = settle(planted(rows, parts, length, shard_rows, rows.count()))
    for _ in range(rounds):
        codebooks = refined(trees, codebooks)
    with rows_a_batch(vectors.sparkSession):
        found = settle(coded(trees, codebooks))
    out = rows.select("item", "vec_id", "label").join(found, "item")
    return out.select("vec_id", "label", "code", "error"), codebooks


def codes(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    out, codebooks = compressed(vectors, **options)
    out = settle(out)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG)).cast("bigint")
    by_label = out.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    out = out.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))


def _sql() -> str:
    """Plain rounds over all pairs of parts and entries; for small tables only."""
    dot = "list_dot_product({0}, {1})".format
    away = f"({dot('p.v', 'p.v')} - 2 * {dot('p.v', 'c.v')} + {dot('c.v', 'c.v')})::BIGINT"
    text = f"""WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, label, part, x[part * len(x) // {PARTS} + 1:(part + 1) * len(x) // {PARTS}] AS v FROM k, range({PARTS}) r(part)),
c0 AS (SELECT part, e, v FROM (SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e FROM p) WHERE e < {ENTRIES})"""
    for i in range(ROUNDS + 1):
        text += f""",
a{i} AS (SELECT vec_id, label, part, any_value(p.v) AS v, min({{'d': {away}, 'e': e}}) AS b
  FROM p JOIN c{i} c USING (part) GROUP BY vec_id, label, part)"""
        if i < ROUNDS:
            text += f""",
s{i} AS (SELECT part, e, i, floor(sum(y::HUGEINT) / count(*)) AS y FROM (SELECT part, b.e AS e,
  unnest(range(1, len(v) + 1)) AS i, unnest(v) AS y FROM a{i}) GROUP BY ALL),
m{i} AS (SELECT part, e, list(y ORDER BY i) AS v FROM s{i} GROUP BY part, e),
c{i + 1} AS (SELECT part, e, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (part, e))"""
    return f"""{text},
o AS (SELECT vec_id, label, string_agg(printf('%02x', b.e::INTEGER), '' ORDER BY part) AS code, sum(b.d)::BIGINT AS error
  FROM a{ROUNDS} GROUP BY vec_id, label),
h AS (SELECT sha256(string_agg(list_aggregate(list_transform(v, lambda y: y::BIGINT::VARCHAR), 'string_agg', ','), ',' ORDER BY part, e)) AS h
  FROM c{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM o, h"""


@query("op13_vector_codes", _sql())
def op13_vector_codes(spark, sf_dir):
    return codes(table(spark, sf_dir, "embeddings"))
