"""Exact top-k by inner product with a KD-tree per shard.

Vectors are scaled to integers and dealt into shards of about ``SHARD`` by hash. In each
shard a KD-tree splits at medians of the widest component down to leaves, and keeps the
tight box of every node; trees are built once and written as a table. For a query the largest
inner product within a box bounds all its vectors, so nodes are visited best first, and the
search ends when no open box can beat the k-th best.

Queries come in blocks of about ``QUERIES``. A block is handed to the tasks that hold trees,
first each query to one shard only; the k-th scores of that round are then handed to all
other shards, so most of their boxes are never opened. What travels is a block, not the
vectors, and its size is fixed; the driver holds one block and its k-th scores.

Defined results
* Vectors that are null or hold null or non-finite components take no part, and neither do
  queries of that kind or with a null id. Vectors meet only vectors of their own length;
  an empty vector scores 0 with others of its kind.
* Rows with the query's vec_id are the query's own. If an id has several query vectors, a
  candidate's best score with any of them counts, and it takes one rank; rows that repeat a
  candidate are candidates of their own.
* Ties go to the smaller vec_id, a null one last. Scores beyond 64 bits are cut to them.
* An empty table gives an empty result; other columns are ignored.
"""

import heapq
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from epiframe.llm.common import compact, query, rows_a_batch, settle, table

K = 10
EVERY = 100
SCALE = 1024
SHARD = 4096
QUERIES = 1 << 15
SLICE = 1024
LEAF = 32
EXACT = 2.0**53
LONG = 2**63 - 1


def scaled(vectors: DataFrame) -> DataFrame:
    """vec_id, v (whole numbers as doubles), dim; only whole, finite vectors."""
    v = F.col("embedding").cast("array<double>")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(fine).select("vec_id", v.alias("v"))
    # floor by the largest double below: doubles of 2**53 and more are whole already
    whole = F.transform("v", lambda x: F.when(F.abs(x * SCALE) < EXACT, F.floor(x * SCALE).cast("double")).otherwise(x * SCALE))
    return rows.select("vec_id", whole.alias("v"), F.size("v").alias("dim"))


class Tree:
    """Nodes in arrays: box, children (or -1) and the range of rows below."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.low, self.high, self.left, self.right, self.rows = [], [], [], [], []
        self.points = points
        self.build(0, len(points))
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.points = points[self.order]

    def build(self, a: int, z: int) -> int:
        node, here = len(self.rows), self.points[self.order[a:z]]
        low, high = here.min(axis=0), here.max(axis=0)
        self.low.append(low), self.high.append(high)
        self.left.append(-1), self.right.append(-1), self.rows.append((a, z))
        if z - a > LEAF and (high > low).any():
            middle = (z - a) // 2
            split = np.argpartition(here[:, (high - low).argmax()], middle)
            self.order[a:z] = self.order[a:z][split]
            self.left[node] = self.build(a, a + middle)
            self.right[node] = self.build(a + middle, z)
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product that each box allows each query, queries x nodes."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T


def products(points: np.ndarray, q: np.ndarray, exact: bool) -> list:
    if exact:
        return (points @ q).tolist()
    whole = [int(x) for x in q.tolist()]
    return [sum(int(x) * y for x, y in zip(p, whole)) for p in points.tolist()]


def search(tree: Tree, ids: list, q: np.ndarray, own, bounds: np.ndarray, kth: float, k: int) -> list:
    """The k best (score, -id rank, id) of the shard that reach ``kth``, best first."""
    exact = len(q) == 0 or float(np.abs(q).max()) * float(np.abs(tree.points).max()) * len(q) < EXACT
    slack = 0.0 if exact else float("inf")  # rounded bounds prune nothing
    best: list = []
    heap = [(-bounds[0], 0)]
    while heap:
        bound, node = heapq.heappop(heap)
        if -bound + slack < kth:
            break
        if tree.left[node] >= 0:
            for child in (tree.left[node], tree.right[node]):
                if bounds[child] + slack >= kth:
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        a, z = tree.rows[node]
        for row, score in zip(range(a, z), products(tree.points[a:z], q, exact)):
            i = ids[tree.order[row]]
            if score < kth or i == own:
                continue
            item = (int(score), float("-inf") if i is None else -i, row, i)
            if len(best) < k:
                heapq.heappush(best, item)
            elif item > best[0]:
                heapq.heapreplace(best, item)
            if len(best) == k:
                kth = max(kth, best[0][0])
    return sorted(best, reverse=True)


_ARRAYS = {"points": "f8", "low": "f8", "high": "f8", "left": "i4", "right": "i4", "rows": "i4", "order": "i4"}
_TREE = ", ".join(f"{c} binary" for c in _ARRAYS)


def grow(pdf):
    """One row with the tree of a shard."""
    import pandas as pd

    points = np.stack(pdf["v"].to_numpy()).reshape(len(pdf), -1)
    points = points if points.shape[1] else np.zeros((len(points), 1))
    tree = Tree(points)
    packed = {c: [np.ascontiguousarray(getattr(tree, c), "<" + kind).tobytes()] for c, kind in _ARRAYS.items()}
    ids = [None if pd.isna(i) else int(i) for i in pdf["vec_id"]]
    own = {"dim": [int(pdf["dim"].iloc[0])], "shard": [int(pdf["shard"].iloc[0])]}
    return pd.DataFrame({**own, "ids": [ids], "items": [pdf["item"].tolist()], **packed})


def planted(rows: DataFrame, shards: int) -> DataFrame:
    """The table of trees, one for each length of vectors and shard."""
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(shards)).cast("long"))
    return dealt.groupBy("dim", "shard").applyInPandas(
        grow, f"dim int, shard long, ids array<bigint>, items array<bigint>, {_TREE}"
    )


def opened(row: dict) -> Tree:
    tree = Tree.__new__(Tree)
    for c, kind in _ARRAYS.items():
        setattr(tree, c, np.frombuffer(row[c], "<" + kind))
    width = max(1, row["dim"])
    tree.points, tree.low, tree.high = (x.reshape(-1, width) for x in (tree.points, tree.low, tree.high))
    tree.rows = tree.rows.reshape(-1, 2)
    return tree


def searched(trees: DataFrame, block: dict, kth: np.ndarray | None, shards: int, k: int) -> DataFrame:
    """query_id, item, vec_id, score of the candidates of a block: without ``kth`` from each
    query's home shard, with it from the other shards, as far as they reach it."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                home = block["home"] == row["shard"]
                mine = np.flatnonzero((block["dim"] == row["dim"]) & (home if kth is None else ~home))
                tree, out = opened(row), []
                for a in range(0, len(mine), SLICE):
                    some = mine[a : a + SLICE]
                    q = np.stack([block["v"][j] for j in some]).reshape(len(some), -1)
                    q = q if q.shape[1] else np.zeros((len(q), 1))
                    with np.errstate(over="ignore", invalid="ignore"):
                        bounds = np.nan_to_num(tree.bounds(q), nan=np.inf, posinf=np.inf)
                    for j, v, b in zip(some.tolist(), q, bounds):
                        own, least = int(block["id"][j]), float("-inf") if kth is None else float(kth[j])
                        for score, _, at, found in search(tree, row["ids"], v, own, b, least, k):
                            item = row["items"][tree.order[at]]
                            out.append((own, item, found, max(-LONG - 1, min(LONG, score))))
                columns = list(zip(*out)) if out else [[]] * 4
                names = ["query_id", "item", "vec_id", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return trees.mapInArrow(run, "query_id bigint, item bigint, vec_id bigint, score bigint")


def kept_best(found: DataFrame, k: int) -> DataFrame:
    """The k best candidates of each query, each with its best score."""
    best = found.groupBy("query_id", "item", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "item")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, shard_rows: int = SHARD, block: int = QUERIES) -> DataFrame:
    """One row per query and rank: query_id, rank, vec_id, score. ``is_query`` is over vec_id."""
    rows = settle(scaled(vectors).withColumn("item", F.monotonically_increasing_id()))
    asked = rows.filter(is_query & F.col("vec_id").isNotNull()).select("vec_id", "v", "dim").distinct()
    shards = max(1, -(-rows.count() // shard_rows))
    trees = settle(planted(rows, shards))
    blocks = max(1, -(-asked.count() // block))
    asked = settle(asked.select(
        "vec_id", "v", "dim",
        F.pmod(F.xxhash64("vec_id", "v", F.lit("block")), F.lit(blocks)).alias("block"),
        F.pmod(F.xxhash64("vec_id", "v", F.lit("home")), F.lit(shards)).alias("home"),
    ))
    out = []
    for b in range(blocks):
        some = asked.filter(F.col("block") == b).drop("block").toPandas()  # about ``block`` rows
        own = {
            "id": some["vec_id"].to_numpy(np.int64), "dim": some["dim"].to_numpy(), "home": some["home"].to_numpy(),
            "v": [np.asarray(v, float) for v in some["v"]],
        }
        with rows_a_batch(vectors.sparkSession):  # a row is a shard
            seed = compact(kept_best(searched(trees, own, None, shards, k), k))
        full = {r["query_id"]: r["score"] for r in seed.filter(F.col("rank") == k).select("query_id", "score").collect()}
        kth = np.array([full.get(i, float("-inf")) for i in own["id"].tolist()], float)
        kth = np.nextafter(kth, -np.inf)  # a score of more than 53 bits may have been rounded up
        found = searched(trees, own, kth, shards, k).unionByName(seed.drop("rank"))
        with rows_a_batch(vectors.sparkSession):
            out.append(compact(kept_best(found, k)))
    found = reduce(DataFrame.unionByName, out)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query(
    "op10_kdtree_topk",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
)
def op10_kdtree_topk(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
