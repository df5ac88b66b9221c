"""Near-duplicates by b-bit MinHash over five-word shingles.

1. One pass over the texts takes each document's set of shingle hashes, its size, a digest
   of the whole set, 32 band hashes of four minima each, and the two low bits of all 128
   minima, packed as bit planes in four longs. Documents with equal sets form a class; from
   here on the smallest doc_id of a class stands for it.
2. Classes that share a band hash are candidates. Two classes at the threshold share none
   with probability (1 - 0.75**4)**32, about 5e-6. Each band bucket has a leader, the member
   with the fullest buckets; a class is compared with the most similar and the most central
   of its leaders.
3. Similarity is estimated by counting unequal bit pairs and correcting for chance matches;
   a pair goes on if the estimate is within five standard errors of the threshold, and is
   then confirmed on the full sets. Components of confirmed links are merged.
4. The members of a leader's buckets are its family; two classes of one bucket share a
   family. Where a family still holds several components, the members outside the largest
   meet the others in blocks: the packed bits first, then the full sets within the same
   join, which puts out links only. So every candidate pair is within one component already
   or tested, and a group of copies costs two pairs a member, not all pairs.

Nothing is dropped, capped or sampled. Links, labels and sets stay in tables.

Defined results
* A text that is null or has no words has an empty set, n_shingles 0, and is linked with
  nothing. A text of one to four words has one shingle.
* Rows with the same doc_id are one document: what any of its texts is linked with is linked.
* A null doc_id takes no part in linking: component_id is null and kept is true.
* An empty table gives an empty result. Other columns are kept by ``first_of_each`` and
  ignored by ``near_duplicates``.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.llm.common import compact, query, settle, small, table
from epiframe.llm.scan import Texts, U, as_bytes, batches, mixed, windows

SHINGLE = 5
HASHES = 128
BANDS = 32
BITS = 2
PLANES = BITS * HASHES // 64
PERCENT = 75
ERRORS = 5
BLOCK = 256
BATCH = 1 << 18

_rng = np.random.default_rng(20240607)
_XOR = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_ODD = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) << U(1) | U(1)


def most_unequal(percent: int = PERCENT, errors: float = ERRORS) -> int:
    """Unequal minima, by low bits, up to which a pair may still reach the threshold."""
    chance = 1 / 2**BITS
    equal = chance + (1 - chance) * percent / 100
    return int(HASHES * (1 - equal) + errors * (HASHES * equal * (1 - equal)) ** 0.5)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    t = Texts(texts, lower=True)
    words = t.word_hashes()
    out = []
    all_windows = windows(words, SHINGLE)
    for a, z in zip(t.word[:-1].tolist(), t.word[1:].tolist()):
        if z - a >= SHINGLE:
            out.append(np.unique(all_windows[a : z - SHINGLE + 1]))
        else:
            out.append(windows(words[a:z], z - a) + U(z - a) if z > a else np.zeros(0, U))
    return out


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Packed low bits (texts x PLANES) and band hashes (texts x BANDS) of non-empty sets."""
    first = np.cumsum([0] + [len(s) for s in sets[:-1]])
    values = np.concatenate(sets)
    minima = np.empty((HASHES, len(sets)), np.uint32)
    for k in range(HASHES):
        minima[k] = np.minimum.reduceat((((values ^ _XOR[k]) * _ODD[k]) >> U(32)).astype(np.uint32), first)
    minima = minima.T.copy()
    planes = [np.packbits(minima >> p & 1, axis=1).view(np.int64) for p in range(BITS)]
    rows = minima.reshape(len(sets), BANDS, HASHES // BANDS).astype(U)
    band = np.broadcast_to(np.arange(BANDS, dtype=U), rows.shape[:2]).copy()
    for i in range(rows.shape[2]):
        band = mixed(band * U(0xD6E8FEB86659FD93) + rows[:, :, i] + U(1))
    return np.concatenate(planes, axis=1), band.view(np.int64)


def lists(values: np.ndarray, width: int, present: np.ndarray) -> pa.Array:
    """An Arrow list column; rows that are not present are null."""
    offsets = np.concatenate([[0], np.cumsum(present * width)]).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(values.ravel(), pa.int64()), mask=pa.array(~present)
    )


def texts_of(column: pa.Array) -> Iterator[list[bytes]]:
    column = as_bytes(column)
    for s in batches(pa.compute.binary_length(column).to_pylist(), BATCH):
        yield column.slice(s.start, s.stop - s.start).to_pylist()


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, cls (digest of the set), bits, bands; the last three null if empty."""

    def sign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            at = 0
            for texts in texts_of(batch.column(1)):
                sets = shingle_sets(texts)
                present = np.array([len(s) > 0 for s in sets])
                full = [s for s in sets if len(s)]
                bits, bands = signatures(full) if full else (np.zeros(0, np.int64),) * 2
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                        lists(bits, PLANES, present),
                        lists(bands, BANDS, present),
                    ],
                    ["doc_id", "n_shingles", "cls", "bits", "bands"],
                )
                at += len(texts)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        sign, f"doc_id {kind}, n_shingles bigint, cls binary, bits array<bigint>, bands array<bigint>"
    )


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of the documents named in ``nodes``; a task gives equal rows once."""

    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in parts:
            at = 0
            for texts in texts_of(batch.column(1)):
                ids = batch.column(0).slice(at, len(texts)).to_pylist()
                at += len(texts)
                found = []
                for i, s in zip(ids, shingle_sets(texts)):
                    key = i, digest(s)
                    if len(s) and key not in seen:
                        seen.add(key)
                        found.append((i, s.view(np.int64)))
                if found:
                    offsets = np.cumsum([0] + [len(s) for _, s in found]).astype(np.int32)
                    values = pa.array(np.concatenate([s for _, s in found]), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([i for i, _ in found], batch.column(0).type),
                            pa.ListArray.from_arrays(pa.array(offsets), values),
                        ],
                        ["node", "shingles"],
                    )

    rows = docs.select("doc_id", "text").join(
        small(nodes.withColumnRenamed("node", "doc_id")), "doc_id", "left_semi"
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(sets, f"node {kind}, shingles array<bigint>")


def unequal(a: str, b: str) -> Column:
    """Number of minima whose low bits differ."""
    half = HASHES // 64
    words = []
    for w in range(half):
        x = None
        for p in range(BITS):
            i = p * half + w
            d = F.col(f"{a}.bits")[i].bitwiseXOR(F.col(f"{b}.bits")[i])
            x = d if x is None else x.bitwiseOR(d)
        words.append(F.bit_count(x))
    return sum(words[1:], words[0])


def may_link(a: str, b: str) -> Column:
    """The size ratio and the corrected estimate allow the threshold."""
    na, nb = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)) & (unequal(a, b) <= most_unequal())


def reach(a: str, b: str) -> Column:
    """The full sets reach the threshold."""
    a, b = F.col(f"{a}.shingles"), F.col(f"{b}.shingles")
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= PERCENT * (F.size(a) + F.size(b) - both)


def confirmed(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) that reach the threshold on their full sets."""
    pairs = compact(pairs)
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    sets = compact(full_sets(docs, compact(nodes)), 4)
    return (
        pairs.join(sets.alias("a"), F.col("u") == F.col("a.node"))
        .join(sets.alias("b"), F.col("v") == F.col("b.node"))
        .filter(reach("a", "b"))
        .select("u", "v")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of an edge can reach.

    Alternates two star steps, which connect the neighbours of a node to the smallest among
    them, until nothing changes; the number of rounds grows with the logarithm of the size.
    """

    def state(e):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = compact(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while (now := state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct().persist()  # lost blocks come from the written edges
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        out = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = compact(out.union(least.select("u", "m")).distinct())
        large.unpersist()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def labelled(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """Adds the label of ``node``, itself if it has none."""
    labels = labels.select(F.col("node").alias(node), F.col("label").alias(name))
    return rows.join(labels, node, "left").withColumn(name, F.coalesce(name, F.col(node)))


def linked_outside(docs: DataFrame, led: DataFrame) -> DataFrame:
    """Links (u, v) between components, within the classes that share a leader's buckets.

    led: leader, node, label, n_shingles, bits. Classes outside the largest component of a
    leader meet all its classes in blocks. The bits first name the classes with a possible
    partner; only these carry their sets, and a pair leaves the join only as a link.
    """
    per = led.groupBy("leader", "label").agg(F.count(F.lit(1)).alias("k"))
    per = per.groupBy("leader").agg(
        F.sum("k").alias("size"), F.count(F.lit(1)).alias("labels"), F.max(F.struct("k", "label")).alias("main")
    )
    per = per.filter("labels > 1").select("leader", "size", "main.label", "main.k")
    rows = compact(led.join(per.select("leader", "size", F.col("label").alias("main"), "k"), "leader"), 4)
    # a group of the joins is a block of outsiders and a block of all
    outsiders, all_of = F.ceil((F.col("size") - F.col("k")) / BLOCK).cast("int"), F.ceil(F.col("size") / BLOCK).cast("int")

    def own(n, name):
        return F.pmod(F.xxhash64("node", F.lit(name)), n).cast("int").alias(name)

    def each(n, name):
        return F.explode(F.sequence(F.lit(0), n - 1)).alias(name)

    def outer(df):
        return df.select("*", own(outsiders, "bx"), each(all_of, "by"))

    def inner(df):
        return df.select("*", own(all_of, "by"), each(outsiders, "bx"))

    def met(x, y):
        apart = (F.col(f"{x}.label") != F.col(f"{y}.label")) & (
            (F.col(f"{y}.label") == F.col(f"{y}.main")) | (F.col(f"{x}.node") < F.col(f"{y}.node"))
        )
        at = (F.col("x.leader") == F.col("y.leader")) & (F.col("x.bx") == F.col("y.bx")) & (F.col("x.by") == F.col("y.by"))
        return at & apart & may_link(x, y)

    outside = rows.filter("label <> main")
    left = outer(outside).alias("x").join(inner(rows).alias("y"), met("x", "y"), "left_semi")
    right = inner(rows).alias("y").join(outer(outside).alias("x"), met("x", "y"), "left_semi")
    left, right = (compact(d.drop("bx", "by").distinct(), 4) for d in (left, right))
    nodes = left.select("node").union(right.select("node")).distinct()
    sets = compact(full_sets(docs, compact(nodes)), 4)
    left, right = outer(left).join(sets, "node").alias("x"), inner(right).join(sets, "node").alias("y")
    found = left.join(right, met("x", "y") & reach("x", "y"))
    return found.select(F.col("x.node").alias("u"), F.col("y.node").alias("v")).distinct()


def classes_linked(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, label) of the classes linked with others; reps: node, n_shingles, bits, bands."""
    bands = reps.select("node", F.explode("bands").alias("b"))
    shared = bands.groupBy("b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = compact(bands.join(shared, "b"), 4)
    crowd = found.groupBy("node").agg(F.sum("n").alias("crowd"))
    about = reps.select("node", "n_shingles", "bits").join(crowd, "node")
    members = compact(found.join(about, "node"), 4)

    lead = F.struct("crowd", "node", "n_shingles", "bits")
    leaders = members.groupBy("b").agg(F.max(lead).alias("l")).select("b", "l.*")
    near = members.alias("m").join(leaders.alias("l"), "b")
    near = near.filter((F.col("m.node") != F.col("l.node")) & may_link("m", "l"))
    closest = F.min_by("l.node", F.struct(unequal("m", "l"), "l.node"))
    central = F.max_by("l.node", F.struct("l.crowd", "l.node"))
    chosen = near.groupBy(F.col("m.node").alias("u")).agg(F.array(closest, central).alias("v"))
    pairs = chosen.select("u", F.explode(F.array_distinct("v")).alias("v"))
    labels = components(confirmed(docs, pairs))

    led = members.join(leaders.select("b", F.col("node").alias("leader")), "b")
    led = led.select("leader", "node", "n_shingles", "bits").distinct()  # a node with two texts has two rows
    more = compact(linked_outside(docs, compact(labelled(led, labels, "node", "label"), 4)))
    over = labelled(labelled(more, labels, "u", "lu"), labels, "v", "lv")
    merged = components(over.select(F.col("lu").alias("u"), F.col("lv").alias("v")))
    top = merged.select(F.col("node").alias("label"), F.col("label").alias("end"))
    moved = labels.join(top, "label", "left").select("node", F.coalesce("end", "label").alias("label"))
    return moved.unionByName(merged.join(labels, "node", "left_anti"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    rows = settle(signed(docs))
    named = rows.filter("cls IS NOT NULL AND doc_id IS NOT NULL")
    reps = compact(
        named.groupBy("cls").agg(
            F.min("doc_id").alias("node"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bits").alias("bits"),
            F.first("bands").alias("bands"),
        ),
        4,
    )
    labels = classes_linked(docs, reps)
    # documents with several texts link the classes of all of them
    several = named.groupBy("doc_id").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi")
    several = compact(several.select("doc_id"))
    if not several.isEmpty():
        ties = named.select("doc_id", "cls").join(several, "doc_id").join(reps.select("cls", "node"), "cls")
        ties = ties.select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
        labels = components(ties.unionByName(labels.select(F.col("node").alias("u"), F.col("label").alias("v"))))
    of_class = labelled(reps.select("cls", "node"), labels, "node", "component_id").drop("node")
    out = rows.select("doc_id", "n_shingles", "cls").join(of_class, "cls", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def first_of_each(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns; of rows with one doc_id, the one
    with the smallest text. Rows without a doc_id all stay."""
    found = compact(near_duplicates(docs).select("doc_id", "kept"))
    gone = compact(found.filter("NOT kept").select("doc_id").distinct())
    again = found.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    again = compact(again.filter("n > 1").select("doc_id"))
    rest = docs.join(small(gone), "doc_id", "left_anti")
    if again.isEmpty():
        return rest.select(docs.columns)
    twice = rest.join(small(again), "doc_id", "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = twice.groupBy("doc_id").agg(F.min_by(row, F.struct("text")).alias("row")).select("row.*")
    return rest.join(small(again), "doc_id", "left_anti").select(docs.columns).unionByName(one)


#: Exact, by counting shared shingles; for small tables only.
DEDUP_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(2, len(w) - 3)),
    lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w WHERE len(w) > 0),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  l AS (SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
  r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.v, r.c FROM r JOIN l ON l.u = r.doc_id)
  SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id,
    min(r.c) = r.doc_id AS kept FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id"""


@query("op6_minhash_dedup", DEDUP_SQL)
def op6_minhash_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
