"""Mixing sources to target weights by nested hash thresholds.

Every document has a fixed 60-bit hash. For a budget the documents of a source below a
threshold are taken, so a smaller budget takes a subset of what a larger one takes. The
threshold comes from sums of sizes by source and hash bucket: the running sum names the
bucket where the budget ends, only that bucket is summed again by the next bits, and so on
until one hash value is left. Nothing is sorted but at most 1,024 bucket sums per source.

Defined results
* A null text has size 0. A null source is a source of its own, the last one.
* The hash is over the doc_id and the text, so rows with a null or repeated doc_id are taken
  or left one by one; only rows equal in both move together. Sources of size 0 have target 0;
  documents of size 0 take 0 words.
* The document on the threshold is taken if that brings its source nearer to its target, so
  a target is missed by at most half of that document.
* An empty table gives an empty result. Other columns of the input are ignored.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from epiframe.llm.common import WORD, compact, query, same, settle, table

BITS = 60
LEVEL = 10
WEIGHTS = (5, 2, 1)
MOST = 3


def doc_hash(doc_id: Column, text: Column, seed: int) -> Column:
    """A hash in [0, 2**60) that any engine with MD5 can compute."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    key = F.concat(F.lit(f"mix-{seed}:"), name, F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def hashed(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size and the hash ``h``."""
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        doc_hash(F.col("doc_id"), F.col("text"), seed).alias("h"),
    )


def ranked(totals: DataFrame) -> DataFrame:
    """Adds ``rank``, the position of the source by code point, null last.

    Range partitions are numbered apart and shifted by the counts of those before, so any
    number of sources can be ranked; only one row per partition meets in one task.
    """
    order = [F.col("source").isNull(), F.col("source")]
    parts = compact(totals.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1
    return parts.withColumn("rank", within).join(starts, "part").select(
        "source", "source_size", (F.col("rank") + F.col("first")).alias("rank")
    )


def targets(rows: DataFrame, weights: Sequence[float], most: int) -> DataFrame:
    """One row per source: source, source_size, target.

    All words are shared by weight; a target stops at ``most`` times its source's size and
    the excess is shared again among the others, until none is above.
    """
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    t = compact(ranked(totals).withColumn("weight", weight))
    size, w = F.col("source_size"), F.col("weight")
    total, all_w = t.agg(F.sum(size), F.sum(w)).first()
    if not total:
        return t.select("source", "source_size", F.lit(0.0).alias("target"))
    share, last = total / all_w, None
    while share != last:
        above = F.lit(share) * w > most * size
        full, free = t.agg(
            F.sum(F.when(above, most * size).otherwise(0)), F.sum(F.when(~above, w))
        ).first()
        share, last = ((total - full) / free if free else share), share
    target = F.when(F.lit(share) * w > most * size, (most * size).cast("double"))
    return t.select("source", "source_size", target.otherwise(F.lit(share) * w).alias("target"))


def boundary(rows: DataFrame, need: DataFrame, shift: int) -> DataFrame:
    """The bucket of each source in which the budget ends, with the words below it."""
    sums = rows.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(
        F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high")
    )
    run = F.sum("words").over(W.partitionBy("source").orderBy("bucket"))
    sums = sums.withColumn("upto", run).alias("s").join(
        need.alias("n"), same(F.col("s.source"), F.col("n.source"))
    )
    here = F.struct("bucket", (F.col("below") + F.col("upto") - F.col("words")).alias("below"), "words", "low", "high")
    ends = sums.filter(F.col("below") + F.col("upto") >= F.col("need"))
    ends = ends.groupBy("s.source", "need").agg(F.min(here).alias("b"))
    return compact(ends.select("source", "need", "b.*"))


def thresholds(rows: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: source, source_size, target, ``whole`` copies of every document,
    and ``cut``: documents with a hash below it get one copy more."""
    t = targets(rows, weights, most)
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    t = compact(t.withColumn("whole", whole))
    need = t.select(
        "source", (F.col("target") - F.col("whole") * size).alias("need"), F.lit(0).cast("long").alias("below")
    )
    shift = BITS - LEVEL
    ends = boundary(rows, need, shift)
    while shift > 0 and not ends.filter("low < high").isEmpty():
        at = ends.select("source", "bucket").alias("e")
        inside = same(F.col("r.source"), F.col("e.source")) & (
            F.shiftright("r.h", shift) == F.col("e.bucket")
        )
        rows = compact(rows.alias("r").join(at, inside, "left_semi"))
        shift -= LEVEL
        ends = boundary(rows, ends.select("source", "need", "below"), shift)
    nearer = F.col("below") + F.col("words") - F.col("need") < F.col("need") - F.col("below")
    cuts = ends.select("source", (F.col("low") + nearer.cast("long")).alias("cut"))
    return compact(
        t.alias("t")
        .join(cuts.alias("c"), same(F.col("t.source"), F.col("c.source")), "left")
        .select("t.*", F.coalesce("cut", F.lit(0)).alias("cut"))
    )


def with_copies(rows: DataFrame, cuts: DataFrame, *cols) -> DataFrame:
    """``cols`` of each row, its source's columns and ``copies``."""
    joined = rows.alias("r").join(cuts.alias("c"), same(F.col("r.source"), F.col("c.source")))
    copies = (F.col("whole") + (F.col("h") < F.col("cut")).cast("long")).cast("int")
    return joined.select(*cols, "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    rows = settle(hashed(docs, seed))
    out = with_copies(rows, thresholds(rows, weights, most), "doc_id", "size")
    return out.withColumn("taken", F.col("size") * F.col("copies"))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """The documents themselves, each row as often as the mix takes it."""
    cuts = thresholds(settle(hashed(docs, seed).drop("doc_id")), weights, most)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    whole = whole.select(
        "row", F.col("row.source").alias("source"), doc_hash(F.col("row.doc_id"), F.col("row.text"), seed).alias("h")
    )
    out = with_copies(whole, cuts, "row")
    return out.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


@query(
    "op1_source_mix",
    r"""WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix-0:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS s,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
lam(i, l) AS (
  SELECT 0, sum(s)::DOUBLE / sum(w) FROM t
  UNION ALL
  SELECT lam.i + 1, (sum(t.s) - sum(CASE WHEN lam.l * t.w > 3 * t.s THEN 3 * t.s ELSE 0 END))::DOUBLE
    / sum(CASE WHEN lam.l * t.w > 3 * t.s THEN 0 ELSE t.w END)
  FROM lam, t WHERE lam.i < 60 GROUP BY lam.i, lam.l),
g AS (SELECT source, s, CASE WHEN l * w > 3 * s THEN (3 * s)::DOUBLE ELSE l * w END AS target
  FROM t, (SELECT l FROM lam ORDER BY i DESC LIMIT 1)),
n AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END::BIGINT AS whole FROM g),
a AS (SELECT source, h, sum(size)::BIGINT AS words FROM d GROUP BY source, h),
c AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h)::BIGINT AS upto FROM a),
e AS (SELECT n.source, min({'h': c.h, 'upto': c.upto, 'words': c.words}) AS b, any_value(target - whole * s) AS need
  FROM c JOIN n ON c.source IS NOT DISTINCT FROM n.source WHERE c.upto >= target - whole * s GROUP BY n.source),
k AS (SELECT source, b.h + CASE WHEN b.upto - need < need - (b.upto - b.words) THEN 1 ELSE 0 END AS cut FROM e)
SELECT d.doc_id, d.size, n.s AS source_size, n.target, n.whole::INTEGER + (d.h < coalesce(k.cut, 0))::INTEGER AS copies,
  d.size * (n.whole + (d.h < coalesce(k.cut, 0))::BIGINT) AS taken
FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source""",
)
def op1_source_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))
