"""Shards by a two-pass external shuffle.

Pass one scatters the records uniformly into buckets that fit in a task's memory, by a
seeded hash of a value of each row's own, so copies and hot keys spread like all others.
Pass two sorts each bucket by its hash, to have the same order whatever arrived first,
shuffles it by Fisher-Yates (Spark's ``shuffle``) and writes it. The buckets' counts give
each record a place in the whole permutation, and place p goes to slot p div n of shard
p mod n. So the law is ``rows``: the shards' counts are at most one apart.

Defined results
* A null text has size 1 and the checksum of an empty text. Null doc_ids, repeated rows and
  groups of equal texts are dealt like any other rows.
* An empty table gives an empty result. All columns of the input are written.
* With the same files, seed and bucket size, reruns agree.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from epiframe.llm.common import new_path, query, table, text_bytes

SHARDS = 8
#: Bytes of text in a bucket. A task holds one bucket, a few times over while it shuffles it.
BUCKET = 32 << 20
SEED = 17


def scattered(docs: DataFrame, identity: Column | None, bucket_bytes: int, seed: int) -> tuple[DataFrame, int]:
    """(row, h, bucket) and the number of buckets. ``identity`` tells rows apart; by default
    it is the row's place in its partition, which needs an input of settled order."""
    total = docs.agg(F.sum(text_bytes(F.col("text")) + 1)).first()[0] or 0
    buckets = max(SHARDS, -(-total // bucket_bytes))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    identity = F.monotonically_increasing_id() if identity is None else identity
    rows = docs.select(row, F.xxhash64(F.lit(seed), identity).alias("h"))
    return rows.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)).cast("int")), buckets


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, identity: Column | None = None,
    bucket_bytes: int = BUCKET, seed: int = SEED,
) -> None:
    """Writes (row, slot) as Parquet, partitioned by shard; each file is in slot order."""
    rows, buckets = scattered(docs, identity, bucket_bytes, seed)
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)  # one row per bucket
    first = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    first = first.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    def order(a, b):
        return F.when(a["h"] < b["h"], -1).when(a["h"] > b["h"], 1).otherwise(0)

    held = rows.repartitionById(buckets, F.col("bucket")).groupBy("bucket")
    held = held.agg(F.array_sort(F.collect_list(F.struct("h", "row")), order).alias("rows"))
    held = held.withColumn("rows", F.shuffle("rows", seed))
    out = held.join(F.broadcast(first), "bucket") if buckets <= 100_000 else held.join(first, "bucket")
    out = out.select("first", F.posexplode("rows").alias("pos", "r"))
    place = F.col("first") + F.col("pos")
    out = out.select("r.row", (place % shards).cast("int").alias("shard"), F.floor(place / shards).alias("slot"))
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_table(docs: DataFrame, identity: Column | None = None, bucket_bytes: int = BUCKET) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of the shards as written."""
    path = new_path(docs.sparkSession, "shards")
    write_shards(docs, path, identity=identity, bucket_bytes=bucket_bytes)
    if not docs.limit(1).count():  # nothing was written that a schema could come from
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
        out = docs.select(row, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    else:
        out = docs.sparkSession.read.parquet(path)
    return out.select(
        "row.doc_id",
        (text_bytes(F.col("row.text")) + 1).alias("size"),
        F.crc32(F.coalesce("row.text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_external_shuffle")
def op5_external_shuffle(spark, sf_dir):
    place = F.struct("_metadata.file_name", "_metadata.row_index")
    return shard_table(table(spark, sf_dir, "documents"), identity=place)
