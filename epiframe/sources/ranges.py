"""Digests of files of any size: byte ranges are hashed by many tasks, then merged up a tree.

A file is cut into leaves of ``leaf`` bytes. The SHA-256 of the leaves (hex) are joined, 1,024
at a time, and hashed again, until one is left. The shape follows from the size of the file
alone, and the digest of a file of one leaf is its ordinary SHA-256.
"""

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAF = 64 << 20
FAN = 1024
READ = 4 << 20
#: Leaves of one task where there are more of them than cores.
LEAVES_A_TASK = 16


def listed(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """path and size of the files below a folder; their content is not read. Spark lists no
    empty files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return files.load(root).select("path", F.col("length").alias("size"))


def range_digest(path: str, at: int, n: int) -> str:
    """SHA-256 of ``n`` bytes from ``at``, read a few megabytes at a time."""
    # the listing writes file:/a b, and a URI wants file:///a%20b
    uri = re.sub(r"\A([A-Za-z][A-Za-z0-9+.-]*):/(?!/)", r"\1:///", quote(path, safe="/:@"))
    store, name = fs.FileSystem.from_uri(uri)
    digest = hashlib.sha256()
    with store.open_input_file(name) as f:
        f.seek(at)
        while n:
            piece = f.read(min(n, READ))
            if not piece:
                raise EOFError(f"{path} has grown shorter")
            digest.update(piece)
            n -= len(piece)
    return digest.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        path, at, n = (b.column(c).to_pylist() for c in ("path", "at", "n"))
        found = pa.array(map(range_digest, path, at, n), pa.string())
        yield pa.RecordBatch.from_arrays(
            [b.column("path"), b.column("size"), b.column("parts"), b.column("part"), found],
            ["path", "size", "parts", "part", "digest"],
        )


def tree_digests(files: DataFrame, leaf: int | None = LEAF) -> DataFrame:
    """path, size and sha256 (of the tree) of each file of a listing (path, size).

    A leaf is a row, so a large file is read by many tasks; a node joins at most 1,024 digests.
    An empty file is one empty leaf. Without ``leaf`` every file is one, and the digest is
    its ordinary SHA-256.
    """
    spark = files.sparkSession
    leaf = leaf or (1 << 62)
    # in floats, the quotient of a size near 2**53 could be off by one
    parts = F.greatest(F.lit(1), F.expr(f"(size + {leaf - 1}L) div {leaf}L"))
    files = files.select("path", "size", parts.cast("bigint").alias("parts"))
    most = files.agg(F.sum("parts").alias("all"), F.max("parts").alias("one")).first()
    leaves, deepest = most["all"] or 0, most["one"] or 1
    # rows are tiny and their work is not, so the number of tasks is named
    tasks = max(1, min(leaves, 2 * spark.sparkContext.defaultParallelism), leaves // LEAVES_A_TASK)
    rows = files.withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)")))
    at = F.col("part") * F.lit(leaf)
    rows = rows.withColumns({"at": at, "n": F.least(F.lit(leaf), F.col("size") - at).cast("bigint")})
    nodes = rows.repartition(tasks, "path", "part").mapInArrow(
        _digests, "path string, size bigint, parts bigint, part bigint, digest string"
    )
    while deepest > 1:
        children = F.array_sort(F.collect_list(F.struct("part", "digest")))  # at most FAN
        nodes = nodes.groupBy("path", "size", "parts", F.expr(f"part div {FAN}").alias("up")).agg(children.alias("c"))
        joined = F.sha2(F.array_join("c.digest", "").cast("binary"), 256)
        nodes = nodes.select(
            "path", "size", F.expr(f"(parts + {FAN - 1}) div {FAN}").alias("parts"), F.col("up").alias("part"),
            F.when(F.col("parts") == 1, F.col("c.digest")[0]).otherwise(joined).alias("digest"),
        )
        deepest = -(-deepest // FAN)
    return nodes.select("path", "size", F.col("digest").alias("sha256"))
