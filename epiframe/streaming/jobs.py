"""Structured Streaming forms of the operators that run while recordings keep arriving.

Each job resumes from its checkpoint. Results of a micro-batch go to a folder named by the
batch number and are overwritten if the batch is run again, so a retry changes nothing. Operators
that keep rows or facts of their own per key are in ``state``.
"""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH = "batch"


#: Rows of one key are merged into sessions before the exchange, so a hot key sends sessions.
LOCAL_SESSIONS = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def arriving(spark: SparkSession, path: str, schema: StructType, max_bytes: int = 64 << 30) -> DataFrame:
    """Files as they arrive; a backlog comes in micro-batches of about ``max_bytes``."""
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", str(max_bytes)).parquet(path)


def run_available(
    stream: DataFrame, sink: Callable, mode: str, checkpoint: str, settings: Mapping[str, str] | None = None
) -> int:
    """Process everything that has arrived since the last run, then stop. Returns the number of
    rows that came after the watermark had passed them and were dropped.

    A new job gets one state partition per core of the cluster; the checkpoint keeps that
    number for later runs. A started query has a session of its own, so the settings are
    taken back as soon as it has started.
    """
    conf = stream.sparkSession.conf
    cores = str(stream.sparkSession.sparkContext.defaultParallelism)
    settings = {"spark.sql.shuffle.partitions": cores, **(settings or {})}
    usual = {k: conf.get(k, None) for k in settings}
    for k, v in settings.items():
        conf.set(k, v)
    try:
        query = (
            stream.writeStream.foreachBatch(sink)
            .outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for k, v in usual.items():
            conf.unset(k) if v is None else conf.set(k, v)
    query.awaitTermination()
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def _folder(base: str, batch: int) -> str:
    return f"{base}/{BATCH}={batch:09d}"


def batch_writer(out: str) -> Callable[[DataFrame, int], None]:
    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(_folder(out, batch))

    return write


def latest(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """Newest version of every key over all batches."""
    rows = spark.read.parquet(out)
    values = [c for c in rows.columns if c not in (*keys, BATCH)]
    newest = F.max_by(F.struct(*values), F.col(BATCH)).alias("_v")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_v.*")


# -- decisions -----------------------------------------------------------------------------


def decision_state(actions: DataFrame) -> DataFrame:
    """Latest action per id; works on a table and on a stream."""
    last = F.max(F.struct("done_at", "seq", "action")).alias("_l")
    status = (
        F.when(F.col("_l.action") == "keep", "kept")
        .when(F.col("_l.action") == "skip", "skipped")
        .when(F.col("_l.action") == "trash", "trashed")
        .otherwise("pending")
    )
    return actions.groupBy("id").agg(last).select(
        "id", status.alias("status"), F.col("_l.done_at").alias("decided_at")
    )


# -- runs closed by a gap ------------------------------------------------------------------


def gap_runs(rows: DataFrame, keys: Sequence[str], time: str, gap: str, ts: str,
             late: str | None = None) -> DataFrame:
    """Runs of rows less than ``gap`` apart; on a stream, emitted when the gap has passed.

    Run it with ``LOCAL_SESSIONS``.
    """
    if late is not None:
        rows = rows.withWatermark(time, late)
    return rows.groupBy(*keys, F.session_window(time, gap).alias("_w")).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("rows")
    ).drop("_w")


# -- statistics kept up to date ------------------------------------------------------------


def running_stats(rows: DataFrame, keys: Sequence[str], x: str) -> DataFrame:
    v = F.col(x)
    return rows.groupBy(*keys).agg(
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("std"),
        F.count(v).alias("n"),
    )
