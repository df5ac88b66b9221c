"""Places on shared storage that every executor can reach."""

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a fresh one only in an unset local session."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="epiframe-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Tables written by ``settle`` in this process.
SETTLED: list[str] = []


def settle(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write a table to shared storage and go on from there.

    This cuts the lineage, so lost executors cost no recomputation, and later steps read
    only the columns they need; with ``by``, filters on that column read its files alone.
    """
    path = new_path(df.sparkSession, "settled")
    SETTLED.append(path)
    if by is None:
        df.write.parquet(path)
    else:
        df.write.partitionBy(by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out = out if by is None else out.select(df.columns)
    out.settled = path
    return out


def remove(df: DataFrame) -> None:
    """Remove a table that ``settle`` returned; nothing may read it any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.settled)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    SETTLED.remove(df.settled)


def give_back(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of queries that are done; it does so when the driver
    collects its garbage, which may take until the disks are full."""
    gc.collect()
    spark._jvm.System.gc()


def remove_settled(spark: SparkSession) -> int:
    """Remove the tables that ``settle`` has written in this process, and return their number.

    Call it when the results that were made from them are written; frames that still read
    them can't be used any more.
    """
    conf, n = spark._jsc.hadoopConfiguration(), 0
    while SETTLED:
        path = spark._jvm.org.apache.hadoop.fs.Path(SETTLED.pop())
        n += path.getFileSystem(conf).delete(path, True)
    return n
