"""Helpers shared by the operators over documents."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epiframe.plans.shared import new_path, settle  # noqa: F401

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bound of a broadcast table, in rows of at most a few dozen bytes.
BROADCAST_ROWS = 500_000

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A narrow written table, marked for broadcast if it has few rows; else joins shuffle it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def compact(df: DataFrame, per_core: int = 1) -> DataFrame:
    """``settle`` for tables much smaller than their source: so many files a core at most,
    since every file costs the writer processes and the store requests."""
    return settle(df.coalesce(per_core * df.sparkSession.sparkContext.defaultParallelism))


@contextmanager
def rows_a_batch(spark: SparkSession, rows: int = 64) -> Iterator[None]:
    """Batches handed to Python have so few rows meanwhile: for tables whose rows are large, so
    that a task holds some tens of megabytes of them. The work has to be done inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def same(a: Column, b: Column) -> Column:
    """Equality that also holds between nulls."""
    return a.eqNullSafe(b)


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
