"""Readers for recordings: CSV, JSON, JSON lines, Parquet, id lists, logs and file listings."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from epiframe.functions.values import EPISODE_ID
from epiframe.plans.series import Series


def _not_empty(df: DataFrame, path: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no data rows: {path}")
    return df


def scan_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Typed CSV with a header. A wrong header, a ragged row or a bad cell is an error."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .csv(path)
    )
    return _not_empty(df, path)


def scan_json_object(
    spark: SparkSession, path: str, schema: str | StructType, tolerant: bool = False
) -> DataFrame:
    """One JSON object per file. Tolerant reading gives nulls where a file cannot be parsed."""
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE" if tolerant else "FAILFAST")
        .json(path)
    )


def scan_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """One object per line; blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def ordered_lines(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """Lines of text files with their zero-based position over all files in name order.

    Large files are split for reading; the position is rebuilt from file, split offset and
    order within the split, so no file passes through one task.
    """
    rows = spark.read.text(path).select(
        F.lit(1).alias("_all"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
        F.col("value"),
    )
    s = Series.plan(rows, ["_all"], ["_file", "_start", "_row"], max_rows).number("pos")
    return s.frame().select("pos", "value")


def scan_ordered_id_list(
    spark: SparkSession, path: str, pattern: str = EPISODE_ID, max_rows: int | None = None
) -> DataFrame:
    """Ids of a list in file order, each with its line number and what is wrong with it."""
    rows = _not_empty(ordered_lines(spark, path, max_rows), path)
    rows = Series.plan(rows, ["value"], ["pos"], max_rows).number("_nth").frame()
    text = F.col("value")
    problem = (
        F.when(text == "", "empty")
        .when(text != F.trim(text), "untrimmed")
        .when(~text.rlike(pattern), "malformed")
        .when(F.col("_nth") > 0, "duplicate")
    )
    return rows.select((F.col("pos") + 1).alias("line"), text.alias("id"), problem.alias("problem"))


def bad_lines(listed: DataFrame) -> DataFrame:
    """Every bad line of a list: line, id, problem."""
    return listed.filter("problem IS NOT NULL").select("line", "id", "problem")


def require_clean_list(listed: DataFrame) -> DataFrame:
    """The list itself, or an error with the number of bad lines by problem; ``bad_lines``
    has them all."""
    found = bad_lines(listed).groupBy("problem").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("line"))
    found = found.orderBy("line").collect()  # one row per kind of problem
    if found:
        raise ValueError("; ".join(f"{r.n} {r.problem}, first in line {r.line}" for r in found))
    return listed


def file_inventory(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Path, size and time of every file below a folder; file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", F.col("length").alias("size"), "modificationTime")


def discover_sources(
    spark: SparkSession, root: str, glob: str, expected: int | None = None
) -> DataFrame:
    """Files matching a pattern, once each; a repeat or a wrong count is an error."""
    found = file_inventory(spark, root, glob).select("path", "size")
    totals = found.groupBy("path").agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("files"), F.max("n").alias("most")
    ).first()
    if (totals.most or 0) > 1:
        raise ValueError(f"a path was found {totals.most} times below {root}")
    if expected is not None and totals.files != expected:
        raise ValueError(f"expected {expected} files below {root}, found {totals.files}")
    return found


# Fixed value: the form of a metric line.
LOG_LINE = r"Step (\d+):.*loss=([^,\s]+)"


def scan_log_metrics(lines: DataFrame, warm_up: int = 50, limit: float = 5.0) -> DataFrame:
    """One row: last step and loss of a training log, and what is wrong with it.

    ``lines`` has ``pos`` and ``value``. The last matching line wins.
    """
    step = F.regexp_extract("value", LOG_LINE, 1).try_cast("bigint")
    loss = F.regexp_extract("value", LOG_LINE, 2).try_cast("double")
    parsed = lines.select(
        "pos",
        step.alias("step"),
        loss.alias("loss"),
        F.contains("value", F.lit("Traceback (most recent call last)")).alias("trace"),
    )
    hit = F.col("step").isNotNull()
    bad = F.isnan("loss") | F.col("loss").isNull() | (F.abs("loss") == F.lit(float("inf")))
    out = parsed.agg(
        F.count_if(hit).alias("steps"),
        F.max_by("step", F.when(hit, F.col("pos"))).alias("last_step"),
        F.max_by("loss", F.when(hit, F.col("pos"))).alias("last_loss"),
        F.count_if(hit & bad).alias("non_finite"),
        F.count_if(hit & (F.col("step") >= warm_up) & ~(F.col("loss") < limit)).alias("too_high"),
        F.max("trace").alias("traceback"),
    )
    return out
