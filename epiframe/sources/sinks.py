"""Writers for samples, tables, audits and logs, and checks of what was written."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiframe.sources import ranges

#: A row of the sample schema with 1,024 slots of 64 floats stays below 300 KB.
FILE_ROWS = 5_000


def write_episodes(df: DataFrame, path: str, episode: str, order: str) -> None:
    """One folder per episode, rows in order.

    Rows are spread by range of (episode, order), so a long episode becomes several
    consecutive files instead of one task. A file has at most ``FILE_ROWS`` rows. An existing target is refused.
    """
    (
        df.repartitionByRange(episode, order)
        .sortWithinPartitions(episode, order)
        .write.mode("errorifexists")
        .option("maxRecordsPerFile", FILE_ROWS)
        .partitionBy(episode)
        .parquet(path)
    )


def write_layout(df: DataFrame, path: str, keys: list[str], order: list[str], buckets: int) -> DataFrame:
    """Write rows bucketed by ``keys`` and sorted by ``order``, and read them as a table.

    Windows by these keys, as-of joins of tables laid out alike and future chunks need no
    exchange then; each bucket is one task. Choose ``buckets`` so that one fits a task. The
    table is external, named after its folder, and known to this session's catalog.
    """
    name = "layout_" + path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    laid = df.repartition(buckets, *keys).sortWithinPartitions(*keys, *order)
    laid.write.bucketBy(buckets, *keys).sortBy(*keys, *order).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def write_csv_exact(df: DataFrame, path: str) -> DataFrame:
    """Write CSV with a header, read it back, and count rows lost or gained.

    Doubles are printed in the shortest form that reads back to the same value.
    """
    df.write.mode("errorifexists").option("escape", '"').csv(path, header=True)
    back = (
        df.sparkSession.read.schema(df.schema)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .csv(path, header=True)
    )
    cols = df.columns
    net = (
        df.withColumn("_n", F.lit(1))
        .unionByName(back.withColumn("_n", F.lit(-1)))
        .groupBy(*cols)
        .agg(F.sum("_n").alias("_n"), F.count_if(F.col("_n") > 0).alias("_rows"))
    )
    return net.agg(
        F.sum("_rows").alias("rows"),
        F.sum(F.greatest("_n", F.lit(0))).alias("lost"),
        F.sum(F.greatest(-F.col("_n"), F.lit(0))).alias("gained"),
    )


def write_json_audit(df: DataFrame, path: str) -> None:
    """One JSON object per line with sorted keys and nulls kept."""
    text = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    df.select(text.alias("value")).write.mode("errorifexists").text(path)


def append_log(df: DataFrame, path: str) -> None:
    """Append one JSON line per action."""
    df.write.mode("append").json(path)


def write_once(df: DataFrame, path: str) -> bool:
    """Write a new dataset; False if there is one already, which is then left untouched. An
    empty folder is no dataset."""
    try:
        df.write.mode("errorifexists").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        files = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        if not files.select("path").isEmpty():
            return False
        df.write.mode("append").parquet(path)
    return True


AUDIT_COLUMNS = (
    "source_row_index",
    "frame_id",
    "cam0_frame_index",
    "cam1_frame_index",
    "cam0_signed_delta",
    "cam1_signed_delta",
    "pose_timestamp",
)


def sample_schema() -> T.StructType:
    """Columns of the training-sample table."""
    vector = T.ArrayType(T.FloatType(), False)
    fields = [
        T.StructField("state", vector, False),
        T.StructField("action", T.ArrayType(vector, False), False),
        T.StructField("action_is_pad", T.ArrayType(T.BooleanType(), False), False),
        T.StructField("valid_horizon", T.LongType(), False),
        T.StructField("alignment_valid", T.LongType(), False),
    ]
    fields += [T.StructField(c, T.LongType(), False) for c in AUDIT_COLUMNS]
    fields.append(T.StructField("timestamp", T.FloatType(), False))
    fields += [
        T.StructField(c, T.LongType(), False)
        for c in ("frame_index", "episode_index", "index", "task_index")
    ]
    return T.StructType(fields)


def feature_shapes(state_dim: int, horizon: int, width: int, height: int) -> dict[str, tuple]:
    """Declared shape of every feature."""
    if not 1 <= horizon <= 1024:
        raise ValueError("horizon must be in 1..1024")
    if width <= 0 or height <= 0:
        raise ValueError("frame size must be positive")
    shapes = {
        "state": (state_dim,),
        "action": (horizon, state_dim),
        "action_is_pad": (horizon,),
        "video": (height, width, 3),
    }
    return shapes


def shape_violations(df: DataFrame, shapes: dict[str, tuple]) -> DataFrame:
    """Per array column: rows whose size differs from the declared shape."""

    def wrong(name: str, shape: tuple) -> Column:
        size_ok = F.size(name) == shape[0]
        if len(shape) == 2:
            size_ok = size_ok & F.forall(name, lambda v: F.size(v) == shape[1])
        return F.count_if(~F.coalesce(size_ok, F.lit(False)))

    present = {n: s for n, s in shapes.items() if n in df.columns}
    sums = df.agg(F.count(F.lit(1)).alias("rows"), *[wrong(n, s).alias(n) for n, s in present.items()])
    each = F.array(
        *[F.struct(F.lit(n).alias("feature"), F.col(n).alias("violations")) for n in present]
    )
    return sums.select("rows", F.inline(each))


def declared(schema: T.StructType, shapes: dict[str, tuple]) -> T.StructType:
    """The schema with the shape of every feature in its field's metadata; (1,) for scalars."""
    return T.StructType(
        [T.StructField(f.name, f.dataType, f.nullable, {"shape": list(shapes.get(f.name, (1,)))}) for f in schema.fields]
    )


def with_declaration(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns with the metadata that ``schema`` has for them; files keep it."""
    facts = {f.name: f.metadata for f in schema.fields}
    return df.select(*[F.col(c).alias(c, metadata=facts[c]) if c in facts else F.col(c) for c in df.columns])


def contract_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per declared feature: types, shapes as declared and as stored, and rows that break them.

    The stored shape is the one in the metadata of ``df``, as it was written. A feature that is
    absent or of another type breaks in every row; else a row breaks it by a null or, for an
    array, by another size at any depth.
    """
    here = {f.name: f for f in df.schema.fields}

    def shaped(column: Column, shape: list) -> Column:
        fine = F.coalesce(F.size(column) == shape[0], F.lit(False))
        return fine & F.forall(column, lambda x: shaped(x, shape[1:])) if len(shape) > 1 else fine

    sums, facts = [F.count(F.lit(1)).alias("_rows")], []
    for f in schema.fields:
        shape, found = list(f.metadata["shape"]), here.get(f.name)
        same = found is not None and found.dataType.simpleString() == f.dataType.simpleString()
        column = F.col(f"`{f.name}`")
        if not same:
            broken = F.lit(True)
        elif isinstance(f.dataType, T.ArrayType):
            broken = ~shaped(column, shape)
        else:
            broken = column.isNull()
        sums.append(F.count_if(broken).alias(f.name))
        kept = None if found is None else found.metadata.get("shape")
        facts.append((
            f.name, f.dataType.simpleString(), None if found is None else found.dataType.simpleString(),
            "x".join(map(str, shape)), None if kept is None else "x".join(map(str, kept)),
        ))
    names = ("feature", "declared_type", "stored_type", "declared_shape", "stored_shape")
    entries = [
        F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, fact)], F.col(f"`{fact[0]}`").alias("violations"))
        for fact in facts
    ]
    return df.agg(*sums).select(F.col("_rows").alias("rows"), F.inline(F.array(*entries)))


def type_violations(df: DataFrame, declared: T.StructType) -> list[tuple[str, str, str]]:
    """(column, declared type, actual type) of every declared column that is absent or of
    another type; nullability is not compared, since files do not keep it."""

    def plain(kind) -> str:
        return kind.simpleString()

    actual = {f.name: plain(f.dataType) for f in df.schema.fields}
    return [
        (f.name, plain(f.dataType), actual.get(f.name, "absent"))
        for f in declared.fields
        if actual.get(f.name) != plain(f.dataType)
    ]


def file_manifest(spark: SparkSession, root: str, glob: str = "*.parquet", leaf: int | None = None) -> DataFrame:
    """Path, size and SHA-256 of every data file of a dataset; files may have any size.

    A file is read by one task, a few megabytes at a time. With ``leaf``, files of more bytes
    are read by several tasks and have a tree of digests (``ranges.tree_digests``) instead.
    """
    return ranges.tree_digests(ranges.listed(spark, root, glob), leaf)


def plain_path(path: Column) -> Column:
    """A path without its scheme, which writers and readers spell in different ways."""
    return F.regexp_replace(F.regexp_replace(path, r"\A[A-Za-z][A-Za-z0-9+.-]*:", ""), r"/{2,}", "/")


def manifest_verify(
    spark: SparkSession, manifest: DataFrame, root: str, glob: str = "*.parquet", leaf: int | None = None
) -> DataFrame:
    """Each manifest row or file with its verdict: ok, outside, missing, unlisted, size, sha256.

    Only files that are listed with their size are read; ``leaf`` is that of the manifest.
    """
    files = ranges.listed(spark, root, glob)
    worth = files.join(manifest.select("path", "size").distinct(), ["path", "size"], "left_semi")
    digests = ranges.tree_digests(worth, leaf).select("path", F.col("sha256").alias("_sha"))
    actual = files.withColumnRenamed("size", "_size").join(digests, "path", "left")
    both = manifest.join(actual, "path", "full")
    home = plain_path(F.lit(root.rstrip("/") + "/"))
    inside = F.startswith(plain_path(F.col("path")), home) & ~F.contains("path", F.lit("/../"))
    verdict = (
        F.when(F.col("size").isNull(), "unlisted")
        .when(~inside, "outside")
        .when(F.col("_size").isNull(), "missing")
        .when(F.col("size") != F.col("_size"), "size")
        .when(F.col("sha256") != F.col("_sha"), "sha256")
        .otherwise("ok")
    )
    return both.select("path", verdict.alias("verdict"))
