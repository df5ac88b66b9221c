"""How many rows a plan can have at most, without running it.

The answer is a proof: the plan has nothing above its sources that makes rows, and the rows of
the sources are those in the footers of their Parquet files. ``None`` says that there is no
such proof, or that the rows may be more than asked for.
"""

from pyspark.sql import DataFrame

#: Operators that put out at most the rows they take in.
NARROW = {
    "Project", "Filter", "Sort", "Window", "Aggregate", "Distinct", "Deduplicate", "SubqueryAlias", "GlobalLimit",
    "LocalLimit", "Repartition", "RepartitionByExpression", "RebalancePartitions", "WindowGroupLimit",
}
SEMI = {"LeftSemi", "LeftAnti"}
FILES = 64


def rows_within(df: DataFrame, most: int) -> int | None:
    """A bound of the rows of ``df`` if it is at most ``most``."""
    if not hasattr(df, "_jdf"):
        return None
    spark = df.sparkSession
    total, open_ = 0, [df._jdf.queryExecution().optimizedPlan()]
    while open_:
        node = open_.pop()
        name = node.nodeName()
        known = node.maxRows()
        if known.isDefined():
            total += known.get()
        elif name in NARROW:
            open_.append(node.children().apply(0))
        elif name == "Union":
            open_ += [node.children().apply(i) for i in range(node.children().size())]
        elif name == "Join" and node.joinType().toString() in SEMI:
            open_.append(node.left())
        elif name == "LogicalRelation":
            rows = footer_rows(spark, node.relation(), most - total)
            if rows is None:
                return None
            total += rows
        else:
            return None
        if total > most:
            return None
    return total


def footer_rows(spark, relation, most: int) -> int | None:
    """Rows of all Parquet files of a relation, by their footers; stops beyond ``most``."""
    if "HadoopFsRelation" not in relation.getClass().getName() or relation.fileFormat().toString() != "Parquet":
        return None
    files = relation.location().inputFiles()
    if len(files) > FILES:
        return None
    hadoop, parquet = spark._jvm.org.apache.hadoop.fs, spark._jvm.org.apache.parquet.hadoop
    conf, total = spark._jsc.hadoopConfiguration(), 0
    for name in files:
        path = hadoop.Path(spark._jvm.java.net.URI(name))
        reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(path, conf))
        try:
            total += reader.getRecordCount()
        finally:
            reader.close()
        if total > most:
            return None
    return total
