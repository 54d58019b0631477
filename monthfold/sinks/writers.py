"""Writing curated data, rejects, exports and state rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from monthfold.sinks.settings import open_files

# Rows of a compressed text file, which one task reads as a whole.
PART_ROWS = 1_000_000


def write_curated(
    df: DataFrame,
    path: str,
    mode: str = "append",
    fmt: str = "parquet",
    parts: Sequence[str] = ("year", "month"),
    dynamic: bool = False,
    dealt: bool = False,
) -> None:
    """Write the long table, partitioned by ``parts``.

    The rebalance hint lets adaptive execution bring the rows of a partition
    together into few files and split a partition that is too large for one task,
    instead of every task writing a file into every partition. With ``dynamic``, an
    overwrite replaces only the partitions that the new rows belong to. ``dealt``
    says that the rows have been brought together before. Tasks keep one file per
    partition open and do not sort their rows.
    """
    if parts and not dealt:
        df = df.hint("rebalance", *parts)
    writer = df.write.mode(mode).format(fmt)
    if parts:
        writer = writer.partitionBy(*parts)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic and parts else "static")
    with open_files(df.sparkSession):
        writer.save(path)


def write_quarantine(df: DataFrame, path: str) -> None:
    """Add rejects; those of a file's latest recorded run are the ones that count.

    One folder per run where rows have a ``run_id``, so folders do not grow with files.
    Rows are written where they are: each task has one folder to write to, so dealing them anew gains nothing.
    """
    write_curated(df, path, parts=("run_id",) if "run_id" in df.columns else (), dealt=True)


def delete_files(spark: SparkSession, paths: DataFrame) -> int:
    """Delete the files that a frame of one column names; returns how many there were.

    Names come from the driver one partition at a time.
    """
    jvm, conf, count = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    for row in paths.toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row[0]))
        count += bool(path.getFileSystem(conf).delete(path, False))
    return count


def delete_folder(spark: SparkSession, name: str) -> bool:
    """Delete a folder with what it holds; whether there was one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))


def folder_bytes(spark: SparkSession, name: str) -> int:
    """Bytes of all files below a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return int(path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength())


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    parts: Sequence[str] = ("year", "month"),
    path: str | None = None,
) -> None:
    """Write a managed table, or an external one where ``path`` is given.

    ``fmt`` is handed to Spark; formats such as delta need their package.
    """
    if parts:
        df = df.hint("rebalance", *parts)
    writer = df.write.mode(mode).format(fmt)
    if parts:
        writer = writer.partitionBy(*parts)
    if path is not None:
        writer = writer.option("path", path)
    with open_files(df.sparkSession):
        writer.saveAsTable(name)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """Export as CSV with a header in every part file.

    With a ``compression`` such as gzip the text takes a small part of its room. A reader cannot split such
    part files, so that each holds ``PART_ROWS`` rows at most.
    """
    writer = df.write.mode(mode).option("header", True)
    if compression is not None:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", PART_ROWS)
    writer.csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Export as unpartitioned Parquet."""
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append rows as JSON lines, for summaries that other tools read."""
    df.write.mode(mode).json(path)


def append(df: DataFrame, table: str) -> None:
    """Append rows to a table (by name or by path), matching columns by name.

    Columns that the target has and the frame lacks are written as NULL.
    """
    spark = df.sparkSession
    if "/" in table:
        df.write.mode("append").parquet(table)
        return
    target = spark.table(table).schema
    empty = spark.createDataFrame([], target)
    aligned = empty.unionByName(df, allowMissingColumns=True).select(*[f"`{c}`" for c in target.names])
    aligned.write.insertInto(table)
