"""What several operators share: word patterns, tables between steps, ranks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthfold.sinks.scratch import shared_folder

# Words are runs of anything but these six characters.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
FOLDERS: dict[str, str] = {}


def own(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further columns cannot clash with helpers.

    Columns are taken by their place: others may differ from them by case only.
    """
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.select(*[F.col(f"c{docs.columns.index(name)}").alias(name) for name in names])


def carried(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, and whole rows as one column ``doc``, for ``restored``."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.select(F.struct(*plain.columns).alias("doc"), *[F.col(f"c{docs.columns.index(name)}").alias(name) for name in names])


def restored(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` out of ``doc``; those that are ``changed`` from their expressions."""
    return rows.select(*[changed.get(name, F.col(f"doc.c{i}")).alias(name) for i, name in enumerate(docs.columns)])


def whole_text(name: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def session_folder(spark: SparkSession) -> str:
    """The folder of this application's tables, below the cluster's shared folder."""
    app = spark.sparkContext.applicationId
    if app not in FOLDERS:
        FOLDERS[app] = f"{shared_folder(spark)}/monthfold-llm/{app}"
    return FOLDERS[app]


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back.

    Cuts the lineage: what follows survives lost executors without computing the
    rows again, and several readers share one computation.
    """
    spark = df.sparkSession
    path = f"{session_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> None:
    """Delete the tables that ``written`` left; results not yet read are lost with them."""
    folder = FOLDERS.pop(spark.sparkContext.applicationId, None)
    if folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, keys: list[str], order: list[Column], slices: int = 1024, name: str = "rank") -> DataFrame:
    """``name``: the row's place (from 0) within its key, in an order fixed by ``order``.

    Rows of a key are dealt to ``slices`` by the hash of ``order``; places are
    counted within a slice and shifted by the counts of the slices before it.
    No task gets more of a hot key than a slice, and only counts cross slices.
    """
    return running(df.withColumn("_one", F.lit(1).cast("long")), keys, order, "_one", slices, name).drop("_one")


def running(df: DataFrame, keys: list[str], order: list[Column], amount: str, slices: int = 1024, name: str = "start") -> DataFrame:
    """``name``: sum of ``amount`` over the rows of the key that come before this one.

    Order: slice, then ``order``. See ``numbered`` for how hot keys are split.
    """
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int"))
    sums = sliced.groupBy(*keys, "_slice").agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifted = sums.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_slice").alias("_at"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).cast("long").alias("_base"),
    )
    within = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = sliced.withColumn("_within", F.coalesce(F.sum(amount).over(within), F.lit(0)).cast("long"))
    same = (F.col("_slice") == F.col("_at")) & F.lit(True)
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_k{i}"))
    joined = placed.join(shifted, same)
    return joined.withColumn(name, F.col("_base") + F.col("_within")).drop(
        "_slice", "_within", "_at", "_base", *[f"_k{i}" for i in range(len(keys))]
    )
