"""Reading staging, curated and state tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    name_or_path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """A table by path (anything with a slash) or by name.

    With ``schema`` no file footers are read to find the columns, and files written
    before a column existed give NULL for it.
    """
    if "/" not in name_or_path:
        return spark.table(name_or_path)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(name_or_path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one of this schema before its first write."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
