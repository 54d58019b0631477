"""Data-quality audits of the wide and the long table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthfold.schema import CURATED_NOT_NULL, WIDTHS


def null_key_audit(wide: DataFrame, keys: Sequence[str] = ("salesperson_id", "store_id", "year")) -> DataFrame:
    """Rows (issue, count) with the null count of each key, from one pass over the wide table."""
    counts = wide.agg(*[F.count_if(F.col(f"`{key}`").isNull()).alias(f"Null {key}") for key in keys])
    issues = [F.col(f"`Null {key}`") for key in keys]
    return counts.unpivot([], issues, "issue", "count")


def negative_by_month(df: DataFrame) -> DataFrame:
    """Number of negative amounts per month that has any."""
    return df.where(F.col("sales_amount") < 0).groupBy("month").agg(F.count(F.lit(1)).alias("negative_count"))


def duplicate_keys(
    df: DataFrame, keys: Sequence[str] = ("salesperson_id", "store_id", "year", "month")
) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
    return sizes.where(F.col("duplicate_count") > 1)


def key_uniqueness(df: DataFrame, key: str = "record_id") -> DataFrame:
    """One row (records, distinct_keys, null_keys): what a primary key would enforce."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return sizes.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("records"),
        F.count(F.col(key)).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("copies"))), F.lit(0)).alias("null_keys"),
    )


def not_null_check(df: DataFrame, columns: Sequence[str] = CURATED_NOT_NULL) -> DataFrame:
    """One row with the null count of every column declared NOT NULL."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def width_check(df: DataFrame, widths: Mapping[str, int] = WIDTHS) -> DataFrame:
    """One row with the number of values longer than each declared width."""
    return df.agg(
        *[F.count_if(F.length(F.col(c)) > width).alias(f"too_long_{c}") for c, width in widths.items()]
    )
