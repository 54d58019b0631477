"""Summaries that merge: sums and exact bitmaps of ids, from which reports are read.

A summary has one row of sums per group of ``GROUPS``, and for every id column one
row per group and word of 64 neighbouring ids, with a bit for each id that occurs.
Summaries of disjoint rows are summaries of all of them when put together, so they
are kept per partition, and a distinct count over any coarser group is the bits of
words that are joined by OR. Both steps are hash aggregates over numbers, whatever the
number of distinct columns; a group costs at most one word per id it holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthfold.schema import AMOUNT, CURATED

GROUPS = ("year", "quarter", "month", "sales_state_id", "sales_state_name")
COUNTED = ("salesperson_id", "store_id", "sales_state_id")
TOTAL = "decimal(28,2)"
_MEASURES = [
    T.StructField("counted", T.StringType()),
    T.StructField("word", T.LongType()),
    T.StructField("bits", T.LongType()),
    T.StructField("records", T.LongType()),
    T.StructField("amounts", T.LongType()),
    T.StructField("total", T.DecimalType(28, 2)),
    T.StructField("least", AMOUNT),
    T.StructField("most", AMOUNT),
]


def group_columns(parts: Sequence[str] = ()) -> list[str]:
    """The columns that a summary is grouped by: ``GROUPS``, and partition columns beyond them."""
    return [*GROUPS, *[c for c in parts if c not in GROUPS]]


def schema(parts: Sequence[str] = ()) -> T.StructType:
    return T.StructType([*[CURATED[c] for c in group_columns(parts)], *_MEASURES])


def summarize(df: DataFrame, parts: Sequence[str] = ()) -> DataFrame:
    """The summary of a long table, one hash aggregate over its rows; null ids set no bit."""

    def bit(name: str) -> Column:
        number = F.col(name).cast("long")
        one = F.expr(f"shiftleft(1L, cast(`{name}` & 63 AS INT))")
        return F.when(number.isNotNull(), F.struct(F.lit(name).alias("counted"), F.shiftright(number, 6).alias("word"), one.alias("bit")))

    nothing = F.lit(None).cast("long")
    sums = F.struct(F.lit(None).cast("string").alias("counted"), nothing.alias("word"), nothing.alias("bit"))
    keys = group_columns(parts)
    shown = df.select(*keys, "sales_amount", F.explode(F.array_compact(F.array(sums, *[bit(c) for c in COUNTED]))).alias("_m"))
    of_row = F.col("counted").isNull()
    amount = F.when(of_row, F.col("sales_amount"))
    return (
        shown.select(*keys, "sales_amount", "_m.*")
        .groupBy(*keys, "counted", "word")
        .agg(
            F.bit_or("bit").alias("bits"),
            F.count(F.when(of_row, 1)).alias("records"),
            F.count(amount).alias("amounts"),
            F.sum(amount).cast(TOTAL).alias("total"),
            F.min(amount).alias("least"),
            F.max(amount).alias("most"),
        )
    )


def _report(summary: DataFrame, by: Sequence[str], columns: Sequence[Column]) -> DataFrame:
    """``columns`` per group of ``by``, out of words that are joined by OR before."""
    words = summary.groupBy(*by, "counted", "word").agg(
        F.bit_or("bits").alias("bits"),
        F.sum("records").alias("records"),
        F.sum("amounts").alias("amounts"),
        F.sum("total").alias("total"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )
    return words.groupBy(*by).agg(*columns) if by else words.agg(*columns)


def _total() -> Column:
    return F.sum("total").cast(TOTAL).alias("total_sales")


def _ids(name: str, alias: str) -> Column:
    bits = F.sum(F.when(F.col("counted") == name, F.bit_count("bits")))
    return F.coalesce(bits, F.lit(0)).cast("long").alias(alias)


def sales_by_quarter(summary: DataFrame) -> DataFrame:
    """Per year and quarter: sales, distinct sellers and distinct stores."""
    columns = [_total(), _ids("salesperson_id", "active_salespeople"), _ids("store_id", "active_stores")]
    return _report(summary, ["year", "quarter"], columns)


def sales_by_state(summary: DataFrame) -> DataFrame:
    """Per state, year and month: sales and distinct stores."""
    by = ["sales_state_id", "sales_state_name", "year", "month"]
    return _report(summary, by, [_total(), _ids("store_id", "store_count")])


def _statistics() -> list[Column]:
    return [
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
        _ids("salesperson_id", "unique_salespeople"),
        _ids("store_id", "unique_stores"),
        _ids("sales_state_id", "unique_states"),
        _total(),
        (F.sum("total").cast("double") / F.nullif(F.sum("amounts"), F.lit(0))).alias("avg_sales"),
        F.min("least").alias("min_sales"),
        F.max("most").alias("max_sales"),
    ]


def summary_stats(summary: DataFrame) -> DataFrame:
    """One row of totals, with the number of distinct months."""
    months = summary.select("month").distinct().agg(F.count("month").alias("n"))
    return _report(summary, [], _statistics()).withColumn("months_covered", months.scalar())


def summary_months_list(summary: DataFrame) -> DataFrame:
    """One row of totals, with the distinct months as a sorted list."""
    months = summary.select("month").distinct().agg(F.array_sort(F.collect_list("month")).alias("months"))
    return _report(summary, [], _statistics()).withColumn("months_covered", months.scalar())
