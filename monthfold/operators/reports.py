"""Reports over the long table: one function per report, each a lazy DataFrame.

Null amounts count as records but take no part in sums, averages and extremes.
Only columns a report names are read, so on Parquet the scan is pruned to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfold.functions.amounts import exact_average


def _total(name: str = "total_sales") -> Column:
    return F.sum("sales_amount").alias(name)


def sales_by_quarter(df: DataFrame) -> DataFrame:
    """Per year and quarter: sales, distinct sellers and distinct stores."""
    return df.groupBy("year", "quarter").agg(
        _total(),
        F.count_distinct("salesperson_id").alias("active_salespeople"),
        F.count_distinct("store_id").alias("active_stores"),
    )


def quarter_totals(df: DataFrame) -> DataFrame:
    """Sales per year and quarter, in order."""
    return df.groupBy("year", "quarter").agg(_total()).orderBy("year", "quarter")


def sales_by_salesperson(df: DataFrame) -> DataFrame:
    """Per seller and year: sales, and average, largest and smallest month."""
    return df.groupBy("salesperson_id", "salesperson_name", "year").agg(
        _total(),
        exact_average(F.col("sales_amount")).alias("avg_monthly_sales"),
        F.max("sales_amount").alias("max_monthly_sales"),
        F.min("sales_amount").alias("min_monthly_sales"),
    )


def sales_by_state(df: DataFrame) -> DataFrame:
    """Per state, year and month: sales and distinct stores."""
    return df.groupBy("sales_state_id", "sales_state_name", "year", "month").agg(
        _total(), F.count_distinct("store_id").alias("store_count")
    )


def _statistics() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("salesperson_id").alias("unique_salespeople"),
        F.count_distinct("store_id").alias("unique_stores"),
        F.count_distinct("sales_state_id").alias("unique_states"),
        _total(),
        exact_average(F.col("sales_amount")).alias("avg_sales"),
        F.min("sales_amount").alias("min_sales"),
        F.max("sales_amount").alias("max_sales"),
    ]


def summary_stats(df: DataFrame) -> DataFrame:
    """One row of totals, with the number of distinct months."""
    return df.agg(*_statistics(), F.count_distinct("month").alias("months_covered"))


def summary_months_list(df: DataFrame) -> DataFrame:
    """One row of totals, with the distinct months as a sorted list.

    The months come from a scan of their own that reads one column and is folded to
    the distinct labels before they meet: a list next to the distinct counts would
    turn the whole aggregate from hashing to sorting.
    """
    months = df.select("month").distinct().agg(F.array_sort(F.collect_list("month")).alias("months"))
    return df.agg(*_statistics()).withColumn("months_covered", months.scalar())


def top_salespeople(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` sellers with the largest sales; the id settles ties."""
    totals = df.groupBy("salesperson_id", "salesperson_name").agg(_total())
    return totals.orderBy(F.desc("total_sales"), "salesperson_id", "salesperson_name").limit(n)


def top_states(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` state names with the largest sales; the name settles ties."""
    totals = df.groupBy("sales_state_name").agg(_total())
    return totals.orderBy(F.desc("total_sales"), "sales_state_name").limit(n)


def record_count(df: DataFrame) -> DataFrame:
    """Number of rows."""
    return df.agg(F.count(F.lit(1)).alias("count"))


def null_cells(df: DataFrame) -> DataFrame:
    """Per month: all records next to those with an amount, and the sums over both."""
    return df.groupBy("month").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count("sales_amount").alias("records_with_amount"),
        _total(),
        exact_average(F.col("sales_amount")).alias("avg_sales"),
        F.min("sales_amount").alias("min_sales"),
        F.max("sales_amount").alias("max_sales"),
    )


def sample(df: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    """``n`` rows for display; the first ones in ``order`` where that is given."""
    return (df.orderBy(*order) if order else df).limit(n)


VIEWS = {
    "sales_by_quarter": sales_by_quarter,
    "sales_by_salesperson": sales_by_salesperson,
    "sales_by_state": sales_by_state,
}


def register_views(spark: SparkSession, df: DataFrame, prefix: str = "") -> list[str]:
    """Register the three report views over a long table and return their names."""
    names = []
    for name, report in VIEWS.items():
        report(df).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
