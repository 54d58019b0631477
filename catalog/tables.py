"""Wide and long sales tables derived from the sample tables.

Every line item is a sale: its supplier is the seller, the supplier's nation the
state, the part's brand the store, the ship date the month. Returned items count
negative, and one brand has no store number, so that negatives and null keys occur.
All rows of all years take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfold.functions.months import MONTHS
from monthfold.operators.reshape import add_month_number, add_quarter, unpivot_months
from monthfold.schema import IDENTIFIER_COLUMNS
from monthfold.sinks.scratch import fresh_folder
from monthfold.sinks.settings import FOLD_BYTES, session_options
from monthfold.sinks.writers import folder_bytes, write_csv, write_parquet

IDS = list(IDENTIFIER_COLUMNS)
MEASURES = [f"{month}_sales" for month in MONTHS]
PARTITIONS = "spark.sql.shuffle.partitions"

# Files of a wide delivery: (name, first year, last year, months). Together they hold
# every cell of the wide table once, in seven different headers.
DELIVERIES = (
    ("sales_to_1996_jan_dec.csv", None, 1996, MONTHS),
    ("sales_1997_1998_jan_dec.csv", 1997, 1998, MONTHS),
    ("sales_1999_2000_jan_jul.csv", 1999, 2000, MONTHS[:7]),
    ("sales_1999_2000_aug_dec.csv", 1999, 2000, MONTHS[7:]),
    ("sales_from_2001_jan_mar.csv", 2001, None, MONTHS[:3]),
    ("sales_from_2001_apr_jun.csv", 2001, None, MONTHS[3:6]),
    ("sales_from_2001_jul_sep.csv", 2001, None, MONTHS[6:9]),
    ("sales_from_2001_oct_dec.csv", 2001, None, MONTHS[9:]),
)
# This one has its identifiers in reverse order.
REORDERED = "sales_1999_2000_aug_dec.csv"


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _sales(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    lines = _read(spark, sf, "lineitem").select(
        "l_suppkey",
        "l_partkey",
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month_number"),
        F.when(F.col("l_returnflag") == "R", -price).otherwise(price).alias("sales_amount"),
        F.concat(F.lit("sales_"), F.col("l_returnflag"), F.lit(".csv")).alias("source_file"),
    )
    parts = _read(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("store_name"))
    return lines.join(parts, lines.l_partkey == parts.p_partkey).drop("l_partkey", "p_partkey")


def _with_names(spark: SparkSession, sf: str, sales: DataFrame) -> DataFrame:
    suppliers, nations = _read(spark, sf, "supplier"), _read(spark, sf, "nation")
    sellers = suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey).select(
        "s_suppkey",
        F.col("s_name").alias("salesperson_name"),
        F.col("n_nationkey").cast("int").alias("sales_state_id"),
        F.col("n_name").alias("sales_state_name"),
    )
    number = F.regexp_extract("store_name", r"(\d+)$", 1).cast("int")
    return sales.join(sellers, F.col("l_suppkey") == F.col("s_suppkey")).withColumns(
        {
            "salesperson_id": F.col("l_suppkey").cast("int"),
            "store_id": F.when(F.col("store_name") != "Brand#13", number),
        }
    )


def _portions(spark: SparkSession, sf: str) -> int:
    """Portions of ``FOLD_BYTES`` that the line items' files make."""
    return -(-folder_bytes(spark, f"{sf}/lineitem.parquet") // FOLD_BYTES)


def wide(spark: SparkSession, sf: str) -> DataFrame:
    """The wide table: one row per seller, store and year, one column per month.

    Aggregated before the seller join, so that only group rows meet it. Lines are dealt
    by group before: there are few per group, so that folding them on the map side would
    keep almost as many rows in memory, and shuffle each with all twelve sums. A task
    folds some ``FOLD_BYTES`` of the files, however large they are and whatever number of
    partitions the session sets; tables of fewer portions than tasks are dealt as Spark chooses.
    """
    cells = [
        F.sum(F.when(F.col("month_number") == number, F.col("sales_amount"))).cast("decimal(18,2)").alias(name)
        for number, name in enumerate(MEASURES, start=1)
    ]
    keys = ["l_suppkey", "store_name", "year"]
    lines, portions = _sales(spark, sf).select(*keys, "month_number", "sales_amount"), _portions(spark, sf)
    enough = min(spark.sparkContext.defaultParallelism, int(spark.conf.get(PARTITIONS)))
    dealt = lines.repartition(portions, *keys) if portions > enough else lines.repartition(*keys)
    groups = dealt.groupBy(*keys).agg(*cells)
    return _with_names(spark, sf, groups).select(*IDS, *MEASURES)


def to_long(frame: DataFrame, unknown: str = "zero") -> DataFrame:
    """Long form of a wide frame, one source file per year."""
    measures = [c for c in frame.columns if c.endswith("_sales")]
    rows = add_quarter(add_month_number(unpivot_months(frame, IDS, measures), unknown))
    return rows.withColumn("source_file", F.concat(F.lit("sales_"), F.col("year"), F.lit(".csv")))


def long(spark: SparkSession, sf: str) -> DataFrame:
    """The long table, null cells kept."""
    return to_long(wide(spark, sf))


def repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Long rows at line level: keys repeat within and across source files."""
    labels = F.array(*[F.lit(month) for month in MONTHS])
    rows = _with_names(spark, sf, _sales(spark, sf)).withColumn("month", F.element_at(labels, F.col("month_number")))
    return add_quarter(rows).select(*IDS, "month", "month_number", "sales_amount", "quarter", "source_file")


def deliveries(frame: DataFrame) -> dict[str, DataFrame]:
    """The wide frame cut into the delivery files."""
    cut = {}
    for name, first, last, months in DELIVERIES:
        rows = frame
        if first is not None:
            rows = rows.where(F.col("year") >= first)
        if last is not None:
            rows = rows.where(F.col("year") <= last)
        ids = IDS[::-1] if name == REORDERED else IDS
        cut[name] = rows.select(*ids, *[f"{month}_sales" for month in months])
    return cut


def deliver(rows: DataFrame, folder: str, name: str) -> None:
    """Write a delivery file: gzipped CSV parts, which headers and scans are read from as from plain ones."""
    write_csv(rows, f"{folder}/{name}", compression="gzip")


_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf: str, label: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf, label)
    if key not in _written:
        folder = fresh_folder(spark, label)
        write(folder)
        _written[key] = folder
    return _written[key]


def staged_wide(spark: SparkSession, sf: str) -> DataFrame:
    """The wide table as a written staging table, for queries that scan it more than once.

    Joins of tables too large to be broadcast shuffle and sort by the same portions as the fold, at least.
    """

    def write(folder: str) -> None:
        partitions = max(int(spark.conf.get(PARTITIONS)), _portions(spark, sf))
        with session_options(spark, {PARTITIONS: str(partitions)}):
            write_parquet(wide(spark, sf), folder)

    return spark.read.parquet(_once(spark, sf, "sales_raw", write))


def delivered(spark: SparkSession, sf: str) -> str:
    """Folder with the delivery files as CSV, written once per session."""

    def write(folder: str) -> None:
        for name, rows in deliveries(staged_wide(spark, sf)).items():
            deliver(rows, folder, name)

    return _once(spark, sf, "deliveries", write)
