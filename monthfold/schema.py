"""Column classification and the declared schemas of the wide and long tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthfold.functions.months import MONTHS

AMOUNT = T.DecimalType(18, 2)
PROVENANCE = ("source_file", "load_timestamp")

# Declared types of the identifier columns; any other identifier is kept as text.
IDENTIFIER_TYPES: dict[str, T.DataType] = {
    "salesperson_id": T.IntegerType(),
    "salesperson_name": T.StringType(),
    "sales_state_id": T.IntegerType(),
    "sales_state_name": T.StringType(),
    "store_id": T.IntegerType(),
    "store_name": T.StringType(),
    "year": T.IntegerType(),
}

IDENTIFIER_COLUMNS = tuple(IDENTIFIER_TYPES)

# Fixed value: what a measure column is called.
SALES_COLUMN_PATTERN = r"^([A-Z][a-z]{2})_sales$"

# Declared widths of the text columns.
WIDTHS = {
    "salesperson_name": 100,
    "sales_state_name": 100,
    "store_name": 100,
    "source_file": 255,
    "month": 3,
}

STAGING = T.StructType(
    [T.StructField(name, dtype) for name, dtype in IDENTIFIER_TYPES.items()]
    + [T.StructField(f"{month}_sales", AMOUNT) for month in MONTHS]
    + [
        T.StructField("source_file", T.StringType()),
        T.StructField("load_timestamp", T.TimestampType()),
    ]
)

CURATED = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("load_timestamp", T.TimestampType()),
        *[T.StructField(name, dtype) for name, dtype in IDENTIFIER_TYPES.items()],
        T.StructField("month", T.StringType()),
        T.StructField("month_number", T.IntegerType()),
        T.StructField("sales_amount", AMOUNT),
        T.StructField("quarter", T.IntegerType()),
    ]
)
RECORD_ID = "record_id"
CURATED_NOT_NULL = ("salesperson_id", "year", "month", "month_number")


def classify(
    columns: Sequence[str], pattern: str, allow: Sequence[str] | None = None
) -> tuple[list[str], list[str]]:
    """Split column names into (identifiers, measures).

    A column is a measure when its name matches ``pattern``. Every other column is
    an identifier, unless ``allow`` is given: then only listed names are, and the
    rest is left out.
    """
    matcher = re.compile(pattern)
    measures = [name for name in columns if matcher.match(name)]
    rest = [name for name in columns if not matcher.match(name) and name not in PROVENANCE]
    if allow is not None:
        rest = [name for name in rest if name in allow]
    return rest, measures


def add_record_id(df: DataFrame, start: int | Column = 0) -> DataFrame:
    """Add a unique (not dense) ``record_id``, offset by ``start``."""
    offset = F.lit(start) if isinstance(start, int) else start
    return df.withColumn(RECORD_ID, F.monotonically_increasing_id() + offset)


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> None:
    """Create an empty Parquet table unless one of that name exists."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
