"""Reading wide CSV files whose month columns differ from file to file."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthfold.schema import AMOUNT, IDENTIFIER_TYPES
from monthfold.sources.discovery import glob_literal, logical_name, scanned_path


# What a row has beyond its header; also its key among the texts that were not parsed.
BEYOND = "__beyond_header"


@dataclass(frozen=True)
class Shape:
    """Files that share one header. The order counts: a scan binds columns by position."""

    columns: tuple[str, ...]
    paths: tuple[str, ...]


def group_by_header(headers: Mapping[str, Sequence[str]]) -> list[Shape]:
    """One shape per distinct header, in a stable order."""
    paths = defaultdict(list)
    for path, columns in headers.items():
        paths[tuple(columns)].append(path)
    return [Shape(columns, tuple(sorted(paths[columns]))) for columns in sorted(paths)]


def wide_schema(columns: Sequence[str]) -> T.StructType:
    """What :func:`read_wide` gives for a header: text columns, ``BEYOND`` and ``source_file``."""
    return T.StructType([T.StructField(name, T.StringType()) for name in (*columns, BEYOND, "source_file")])


def read_wide(spark: SparkSession, shape: Shape, directory: str) -> DataFrame:
    """All files of a shape in one scan, as text columns, with ``source_file``.

    The schema comes from the header, so nothing is inferred and no type depends on
    the values that a file happens to hold. A row shorter than its header is padded
    with NULL. Of a longer one, ``BEYOND`` holds the first cell that is too many.
    """
    schema = T.StructType(wide_schema(shape.columns).fields[:-1])
    scan = spark.read.csv([glob_literal(p) for p in shape.paths], header=True, schema=schema)
    return scan.select("*", logical_name(scanned_path(), directory).alias("source_file"))


def typed_wide(df: DataFrame, ids: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Give identifiers and measures their declared types; other columns stay as they are.

    ``measures`` maps measure columns to their month labels. A value that is not of
    the declared type becomes NULL, and ``unparsed`` maps its identifier or month
    label to the original text, so that a reject keeps what it was rejected for.
    The map is NULL for rows without such a value.
    """
    declared = {c: IDENTIFIER_TYPES[c] for c in ids if c in IDENTIFIER_TYPES} | dict.fromkeys(measures, AMOUNT)
    declared = {c: dtype for c, dtype in declared.items() if df.schema[c].dataType != dtype}
    cast = {c: f"try_cast({quoted(c)} AS {dtype.simpleString()})" for c, dtype in declared.items()}
    for c, dtype in declared.items():
        if isinstance(dtype, T.IntegerType) and isinstance(df.schema[c].dataType, T.StringType):
            # 5.0 is the integer 5, as exports write a column that has gaps.
            whole = f"{quoted(c)} RLIKE '^\\\\s*[+-]?[0-9]+[.]0*\\\\s*$'"
            cast[c] = f"coalesce({cast[c]}, IF({whole}, try_cast(substring_index({quoted(c)}, '.', 1) AS int), NULL))"
    lost = {
        c: f"{quoted(c)} IS NOT NULL AND {cast[c]} IS NULL"
        for c, dtype in declared.items()
        if not isinstance(dtype, T.StringType)
    }
    if BEYOND in df.columns:
        lost[BEYOND] = f"{quoted(BEYOND)} IS NOT NULL"
    unparsed = "CAST(NULL AS map<string,string>)"
    if lost:
        entries = ", ".join(
            f"IF({gone}, struct({text(measures.get(c, c))}, CAST({quoted(c)} AS string)), NULL)"
            for c, gone in lost.items()
        )
        unparsed = f"IF({' OR '.join(lost.values())}, map_from_entries(array_compact(array({entries}))), NULL)"
    columns = [f"{cast[c]} AS {quoted(c)}" if c in cast else quoted(c) for c in df.columns if c != BEYOND]
    return df.selectExpr(*columns, f"{unparsed} AS unparsed")


def quoted(name: str) -> str:
    """A column name as it stands in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal in SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_provenance(df: DataFrame, run_ts: datetime, source_file: str | None = None) -> DataFrame:
    """Add ``load_timestamp``, one literal per run, and ``source_file`` where it is given."""
    added = {"load_timestamp": F.lit(run_ts).cast("timestamp")}
    if source_file is not None:
        added["source_file"] = F.lit(source_file)
    return df.withColumns(added)
