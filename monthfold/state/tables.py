"""State between runs, kept as Parquet tables: file ledger, schema registry, drift log, run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_STR, _LONG, _INT, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType()
_NAMES = T.ArrayType(_STR)


def _table(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


LEDGER = _table(
    source_file=_STR,
    length=_LONG,
    modification_time=_TS,
    parts=_INT,
    status=_STR,
    record_count=_LONG,
    long_records=_LONG,
    valid_records=_LONG,
    invalid_records=_LONG,
    run_id=_STR,
    processed_at=_TS,
)
REGISTRY = _table(
    schema_key=_STR,
    count_key=_STR,
    columns=_NAMES,
    identifier_columns=_NAMES,
    sales_columns=_NAMES,
    column_count=_INT,
    first_file=_STR,
    first_seen=_TS,
)
DRIFT = _table(
    event_time=_TS,
    run_id=_STR,
    source_file=_STR,
    event=_STR,
    schema_key=_STR,
    new_columns=_NAMES,
    added_columns=_NAMES,
    removed_columns=_NAMES,
)
RUN_METRICS = _table(
    run_id=_STR,
    start_time=_TS,
    end_time=_TS,
    duration_seconds=T.DoubleType(),
    files_discovered=_LONG,
    files_processed=_LONG,
    files_skipped=_LONG,
    input_records=_LONG,
    long_records=_LONG,
    valid_records=_LONG,
    invalid_records=_LONG,
    duplicates_removed=_LONG,
    total_records=_LONG,
    errors=T.ArrayType(_table(file=_STR, error=_STR)),
)

SUCCESS = "success"
SKIPPED = "skipped: no measure columns"
REPLACED = "replaced"
_IDENTITY = ["source_file", "length", "modification_time"]


def done(ledger: DataFrame) -> DataFrame:
    """Ledger rows of files that need no further attempt."""
    return ledger.where(F.col("status").isin(SUCCESS, SKIPPED))


def pending(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files not done yet in exactly this version: new, rewritten or failed before."""
    return files.join(done(ledger).select(*_IDENTITY), _IDENTITY, "left_anti")


def ledger_rows(files: DataFrame, counts: DataFrame, run_id: str, now: Column) -> DataFrame:
    """Ledger rows of a run. ``files`` carries a ``status``; ``counts`` holds record counts per file."""
    ok = F.col("status") == SUCCESS
    joined = files.join(counts, "source_file", "left")
    numbers = {
        name: F.when(ok, F.coalesce(F.col(name), F.lit(0))).otherwise(F.lit(0)).cast("long")
        for name in ("record_count", "long_records", "valid_records", "invalid_records")
    }
    return joined.withColumns({**numbers, "run_id": F.lit(run_id), "processed_at": now}).select(*LEDGER.names)


def committed(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Long rows of each file's latest successful run.

    Rows of a run that stopped before its ledger entry, and rows of an earlier
    version of a file, are left out. The ledger side has one row per file; Spark
    broadcasts it where its size allows and shuffles otherwise.
    """
    return rows.join(latest(ledger), ["source_file", "run_id"], "left_semi")


def latest(ledger: DataFrame) -> DataFrame:
    """(source_file, run_id) of each file's latest successful run, unless it was replaced since."""
    last = F.max_by(F.struct("run_id", "status"), F.struct("processed_at", "run_id"))
    ended = ledger.where(F.col("status").isin(SUCCESS, REPLACED)).groupBy("source_file").agg(last.alias("last"))
    return ended.where(F.col("last.status") == SUCCESS).select("source_file", F.col("last.run_id").alias("run_id"))


def replaced(ledger: DataFrame, files: DataFrame, run_id: str, now: Column) -> DataFrame:
    """Ledger rows that end the files which are committed and not among ``files``."""
    absent = latest(ledger).select("source_file").join(files.select("source_file"), "source_file", "left_anti")
    known = {"status": F.lit(REPLACED), "run_id": F.lit(run_id), "processed_at": now}
    return absent.select(
        *[known.get(f.name, F.col("source_file") if f.name == "source_file" else F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER]
    )


def dead_files(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """(path) of the data files of ``rows`` (source_file, run_id) that hold no committed row."""
    stored = rows.select("source_file", "run_id", F.col("_metadata.file_path").alias("path"))
    held = stored.groupBy("path", "source_file", "run_id").agg(F.lit(1).alias("held"))
    live = held.join(latest(ledger).withColumn("live", F.lit(True)), ["source_file", "run_id"], "left")
    return live.groupBy("path").agg(F.max(F.coalesce("live", F.lit(False))).alias("live")).where("not live").select("path")


def schema_key(columns: Column) -> Column:
    """Hash of the sorted column names: equal for equal sets, whatever their order."""
    return F.sha2(F.to_json(F.array_sort(columns)), 256)


def describe_schemas(schemas: DataFrame, pattern: str, allow: list[str] | None = None) -> DataFrame:
    """Registry columns for frames of (source_file, columns), one row per distinct column set."""

    def measure(name: Column) -> Column:
        return name.rlike(f"^(?:{pattern})")

    def identifier(name: Column) -> Column:
        return ~measure(name) if allow is None else ~measure(name) & name.isin(*allow)

    columns = F.array_sort("columns")
    described = schemas.select(
        "source_file",
        schema_key(F.col("columns")).alias("schema_key"),
        columns.alias("columns"),
        F.filter(columns, identifier).alias("identifier_columns"),
        F.filter(columns, measure).alias("sales_columns"),
        F.size("columns").alias("column_count"),
    )
    grouped = described.groupBy(
        "schema_key", "columns", "identifier_columns", "sales_columns", "column_count"
    ).agg(F.min("source_file").alias("first_file"))
    count_key = F.concat(
        F.lit("cols_"), F.col("column_count"), F.lit("_sales_"), F.size("sales_columns")
    )
    return grouped.withColumn("count_key", count_key)


def register(
    schemas: DataFrame, registry: DataFrame, pattern: str, run_id: str, now: Column, allow: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(new registry rows, drift events) for the schemas of a run.

    A drift event lists the columns added and removed against the schema registered
    last before the run; against nothing, every column counts as added.
    """
    new = (
        describe_schemas(schemas, pattern, allow)
        .join(registry.select("schema_key"), "schema_key", "left_anti")
        .withColumn("first_seen", now)
        .select(*REGISTRY.names)
    )
    before = registry.agg(F.max_by("columns", F.struct("first_seen", "first_file", "schema_key")).alias("before"))
    nothing = F.array().cast("array<string>")
    last = F.coalesce(before.select("before").scalar(), nothing)
    drift = new.select(
        now.alias("event_time"),
        F.lit(run_id).alias("run_id"),
        F.col("first_file").alias("source_file"),
        F.when(F.size("sales_columns") == 0, F.lit("no_measure_columns"))
        .otherwise(F.lit("new_schema_detected"))
        .alias("event"),
        "schema_key",
        F.col("sales_columns").alias("new_columns"),
        F.array_except("columns", last).alias("added_columns"),
        F.array_except(last, "columns").alias("removed_columns"),
    )
    return new, drift


def known_measures(registry: DataFrame) -> DataFrame:
    """Every measure column any registered schema has, sorted."""
    return registry.select(F.explode("sales_columns").alias("sales_column")).distinct().orderBy("sales_column")
