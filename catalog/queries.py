"""One query per operator, over tables derived from the sample tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import tables
from catalog.tables import IDS, MEASURES
from monthfold.config import IngestConfig
from monthfold.functions.months import MONTHS
from monthfold.operators import audits, reports, reshape, summaries
from monthfold.operators.dedup import dedup, removed_count
from monthfold.operators.validate import PROFILES, flag, metrics, split
from monthfold.plans import ingest
from monthfold.plans.normalize import long_rows, normalize
from monthfold.schema import CURATED, SALES_COLUMN_PATTERN, add_record_id, classify, create_table
from monthfold.sinks import writers
from monthfold.sinks.scratch import fresh_folder
from monthfold.sources.discovery import list_files, logical_files, read_headers
from monthfold.sources.tables import read_table
from monthfold.sources.wide import BEYOND, group_by_header, read_wide, with_provenance
from monthfold.state import tables as state
from monthfold.streaming.available_now import run_available_now

# An upper bound that some cells of the derived tables exceed.
MAX_AMOUNT = Decimal(200_000)
LONG = [*IDS, "month", "month_number", "sales_amount", "quarter", "source_file"]
STRICT = replace(PROFILES["strict_ids"], max_amount=MAX_AMOUNT)
QUERIES: dict = {}


def query(function):
    """Register a query under its function's name."""
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    """Types that every engine compares alike: decimals as double, string lists joined."""
    shown = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.concat_ws(",", column)
        shown.append(column.alias(field.name))
    return df.select(*shown)


# --- reshaping


@query
def unpivot_keep_nulls(spark: SparkSession, sf: str) -> DataFrame:
    frame = tables.wide(spark, sf)
    return plain(reshape.unpivot_months(frame, *classify(frame.columns, SALES_COLUMN_PATTERN)))


@query
def unpivot_drop_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reshape.unpivot_months(tables.wide(spark, sf), IDS, MEASURES, drop_nulls=True))


@query
def unpivot_union_all(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reshape.unpivot_months_union(tables.staged_wide(spark, sf), IDS, MEASURES))


@query
def unpivot_sql(spark: SparkSession, sf: str) -> DataFrame:
    tables.wide(spark, sf).createOrReplaceTempView("sales_raw_for_unpivot")
    listed = ", ".join(f"{name} AS {name.removesuffix('_sales')}" for name in MEASURES)
    rows = spark.sql(f"SELECT * FROM sales_raw_for_unpivot UNPIVOT (sales_amount FOR month IN ({listed}))")
    return plain(rows)


@query
def month_subset_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reshape.unpivot_months(tables.wide(spark, sf), IDS, MEASURES, months=("Jan", "Jun", "Dec")))


@query
def month_quarter_derivation(spark: SparkSession, sf: str) -> DataFrame:
    return tables.long(spark, sf).groupBy("month", "month_number", "quarter").agg(F.count(F.lit(1)).alias("records"))


def _with_unknown_month(spark: SparkSession, sf: str, unknown: str) -> DataFrame:
    frame = tables.wide(spark, sf).withColumn("Foo_sales", F.col("Jan_sales"))
    return plain(tables.to_long(frame, unknown))


@query
def unknown_month_zero(spark: SparkSession, sf: str) -> DataFrame:
    return _with_unknown_month(spark, sf, "zero")


@query
def unknown_month_null(spark: SparkSession, sf: str) -> DataFrame:
    return _with_unknown_month(spark, sf, "null")


@query
def lateral_month_number(spark: SparkSession, sf: str) -> DataFrame:
    rows = reshape.unpivot_months(tables.wide(spark, sf), IDS, MEASURES, drop_nulls=True)
    rows.createOrReplaceTempView("long_for_lateral")
    cases = " ".join(f"WHEN '{label}' THEN {number}" for number, label in enumerate(MONTHS, start=1))
    return plain(
        spark.sql(
            "SELECT l.*, months.month_number FROM long_for_lateral AS l, "
            f"LATERAL (SELECT CASE l.month {cases} END AS month_number) AS months"
        )
    )


@query
def allow_list_projection(spark: SparkSession, sf: str) -> DataFrame:
    frame = tables.wide(spark, sf).withColumn("region", F.col("sales_state_name"))
    ids, measures = classify(frame.columns, SALES_COLUMN_PATTERN, allow=IDS)
    return plain(reshape.unpivot_months(frame, ids, measures))


@query
def extra_identifier_kept(spark: SparkSession, sf: str) -> DataFrame:
    frame = tables.wide(spark, sf).withColumn("region", F.col("sales_state_name"))
    return plain(reshape.unpivot_months(frame, *classify(frame.columns, SALES_COLUMN_PATTERN)))


def _text_cells(spark: SparkSession, sf: str) -> DataFrame:
    cells = {c: F.coalesce(F.col(c).cast("string"), F.lit("N/A")) for c in MEASURES}
    return tables.wide(spark, sf).withColumns(cells)


@query
def measures_try_cast(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reshape.cast_measures(_text_cells(spark, sf), MEASURES))


@query
def unparseable_amounts(spark: SparkSession, sf: str) -> DataFrame:
    rows = split(long_rows(_text_cells(spark, sf), PROFILES["notebook"]))[1]
    return plain(rows.select(*IDS, "month", "sales_raw", "reject_reasons"))


@query
def melt_column_order(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of a melt by position, with how many values each holds."""
    rows = tables.long(spark, sf)
    melted = rows.select(*IDS, "source_file", "sales_amount", "month", "month_number", "quarter")
    counted = melted.agg(*[F.count(c).alias(c) for c in melted.columns])
    named = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("name"), F.col(c).alias("n")) for i, c in enumerate(counted.columns)])
    return counted.select(F.inline(named))


@query
def union_shapes_by_name(spark: SparkSession, sf: str) -> DataFrame:
    frames = [
        frame.withColumn("source_file", F.lit(name))
        for name, frame in tables.deliveries(tables.wide(spark, sf)).items()
    ]
    return plain(reshape.union_shapes(frames))


@query
def normalize_all_shapes(spark: SparkSession, sf: str) -> DataFrame:
    frames = [
        normalize(frame.withColumn("source_file", F.lit(name)), STRICT)
        for name, frame in tables.deliveries(tables.wide(spark, sf)).items()
    ]
    return plain(reshape.union_shapes(frames).select(*LONG))


# --- validation


def _sides(spark: SparkSession, sf: str, profile) -> tuple[DataFrame, DataFrame]:
    valid, rejected = split(flag(tables.long(spark, sf), profile))
    return plain(valid.select(*LONG)), plain(rejected.select(*LONG))


@query
def valid_strict_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _sides(spark, sf, STRICT)[0]


@query
def invalid_strict_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _sides(spark, sf, STRICT)[1]


@query
def valid_notebook(spark: SparkSession, sf: str) -> DataFrame:
    return _sides(spark, sf, PROFILES["notebook"])[0]


@query
def invalid_notebook(spark: SparkSession, sf: str) -> DataFrame:
    return _sides(spark, sf, PROFILES["notebook"])[1]


@query
def valid_core_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _sides(spark, sf, PROFILES["core_keys"])[0]


@query
def invalid_core_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _sides(spark, sf, PROFILES["core_keys"])[1]


@query
def valid_sql_insert(spark: SparkSession, sf: str) -> DataFrame:
    return _sides(spark, sf, PROFILES["sql_insert"])[0]


@query
def negative_allowed(spark: SparkSession, sf: str) -> DataFrame:
    return _sides(spark, sf, replace(STRICT, reject_negative=False))[0]


@query
def validation_disabled(spark: SparkSession, sf: str) -> DataFrame:
    return _sides(spark, sf, replace(STRICT, enabled=False))[0]


@query
def reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    flagged = flag(tables.long(spark, sf), replace(STRICT, null_amount="reject"))
    return plain(flagged.select(*LONG, "is_valid", "reject_reasons"))


@query
def validation_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics(flag(tables.long(spark, sf), STRICT), by=("source_file",))


@query
def not_null_check(spark: SparkSession, sf: str) -> DataFrame:
    frame = tables.wide(spark, sf).withColumn("Foo_sales", F.col("Jan_sales"))
    return audits.not_null_check(tables.to_long(frame, "null"))


@query
def width_check(spark: SparkSession, sf: str) -> DataFrame:
    return audits.width_check(
        tables.long(spark, sf), {"salesperson_name": 100, "sales_state_name": 10, "store_name": 7, "month": 3}
    )


@query
def key_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    return audits.key_uniqueness(add_record_id(tables.long(spark, sf), start=1))


# --- duplicates

_KEYS = [*IDS, "month"]
_FIXED = ("month_number", "quarter")


@query
def dedup_within_file(spark: SparkSession, sf: str) -> DataFrame:
    return plain(dedup(tables.repeated(spark, sf), _KEYS, "file", determined=_FIXED))


@query
def dedup_global(spark: SparkSession, sf: str) -> DataFrame:
    return plain(dedup(tables.repeated(spark, sf), _KEYS, "global", determined=_FIXED))


@query
def dedup_removed_count(spark: SparkSession, sf: str) -> DataFrame:
    return removed_count(tables.repeated(spark, sf), _KEYS, "file")


@query
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return audits.duplicate_keys(tables.repeated(spark, sf))


# --- reports


@query
def sales_by_quarter(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reports.sales_by_quarter(tables.long(spark, sf)))


@query
def quarter_totals(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reports.quarter_totals(tables.long(spark, sf)))


@query
def sales_by_salesperson(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reports.sales_by_salesperson(tables.long(spark, sf)))


@query
def sales_by_state(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reports.sales_by_state(tables.long(spark, sf)))


@query
def null_key_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audits.null_key_audit(tables.wide(spark, sf))


@query
def negative_by_month(spark: SparkSession, sf: str) -> DataFrame:
    return audits.negative_by_month(tables.long(spark, sf))


@query
def summary_stats(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reports.summary_stats(tables.long(spark, sf)))


@query
def summary_months_list(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reports.summary_months_list(tables.long(spark, sf)))


@query
def top10_salespeople(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reports.top_salespeople(tables.long(spark, sf)))


@query
def top10_states(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reports.top_states(tables.long(spark, sf)))


@query
def record_count(spark: SparkSession, sf: str) -> DataFrame:
    return reports.record_count(tables.long(spark, sf))


@query
def null_cells_in_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    return plain(reports.null_cells(tables.long(spark, sf)))


@query
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    order = ["salesperson_id", "store_name", "year", "month_number"]
    return plain(reports.sample(tables.long(spark, sf), 5, order))


# --- tables and files


@query
def curated_roundtrip_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "curated")
    writers.write_curated(tables.long(spark, sf), path, mode="overwrite")
    return plain(read_table(spark, path).select(*LONG))


@query
def partition_pruned_read(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "curated")
    writers.write_curated(tables.long(spark, sf), path, mode="overwrite")
    rows = read_table(spark, path).where((F.col("month") == "Jan") & (F.col("year") >= 1998))
    return plain(reports.sales_by_state(rows))


@query
def dynamic_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path, rows = fresh_folder(spark, "curated"), tables.long(spark, sf)
    writers.write_curated(rows, path, mode="overwrite")
    doubled = (F.col("sales_amount") * 2).cast("decimal(18,2)")
    first_quarter = rows.where(F.col("quarter") == 1).withColumn("sales_amount", doubled)
    writers.write_curated(first_quarter, path, mode="overwrite", dynamic=True)
    return plain(read_table(spark, path).select(*LONG))


@query
def quarantine_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "quarantine")
    writers.write_quarantine(split(flag(tables.long(spark, sf), STRICT))[1], path)
    return plain(read_table(spark, path).select(*LONG, "reject_reasons"))


@query
def csv_export_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path, rows = fresh_folder(spark, "export"), tables.long(spark, sf)
    writers.write_csv(rows, path, compression="gzip")
    return plain(spark.read.csv(path, header=True, schema=rows.schema))


@query
def parquet_export_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "export")
    writers.write_parquet(tables.long(spark, sf), path)
    return plain(read_table(spark, path))


@query
def table_append_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "appended")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    rows = tables.long(spark, sf)
    create_table(spark, name, CURATED, path)
    rejected, valid = rows.where(F.col("store_id").isNull()), rows.where(F.col("store_id").isNotNull())
    writers.append(valid, name)
    writers.append(rejected, name)
    return plain(read_table(spark, name).select(*LONG))


@query
def saved_table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "saved")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    writers.save_table(tables.long(spark, sf), name, path=path)
    return plain(read_table(spark, name).select(*LONG))


@query
def curated_schema_and_views(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "declared")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    create_table(spark, name, CURATED, path)
    writers.append(tables.long(spark, sf), name)
    reports.register_views(spark, read_table(spark, name), prefix="declared_")
    return plain(spark.sql("SELECT * FROM declared_sales_by_state"))


# --- delivery files


def _config(spark: SparkSession, source: str, **changes) -> IngestConfig:
    out = fresh_folder(spark, "run")
    places = {name: f"{out}/{name}" for name in ("staging", "curated", "checkpoints", "logs")}
    return IngestConfig(source=source, max_sales_value=MAX_AMOUNT, **{**places, **changes})


def _scan(spark: SparkSession, source: str, names: DataFrame | None = None) -> DataFrame:
    """Wide rows of delivery files, one scan per header."""
    listing = list_files(spark, source)
    if names is not None:
        listing = listing.join(names, "source_file", "left_semi")
    headers = read_headers(spark, [row.path for row in listing.select("path").collect()])
    return reshape.union_shapes([read_wide(spark, shape, source).drop(BEYOND) for shape in group_by_header(headers)])


def _records_per_file(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("records"))


@query
def known_headers_one_scan_per_shape(spark: SparkSession, sf: str) -> DataFrame:
    source = tables.delivered(spark, sf)
    headers = read_headers(spark, [row.path for row in list_files(spark, source).select("path").collect()])
    frames = [normalize(read_wide(spark, shape, source), STRICT) for shape in group_by_header(headers)]
    return plain(reshape.union_shapes(frames).select(*LONG))


@query
def provenance_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_provenance(_scan(spark, tables.delivered(spark, sf)), datetime.now(timezone.utc))
    return rows.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("load_timestamp").alias("load_times")
    )


def _ledger_of(files: DataFrame, status) -> DataFrame:
    counts = files.select("source_file", *[F.lit(0).alias(c) for c in ("record_count", "long_records", "valid_records", "invalid_records")])
    return state.ledger_rows(files.withColumn("status", status), counts, "earlier", F.lit(datetime.now(timezone.utc)))


@query
def discover_new_files(spark: SparkSession, sf: str) -> DataFrame:
    source = tables.delivered(spark, sf)
    files = logical_files(list_files(spark, source))
    before = files.where(~F.col("source_file").startswith("sales_from_2001"))
    fresh = state.pending(files, _ledger_of(before, F.lit(state.SUCCESS)))
    return _records_per_file(_scan(spark, source, fresh))


@query
def ledger_retry_failed(spark: SparkSession, sf: str) -> DataFrame:
    source = tables.delivered(spark, sf)
    files = logical_files(list_files(spark, source))
    failed = F.col("source_file").contains("apr_jun")
    rewritten = F.when(F.col("source_file").contains("1997"), F.col("length") + 1).otherwise(F.col("length"))
    status = F.when(failed, F.lit("error: failed to read")).otherwise(F.lit(state.SUCCESS))
    again = state.pending(files, _ledger_of(files.withColumn("length", rewritten), status))
    return _records_per_file(_scan(spark, source, again))


def _schemas(spark: SparkSession, source: str) -> DataFrame:
    listing = {row.path: row.source_file for row in list_files(spark, source).collect()}
    seen = {(listing[path], header) for path, header in read_headers(spark, listing).items()}
    return spark.createDataFrame(
        [(name, list(header)) for name, header in sorted(seen)], "source_file string, columns array<string>"
    )


@query
def schema_registry_state(spark: SparkSession, sf: str) -> DataFrame:
    source = tables.delivered(spark, sf)
    schemas = _schemas(spark, source)
    new, _ = state.register(
        schemas, spark.createDataFrame([], state.REGISTRY), SALES_COLUMN_PATTERN, "run", F.current_timestamp()
    )
    keys = schemas.select("source_file", state.schema_key(F.col("columns")).alias("schema_key"))
    records = _records_per_file(_scan(spark, source)).join(keys, "source_file")
    per_schema = records.groupBy("schema_key").agg(F.sum("records").alias("records"))
    return plain(
        new.join(per_schema, "schema_key").select(
            "schema_key", "count_key", "sales_columns", "column_count", "first_file", "records"
        )
    )


@query
def drift_events(spark: SparkSession, sf: str) -> DataFrame:
    source = tables.delivered(spark, sf)
    schemas, now = _schemas(spark, source), F.current_timestamp()
    full_year = F.col("source_file").contains("jan_dec")
    registry, _ = state.register(
        schemas.where(full_year), spark.createDataFrame([], state.REGISTRY), SALES_COLUMN_PATTERN, "first", now
    )
    _, drift = state.register(schemas, registry, SALES_COLUMN_PATTERN, "second", now)
    shown = drift.select("source_file", "event", "new_columns", "added_columns", "removed_columns")
    return plain(shown.join(_records_per_file(_scan(spark, source)), "source_file"))


@query
def known_measures(spark: SparkSession, sf: str) -> DataFrame:
    source = tables.delivered(spark, sf)
    registry = state.describe_schemas(_schemas(spark, source), SALES_COLUMN_PATTERN)
    rows = _scan(spark, source)
    cells = reshape.unpivot_months(rows, ["source_file"], [c for c in rows.columns if c in MEASURES], drop_nulls=True)
    counted = cells.groupBy(F.concat("month", F.lit("_sales")).alias("sales_column")).agg(F.count(F.lit(1)).alias("cells"))
    return state.known_measures(registry).join(counted, "sales_column", "left")


@query
def no_measure_columns(spark: SparkSession, sf: str) -> DataFrame:
    source = fresh_folder(spark, "unmeasured")
    tables.deliver(tables.wide(spark, sf).select(*IDS), source, "sales_identifiers.csv")
    cfg = _config(spark, source)
    ingest.run(spark, cfg)
    wide_rows = _scan(spark, source).agg(F.count(F.lit(1)).alias("wide_rows"))
    long_records = ingest.read_curated(spark, cfg).agg(F.count(F.lit(1)).alias("n"))
    drift = ingest.read_drift(spark, cfg).where(F.col("event") == "no_measure_columns").agg(F.count(F.lit(1)).alias("n"))
    return wide_rows.select("wide_rows", long_records.scalar().alias("long_records"), drift.scalar().alias("drift_events"))


@query
def ingest_full_run(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _config(spark, tables.delivered(spark, sf))
    ingest.run(spark, cfg, incremental=False)
    return plain(ingest.read_curated(spark, cfg).select(*LONG))


@query
def ingest_rejects(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _config(spark, tables.delivered(spark, sf))
    ingest.run(spark, cfg)
    return plain(ingest.read_quarantine(spark, cfg).select(*LONG, "reject_reasons"))


@query
def ingest_twice(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _config(spark, tables.delivered(spark, sf), profile="core_keys")
    ingest.run(spark, cfg)
    ingest.run(spark, cfg)
    return plain(reports.sales_by_quarter(ingest.read_curated(spark, cfg, committed=False)))


@query
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _config(spark, tables.delivered(spark, sf))
    ingest.run(spark, cfg)
    return ingest.read_run_metrics(spark, cfg).drop("run_id", "start_time", "end_time", "duration_seconds", "errors")


def _with_repeats(spark: SparkSession, sf: str) -> IngestConfig:
    """A run over one file of line-level rows: each has one month, and keys repeat."""
    source = fresh_folder(spark, "repeats")
    cells = [F.when(F.col("month") == label, F.col("sales_amount")).alias(f"{label}_sales") for label in MONTHS]
    tables.deliver(tables.repeated(spark, sf).select(*IDS, *cells), source, "sales_lines.csv")
    cfg = _config(spark, source)
    ingest.run(spark, cfg)
    return cfg


@query
def ingest_with_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Curated rows of a file whose keys repeat: the largest valid amount of each key and month."""
    return plain(ingest.read_curated(spark, _with_repeats(spark, sf)).select(*IDS, "month", "month_number", "sales_amount"))


@query
def repeats_removed(spark: SparkSession, sf: str) -> DataFrame:
    counted = ingest.read_run_metrics(spark, _with_repeats(spark, sf))
    return counted.select("input_records", "long_records", "valid_records", "duplicates_removed", "total_records")


@query
def full_refresh_replaces(spark: SparkSession, sf: str) -> DataFrame:
    """What is stored after a refresh from another folder: the former deliveries are gone."""
    first = _config(spark, tables.delivered(spark, sf))
    ingest.run(spark, first)
    source = fresh_folder(spark, "refreshed")
    tables.deliver(tables.staged_wide(spark, sf).where("year >= 1996"), source, "sales_refreshed.csv")
    ingest.run(spark, replace(first, source=source), incremental=False)
    return plain(ingest.read_curated(spark, first, committed=False).select(*IDS, "month", "sales_amount", "source_file"))


def _counted_keys(rows: DataFrame) -> DataFrame:
    """Rows and distinct keys per month, and how many keys are missing, below 1 or of several rows.

    Keys of a run are near each other, so they are folded as bits of words of 64 before they are shuffled. A word
    whose bits are fewer than its rows holds a key twice; only rows of such words are grouped by their key.
    """
    word = F.shiftright("record_id", 6)
    bit = F.expr("shiftleft(1L, cast(record_id & 63 AS INT))")
    words = rows.groupBy("month", word.alias("word")).agg(F.count(F.lit(1)).alias("n"), F.bit_or(bit).alias("bits"))
    counted = words.groupBy("month").agg(
        F.sum("n").alias("records"), F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("long").alias("keys")
    )
    whole = words.groupBy("word").agg(F.sum("n").alias("n"), F.bit_or("bits").alias("bits"))
    low = F.col("word").isNull() | (F.col("word") < 0) | ((F.col("word") == 0) & (F.getbit("bits", F.lit(0)) == 1))
    doubtful = whole.where(low | (F.col("n") > F.bit_count("bits"))).select("word")
    # Settled before the rows are read again, which none of them is where there are no such words.
    some = doubtful.agg(F.count(F.lit(1)).alias("n")).scalar() > 0
    own = rows.where(some).select("record_id", word.alias("own"))
    again = own.join(doubtful, F.col("own").eqNullSafe(F.col("word")), "left_semi")
    bad = again.groupBy("record_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or record_id is null or record_id < 1")
    return counted.withColumn("bad_keys", bad.agg(F.count(F.lit(1)).alias("n")).scalar())


@query
def surrogate_keys_over_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Curated rows of two runs, counted by month: keys are there, above 0 and never given twice."""
    first = _config(spark, tables.delivered(spark, sf))
    ingest.run(spark, first)
    source = fresh_folder(spark, "later")
    tables.deliver(tables.staged_wide(spark, sf).where("year >= 1996"), source, "sales_later.csv")
    ingest.run(spark, replace(first, source=source))
    return _counted_keys(ingest.read_curated(spark, first, record_ids=True))


@query
def global_scope_on_write(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without duplicates between files after a second run repeats and changes some of them."""
    cfg = _config(spark, tables.delivered(spark, sf), dedup_scope="global")
    ingest.run(spark, cfg)
    source = fresh_folder(spark, "doubled")
    raised = [(F.col(c) + 1).cast("decimal(18,2)").alias(c) for c in MEASURES]
    tables.deliver(tables.staged_wide(spark, sf).where("year >= 1999").select(*IDS, *raised), source, "sales_doubled.csv")
    ingest.run(spark, replace(cfg, source=source))
    return plain(ingest.read_curated(spark, cfg).select(*IDS, "month", "sales_amount"))


_summarised: dict[tuple[str, str], IngestConfig] = {}


def _summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Summaries of the partitions after a run over the deliveries and one over a file of later years."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _summarised:
        cfg = _config(spark, tables.delivered(spark, sf), keep_summaries=True)
        ingest.run(spark, cfg)
        source = fresh_folder(spark, "later")
        tables.deliver(tables.staged_wide(spark, sf).where("year >= 1998"), source, "sales_later.csv")
        ingest.run(spark, replace(cfg, source=source))
        _summarised[key] = cfg
    return ingest.read_summaries(spark, _summarised[key])


@query
def sales_by_quarter_from_summaries(spark: SparkSession, sf: str) -> DataFrame:
    return plain(summaries.sales_by_quarter(_summaries(spark, sf)))


@query
def sales_by_state_from_summaries(spark: SparkSession, sf: str) -> DataFrame:
    return plain(summaries.sales_by_state(_summaries(spark, sf)))


@query
def summary_stats_from_summaries(spark: SparkSession, sf: str) -> DataFrame:
    return plain(summaries.summary_stats(_summaries(spark, sf)))


@query
def ledger_state(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _config(spark, tables.delivered(spark, sf))
    ingest.run(spark, cfg)
    return ingest.read_ledger(spark, cfg).select(
        "source_file", "status", "record_count", "long_records", "valid_records", "invalid_records"
    )


@query
def summary_sink(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _config(spark, tables.delivered(spark, sf), profile="core_keys")
    ingest.run(spark, cfg)
    summary = ingest.write_summary(spark, cfg)
    stored = spark.read.schema(summary.schema).json(ingest.Places.of(cfg).summary)
    return plain(stored.drop("duration_seconds", "timestamp"))


@query
def stream_available_now(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _config(spark, tables.delivered(spark, sf))
    stream = run_available_now(spark, cfg, f"{cfg.checkpoints}/stream")
    stream.awaitTermination()
    return plain(ingest.read_curated(spark, cfg).select(*LONG))
