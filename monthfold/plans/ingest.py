"""One ingest run: discover, read, validate, write, and record what was done."""

from __future__ import annotations

import hashlib
import logging
import re
import uuid
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from itertools import groupby
from operator import add
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthfold.config import ConfigError, IngestConfig
from monthfold.functions.months import MONTHS
from monthfold.operators import reports, summaries
from monthfold.operators.dedup import dedup, dedup_wide
from monthfold.operators.reshape import to_output, union_shapes, unpivot_months
from monthfold.operators.validate import Profile, holds_key, split
from monthfold.plans.normalize import (
    DETERMINED,
    add_calendar,
    flagged_cells,
    identifiers_and_measures,
    valid_cells,
)
from monthfold.schema import CURATED, IDENTIFIER_COLUMNS, RECORD_ID, add_record_id
from monthfold.sinks.scratch import shared_folder
from monthfold.sinks.settings import FOLD_BYTES, session_options, small_splits
from monthfold.sinks.writers import append, delete_files, delete_folder, folder_bytes, write_curated, write_json, write_quarantine
from monthfold.sources.discovery import glob_literal, headers, headers_by_scan, list_files, logical_files
from monthfold.sources.tables import read_or_empty
from monthfold.sources.wide import Shape, read_wide, typed_wide, wide_schema, with_provenance
from monthfold.state import manifest
from monthfold.state import tables as state

log = logging.getLogger(__name__)

# Names the long form adds; an input column may not take one.
RESERVED = frozenset(
    "source_file load_timestamp month month_number quarter sales_amount sales_raw "
    "unparsed is_valid reject_reasons shape run_id cell record_id".split()
)

LISTED = ("path", "source_file", "length", "modification_time")

# Bytes of input that one wave of the staging scan reads.
WAVE_BYTES = 1 << 40

# The column of the buckets by which rows are dealt to find equal keys, and the most tasks of that step.
BUCKET = "__bucket"
MOST_TASKS = 20_000


@dataclass(frozen=True)
class Places:
    """Where a configuration keeps its tables."""

    curated: str
    unique: str
    summaries: str
    quarantine: str
    manifest: str
    ledger: str
    registry: str
    drift: str
    run_metrics: str
    summary: str

    @staticmethod
    def of(cfg: IngestConfig) -> Places:
        return Places(
            curated=f"{cfg.curated}/sales_normalized",
            unique=f"{cfg.curated}/sales_unique",
            summaries=f"{cfg.curated}/sales_summaries",
            quarantine=f"{cfg.staging}/invalid_records",
            manifest=f"{cfg.checkpoints}/manifest",
            ledger=f"{cfg.checkpoints}/ledger",
            registry=f"{cfg.checkpoints}/schema_registry",
            drift=f"{cfg.checkpoints}/drift_events",
            run_metrics=f"{cfg.logs}/run_metrics",
            summary=f"{cfg.logs}/summary",
        )


def read_ledger(spark: SparkSession, cfg: IngestConfig) -> DataFrame:
    return read_or_empty(spark, Places.of(cfg).ledger, state.LEDGER)


def read_registry(spark: SparkSession, cfg: IngestConfig) -> DataFrame:
    return read_or_empty(spark, Places.of(cfg).registry, state.REGISTRY)


def read_drift(spark: SparkSession, cfg: IngestConfig) -> DataFrame:
    return read_or_empty(spark, Places.of(cfg).drift, state.DRIFT)


def read_run_metrics(spark: SparkSession, cfg: IngestConfig) -> DataFrame:
    return read_or_empty(spark, Places.of(cfg).run_metrics, state.RUN_METRICS)


def read_manifest(spark: SparkSession, cfg: IngestConfig) -> DataFrame:
    return read_or_empty(spark, Places.of(cfg).manifest, manifest.ENTRY)


def snapshot(spark: SparkSession, cfg: IngestConfig, dataset: str = manifest.ROWS) -> manifest.Snapshot:
    """What is committed of the curated rows, or of the rows without duplicates between files."""
    return manifest.snapshot(read_manifest(spark, cfg), read_ledger(spark, cfg), dataset)


def _stored_schema(extra: Iterable[str]) -> T.StructType:
    """Curated columns, the run, the surrogate key, and further identifiers, which are text."""
    fields = [*CURATED.fields, T.StructField("run_id", T.StringType()), T.StructField(RECORD_ID, T.LongType())]
    return T.StructType(fields + [T.StructField(c, T.StringType()) for c in extra])


def read_curated(
    spark: SparkSession,
    cfg: IngestConfig,
    committed: bool = True,
    extra: tuple[str, ...] = (),
    record_ids: bool = False,
) -> DataFrame:
    """The curated table with its declared columns and any ``extra`` identifiers.

    By default only the rows of each file's latest successful run: the manifest names
    the folders that count, so the plan is a scan of them, without a join. With ``committed=False``
    everything that is stored. Under ``dedup_scope: global`` rows come from the table without
    duplicates between files, which each run brings up to date. ``record_ids`` adds the
    surrogate key that rows got when they were written.
    """
    places, schema = Places.of(cfg), _stored_schema(extra)
    shown = [*([RECORD_ID] if record_ids else []), *CURATED.names, *extra]
    if not committed:
        if cfg.output_format == "parquet":
            return read_or_empty(spark, places.curated, schema).select(*shown)
        return spark.read.format(cfg.output_format).schema(schema).load(places.curated).select(*shown)
    unique = cfg.rules().dedup and cfg.dedup_scope == "global"
    state_of = snapshot(spark, cfg, manifest.UNIQUE if unique else manifest.ROWS)
    rows = manifest.read(spark, places.unique if unique else places.curated, state_of.folders, schema, cfg.output_format)
    return rows.where(state_of.visible()).select(*shown)


def read_summaries(spark: SparkSession, cfg: IngestConfig) -> DataFrame:
    """The summaries of all partitions, for the reports of ``operators.summaries``.

    Runs with ``keep_summaries`` write them, and once a target has summaries every run brings them up to date.
    """
    places = Places.of(cfg)
    folders = snapshot(spark, cfg, manifest.SUMMARY).folders
    if not folders and snapshot(spark, cfg).folders:
        raise ConfigError("this target has no summaries; run with keep_summaries")
    return manifest.read(spark, places.summaries, folders, summaries.schema(cfg.partition_by))


def read_quarantine(spark: SparkSession, cfg: IngestConfig) -> DataFrame:
    """Rejects of each file's latest successful run."""
    long = [field for field in CURATED.fields]
    extra = [
        T.StructField("sales_raw", T.StringType()),
        T.StructField("unparsed", T.MapType(T.StringType(), T.StringType())),
        T.StructField("reject_reasons", T.ArrayType(T.StringType())),
        T.StructField("run_id", T.StringType()),
    ]
    rows = read_or_empty(spark, Places.of(cfg).quarantine, T.StructType(long + extra))
    return state.committed(rows, read_ledger(spark, cfg)).select(*[f.name for f in long + extra])


def _judge(found: DataFrame, cfg: IngestConfig, rules: Profile) -> tuple[DataFrame, list[tuple[str, ...]]]:
    """(parts with the ``shape`` of their header and the ``status`` of their file, distinct headers).

    ``found``: path, source_file, length, modification_time, columns, error. Only
    distinct headers reach the driver; what they mean for each file is worked out as a table.
    """
    spark = found.sparkSession
    distinct = sorted(tuple(r.columns) for r in found.where("error is null").select("columns").distinct().collect())
    measured = [_columns(header, cfg, rules)[1] for header in distinct]
    measure_names = {name.lower() for names in measured for name in names}
    labels = {label.lower() for names in measured for label in names.values()} | {m.lower() for m in MONTHS}
    judged = [
        (number, list(header), _header_problem(header, set(names), measure_names, labels), bool(names))
        for number, (header, names) in enumerate(zip(distinct, measured, strict=True))
    ]
    verdicts = spark.createDataFrame(judged, "shape int, columns array<string>, problem string, measured boolean")
    parts = found.join(verdicts, "columns", "left")
    problem = F.coalesce(F.concat(F.lit("error: "), "error"), "problem")
    files = parts.groupBy("source_file").agg(
        F.min(problem).alias("problem"), F.max("measured").alias("some"), F.min("measured").alias("every")
    )
    # Rows of a part without measures would be left out: the file as a whole is not what it should be.
    status = (
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(~F.col("some"), F.lit(state.SKIPPED))
        .when(~F.col("every"), F.lit("error: a part has no measure columns"))
        .otherwise(F.lit(state.SUCCESS))
    )
    return parts.drop("problem", "measured", "error").join(files.select("source_file", status.alias("status")), "source_file"), distinct


def _header_problem(
    columns: tuple[str, ...], measures: set[str], measure_names: set[str], labels: set[str]
) -> str | None:
    """Why files with this header cannot be read, if so.

    ``labels`` are the months of the calendar and those of the run's measures: a
    column may not be called like one, nor like a declared identifier in another case.
    """
    lowered = Counter(name.lower() for name in columns)
    repeated = sorted(name for name, times in lowered.items() if times > 1)
    if repeated:
        return f"error: duplicate columns {repeated}"
    taken = sorted((lowered.keys() & RESERVED) | {name for name in lowered if name.startswith("__")})
    if taken:
        return f"error: reserved column names {taken}"
    alike = sorted(name for name in columns if name not in measures and name.lower() in measure_names)
    if alike:
        return f"error: columns differ from measures by case only {alike}"
    months = sorted(name for name in columns if name.lower() in labels)
    if months:
        return f"error: columns are called like months {months}"
    cased = sorted(name for name in columns if name not in IDENTIFIER_COLUMNS and name.lower() in IDENTIFIER_COLUMNS)
    return f"error: columns differ from identifiers by case only {cased}" if cased else None


def _columns(header: tuple[str, ...], cfg: IngestConfig, rules: Profile) -> tuple[list[str], dict[str, str]]:
    return identifiers_and_measures(header, rules, cfg.sales_column_pattern, cfg.identifier_columns)


def _staged_shape(wide: DataFrame, columns: tuple[str, ...], cfg: IngestConfig, rules: Profile, run_ts: datetime) -> DataFrame:
    ids, measures = _columns(columns, cfg, rules)
    return typed_wide(with_provenance(wide, run_ts), ids, measures).select(
        *[f"`{c}`" for c in (*ids, *measures)], "source_file", "load_timestamp", "unparsed"
    )


def _unreadable_file(error: Exception, files: set[str]) -> str | None:
    """The file a failed scan names, if it is one of ours."""
    for path in map(unquote, re.findall(r"FAILED_READ_FILE.*? reading file (\S+)\.", str(error))):
        hits = [name for name in files if f"/{name}/" in path + "/" or f"/{name}." in path + "."]
        if hits:
            return max(hits, key=len)
    return None


@dataclass(frozen=True)
class Staged:
    """The wide rows of a run, typed and written once, with what their columns mean."""

    rows: DataFrame
    ids: list[str]
    measures: dict[str, str]
    present: dict[str, Column]
    constants: dict[str, Column]

    @property
    def provenance(self) -> list[str]:
        return ["source_file", "load_timestamp", "run_id"]


def _waves(parts: Iterable[Row], most: int) -> list[list[Row]]:
    """The parts in waves of about ``most`` bytes; parts of one file stay together."""
    out: list[list[Row]] = []
    room = 0
    for _, group in groupby(sorted(parts, key=lambda p: (p.source_file, p.path)), key=lambda p: p.source_file):
        members = list(group)
        size = sum(p.length for p in members)
        if not out or size > room:
            out.append([])
            room = most
        out[-1] += members
        room -= size
    return out


def _stage(
    spark: SparkSession,
    cfg: IngestConfig,
    rules: Profile,
    run_id: str,
    run_ts: datetime,
    parts: list[Row],
    distinct: list[tuple[str, ...]],
    folder: str,
    wave_bytes: int,
) -> tuple[Staged | None, set[str]]:
    """Write the typed wide rows of all files once; returns them as a table, and the files that failed.

    The only pass over the CSV text: one scan per distinct header and wave, no shuffle.
    Later steps read this table, which has one row per input row, so that losing an
    executor costs a re-read of Parquet and never a second parse. Each wave commits
    by itself. A wave with a file that turns out unreadable is written again without that file, in two
    halves, so that another such file costs half of it; waves that are written stay as they are.
    """
    if not parts:
        return None, set()
    # Headers of files in error do not count.
    used = sorted({part.shape for part in parts})
    shapes = [Shape(distinct[number], ()) for number in used]
    none = [
        _staged_shape(spark.createDataFrame([], wide_schema(s.columns)), s.columns, cfg, rules, run_ts).withColumn("shape", F.lit(0))
        for s in shapes
    ]
    empty = union_shapes(none).withColumn("run_id", F.lit(run_id))
    failed: set[str] = set()
    done: list[str] = []
    delete_folder(spark, folder)
    pending = _waves(parts, wave_bytes)[::-1]
    while pending:
        wave = pending.pop()
        paths: dict[int, list[str]] = {}
        for part in wave:
            paths.setdefault(used.index(part.shape), []).append(part.path)
        frames = []
        for number, names in sorted(paths.items()):
            shape = Shape(shapes[number].columns, tuple(sorted(names)))
            wide = _staged_shape(read_wide(spark, shape, cfg.source), shape.columns, cfg, rules, run_ts)
            frames.append(wide.withColumn("shape", F.lit(number)))
        rows = union_shapes([empty, *[frame.withColumn("run_id", F.lit(run_id)) for frame in frames]])
        target = f"{folder}/wave-{len(done) + len(failed):06d}"
        try:
            rows.write.mode("overwrite").option("compression", "zstd").parquet(target)
        except Exception as error:
            bad = _unreadable_file(error, {part.source_file for part in wave})
            if bad is None:
                raise
            log.warning("leaving out %s, which failed to read: %s", bad, error)
            failed.add(bad)
            left = [part for part in wave if part.source_file != bad]
            if left:
                pending += _waves(left, max(1, sum(part.length for part in left) // 2))[::-1]
            continue
        done.append(target)
    if not done:
        return None, failed
    constants = {"load_timestamp": F.lit(run_ts).cast("timestamp"), "run_id": F.lit(run_id)}
    return _described(spark.read.schema(empty.schema).parquet(*done), shapes, cfg, rules, constants), failed


def _described(
    rows: DataFrame, shapes: list[Shape], cfg: IngestConfig, rules: Profile, constants: dict[str, Column]
) -> Staged:
    measures: dict[str, str] = {}
    holders: dict[str, list[int]] = {}
    stored = {name.lower(): name for name in rows.columns}
    for number, shape in enumerate(shapes):
        own_ids, own_measures = _columns(shape.columns, cfg, rules)
        measures.update(own_measures)
        for name in (*own_ids, *own_measures):
            holders.setdefault(stored[name.lower()], []).append(number)
    present = {
        name: F.col("shape").isin(numbers) for name, numbers in holders.items() if len(numbers) < len(shapes)
    }
    return Staged(rows, [name for name in holders if name not in measures], measures, present, constants)


def _flagged(staged: Staged, rules: Profile) -> DataFrame:
    """Flagged long rows for the measures that each row's file has."""
    kept = [*staged.ids, *staged.provenance, "shape", "unparsed"]
    cells = [
        F.struct(
            F.col(f"`{name}`").alias("amount"), staged.present.get(name, F.lit(True)).alias("present")
        ).alias(label)
        for name, label in staged.measures.items()
    ]
    packed = staged.rows.select(*[f"`{c}`" for c in kept], *cells)
    long = unpivot_months(packed, kept, list(staged.measures.values()), value="cell")
    amounts = long.where("cell.present").withColumn("sales_amount", F.col("cell.amount")).drop("cell")
    return flagged_cells(amounts, rules, staged.ids, staged.present).drop("shape")


def _write_long(
    staged: Staged, cfg: IngestConfig, rules: Profile, accepted: dict[str, tuple[Column, Column]], last_id: int = 0
) -> tuple[int, int]:
    """Write the curated rows; returns how many and the last surrogate key, counted by the write itself.

    Keys follow ``last_id``, the largest that a committed run gave out: unique over
    runs, rising within a task, not dense.
    """
    extra = sorted(set(staged.ids) - set(IDENTIFIER_COLUMNS))
    constants = {c: staged.constants[c] for c in ("load_timestamp", "run_id")}
    if rules.dedup:
        # Folded wide rows are dealt for the write before they are unpivoted: one row for up to twelve.
        spread = [c for c in cfg.partition_by if c in staged.ids]
        kept = dedup_wide(staged.rows, [*staged.ids, "source_file"], accepted, spread=spread)
        kept, dealt = add_calendar(kept.withColumns(constants), rules), bool(spread)
    else:
        kept, dealt = split(_flagged(staged, rules))[0].drop("unparsed", "sales_raw"), False
    counted = Observation()
    keyed = add_record_id(to_output(kept, ["run_id", *extra]), last_id + 1)
    seen = keyed.observe(counted, F.count(F.lit(1)).alias("kept"), F.max(RECORD_ID).alias("last"))
    # Always added, never replaced: rows count once the ledger names their run.
    with small_splits(staged.rows.sparkSession):
        write_curated(seen, Places.of(cfg).curated, fmt=cfg.output_format, parts=[*cfg.partition_by, "run_id"], dealt=dealt)
    return counted.get["kept"], counted.get["last"] or last_id


def _file_counts(staged: Staged, rules: Profile, accepted: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Per file: wide rows, cells, valid cells and rejected cells, from the wide rows."""

    def how_many(conditions: list[Column]) -> Column:
        return reduce(add, [condition.cast("int") for condition in conditions])

    here = {name: staged.present.get(name, F.lit(True)) for name in staged.measures}
    cells, valid = how_many(list(here.values())), how_many([part for _, part in accepted.values()])
    rejected = cells - valid
    if rules.drops_blanks:
        rejected -= how_many(
            [
                here[name] & F.col(f"`{name}`").isNull() & ~holds_key(F.col("unparsed"), F.lit(label))
                for name, label in staged.measures.items()
            ]
        )
    return staged.rows.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum(cells).alias("long_records"),
        F.sum(valid).alias("valid_records"),
        F.sum(rejected).alias("invalid_records"),
    )


def run(
    spark: SparkSession,
    cfg: IngestConfig,
    incremental: bool = True,
    run_id: str | None = None,
    only: DataFrame | None = None,
    wave_bytes: int = WAVE_BYTES,
) -> DataFrame:
    """Ingest the pending files (all files if not ``incremental``); returns the run's metrics row.

    ``only`` is a listing (path, source_file, length, modification_time) to take in place of the source folder's,
    for callers that know what arrived. The manifest is written after the rows and the ledger last: a run that stops
    earlier leaves rows that :func:`read_curated` does not show, and its files stay pending. One run at a time per
    target. ``spark_options`` of the configuration hold for the run.
    """
    if incremental and not cfg.enable_incremental:
        raise ConfigError("an incremental run needs enable_incremental, or it would append files again")
    with session_options(spark, cfg.spark_options):
        return _run(spark, cfg, incremental, run_id, only, wave_bytes)


def _run(
    spark: SparkSession, cfg: IngestConfig, incremental: bool, run_id: str | None, only: DataFrame | None, wave_bytes: int
) -> DataFrame:
    started = datetime.now(timezone.utc)
    run_id = run_id or f"{started:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    places, rules = Places.of(cfg), cfg.rules()
    now = F.lit(started).cast("timestamp")
    target = hashlib.sha256(cfg.curated.encode()).hexdigest()[:16]
    scratch = f"{shared_folder(spark, cfg.staging)}/monthfold-run/{target}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
        return spark.read.schema(df.schema).parquet(f"{scratch}/{name}")

    # Listed once: what a folder holds may change while the run lasts.
    listing = kept(list_files(spark, cfg.source, cfg.file_pattern) if only is None else only.select(*LISTED), "listing")
    files = logical_files(listing)
    ledger = read_ledger(spark, cfg)
    wanted = state.pending(files, ledger) if incremental else files
    heads = kept(headers(listing.join(wanted.select("source_file"), "source_file", "left_semi").select(*LISTED)), "headers")
    lost = [row.path for row in heads.where("not reached").select("path").collect()]
    if lost:
        heads = _reached(spark, heads, lost)
    judged, distinct = _judge(heads, cfg, rules)
    parts = kept(judged, "parts")
    readable = parts.where(F.col("status") == state.SUCCESS).select("path", "source_file", "length", "shape").collect()
    staged, failed = _stage(spark, cfg, rules, run_id, started, readable, distinct, f"{scratch}/wide", wave_bytes)

    counts_schema = "source_file string, record_count long, long_records long, valid_records long, invalid_records long"
    counts = spark.createDataFrame([], counts_schema)
    if staged is not None:
        accepted = valid_cells(staged.rows, staged.ids, staged.measures, rules, staged.present)
        counts = kept(_file_counts(staged, rules, accepted), "file_counts")
    sums = counts.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts.columns if c != "source_file"]
    ).head()
    before = snapshot(spark, cfg)
    written, last_id = 0, before.last_id
    if staged is not None and sums.valid_records:
        written, last_id = _write_long(staged, cfg, rules, accepted, before.last_id)
    removed = sums.valid_records - written
    if sums.invalid_records and rules.keep_rejects:
        rejected = split(_flagged(staged, rules))[1]
        write_quarantine(rejected.drop("is_valid"), places.quarantine)

    status = F.when(F.col("source_file").isin(*sorted(failed)), F.lit("error: failed to read")).otherwise(F.col("status")) if failed else F.col("status")
    done = logical_files(parts).join(parts.select("source_file", status.alias("status")).distinct(), "source_file")
    states = {row.status: row.files for row in done.groupBy("status").agg(F.count(F.lit(1)).alias("files")).collect()}
    discovered = files.count()
    gone = None
    if not incremental and cfg.refresh == "full" and only is None:
        gone = state.replaced(ledger, files, run_id, now)
    if states or gone is not None:
        succeeded = done.where(F.col("status") == state.SUCCESS).select("source_file")
        ended = succeeded if gone is None else succeeded.unionByName(gone.select("source_file"))
        _record_manifest(spark, cfg, run_id, started, before, ended, written, last_id, compact=not incremental)
        _record_state(spark, cfg, run_id, now, done, counts, parts, gone)
    if not incremental:
        remove_superseded(spark, cfg)
    errors = [tuple(r) for r in done.where(F.col("status").startswith("error")).select("source_file", "status").orderBy("source_file").collect()]
    ended_at = datetime.now(timezone.utc)
    metrics = spark.createDataFrame(
        [
            (
                run_id,
                started,
                ended_at,
                (ended_at - started).total_seconds(),
                discovered,
                states.get(state.SUCCESS, 0),
                discovered - sum(states.values()),
                sums.record_count,
                sums.long_records,
                sums.valid_records,
                sums.invalid_records,
                removed,
                written,
                errors,
            )
        ],
        state.RUN_METRICS,
    )
    append(metrics, places.run_metrics)
    return metrics


def _reached(spark: SparkSession, heads: DataFrame, lost: list[str]) -> DataFrame:
    """Headers of files that tasks could not open by themselves, read by Spark instead."""
    found = headers_by_scan(spark, lost)
    rows = [(p, None, str(h)) if isinstance(h, Exception) else (p, list(h), None) for p, h in found.items()]
    again = spark.createDataFrame(rows, "path string, columns array<string>, error string")
    return heads.where("reached").unionByName(
        heads.where("not reached").drop("columns", "error").join(again, "path").select(*heads.columns)
    )


def _record_manifest(
    spark: SparkSession,
    cfg: IngestConfig,
    run_id: str,
    started: datetime,
    before: manifest.Snapshot,
    ended: DataFrame,
    written: int,
    last_id: int,
    compact: bool,
) -> None:
    """Append what the run adds and what it ends. ``ended``: files whose former rows no longer count.

    Few ended files are hidden by name. For many, or in a refresh, the folders that
    hold their rows are written anew without them, or removed where nothing else is in them.
    """
    places = Places.of(cfg)
    latest = state.latest(read_ledger(spark, cfg))
    wrote = bool(written)
    replaced = latest.join(ended, "source_file", "left_semi")
    count = replaced.count()
    added: list[manifest.Folder] = []
    removed: list[manifest.Folder] = []
    hidden: list[tuple[str, str]] = []
    moved: list[str] = []
    affected: set[str] = set()
    if count and not compact and count + len(before.hidden) <= manifest.MOST_HIDDEN:
        hidden = [(r.source_file, before.physical(r.run_id)) for r in replaced.collect()]
        affected = {run for _, run in hidden}
    elif count:
        logical = [r.run_id for r in replaced.select("run_id").distinct().collect()]
        affected = {before.physical(run) for run in logical} | {run for _, run in before.hidden}
        removed = [f for f in before.folders if f.run_id in affected]
        # Files that stay, by the run that holds them; none in a refresh that read all files.
        staying = latest.join(ended, "source_file", "left_anti")
        held = [r.run_id for r in staying.select("run_id").distinct().collect() if before.physical(r.run_id) in affected]
        if held and removed:
            stays = staying.where(F.col("run_id").isin(*held)).select("source_file")
            old = manifest.read(spark, places.curated, removed, _all_columns(spark, cfg), cfg.output_format)
            rows = old.where(before.visible()).join(stays, "source_file", "left_semi")
            write_curated(
                rows.withColumn("run_id", F.lit(run_id)), places.curated, fmt=cfg.output_format, parts=[*cfg.partition_by, "run_id"]
            )
            moved = sorted({before.physical(run) for run in held})
            wrote = True
    if wrote:
        added = manifest.written_by(spark, places.curated, cfg.partition_by, run_id)
    rows = [manifest.entries(spark, run_id, started, manifest.ROWS, added, removed, hidden, moved, last_id)]
    touched = {f.place for f in added} | {f.place for f in before.folders if f.run_id in affected}
    gone = {f.path for f in removed}
    now_live = [*[f for f in before.folders if f.path not in gone], *added]
    view = manifest.Snapshot(tuple(now_live), (*before.hidden, *hidden), before.moved, last_id)
    unique = cfg.rules().dedup and cfg.dedup_scope == "global"
    if unique:
        rows.append(_bring_up_unique(spark, cfg, run_id, started, view, touched))
    if cfg.keep_summaries or _run_folders(spark, cfg, places.summaries):
        rows.append(_bring_up_summaries(spark, cfg, run_id, started, view, touched, unique))
    append(union_shapes(rows), places.manifest)


def _all_columns(spark: SparkSession, cfg: IngestConfig) -> T.StructType:
    """The stored columns, with every further identifier that any stored file has."""
    stored = manifest.stored_columns(spark, Places.of(cfg).curated, cfg.output_format)
    return _stored_schema(sorted(stored - {*CURATED.names, "run_id", RECORD_ID}))


def _bring_up_unique(
    spark: SparkSession, cfg: IngestConfig, run_id: str, started: datetime, now: manifest.Snapshot, touched: set[str]
) -> DataFrame:
    """Write the rows without duplicates between files anew, in the partitions that the run touched.

    Equal keys are in one partition, because partition columns are key columns;
    where they are not, every partition counts as touched. Rows are dealt by partition
    and by buckets of keys that hold some ``FOLD_BYTES`` of the largest partition.
    """
    places = Places.of(cfg)
    keyed = set(cfg.partition_by) <= {*IDENTIFIER_COLUMNS, *DETERMINED, "month"}
    former = snapshot(spark, cfg, manifest.UNIQUE)
    schema = _all_columns(spark, cfg)
    folders = [f for f in now.folders if not keyed or f.place in touched]
    rows = manifest.read(spark, places.curated, folders, schema, cfg.output_format).where(now.visible())
    keys = [*IDENTIFIER_COLUMNS, *[c for c in schema.names if c not in {*CURATED.names, "run_id", RECORD_ID}], "month"]
    fixed = ("month_number", "quarter")
    together = bool(cfg.partition_by) and set(cfg.partition_by) <= {*keys, *fixed}
    settings = {}
    if together:
        # One shuffle for the keys and for the write; rows of a file have no equal keys, so nothing folds before it.
        sizes = Counter()
        for f in folders:
            sizes[f.place] += folder_bytes(spark, f.path)
        buckets = max(1, -(-max(sizes.values(), default=0) // FOLD_BYTES))
        bucket = F.pmod(F.hash(*[F.col(f"`{c}`") for c in keys]), F.lit(buckets))
        rows = rows.withColumn(BUCKET, bucket).repartition(*cfg.partition_by, BUCKET)
        keys.append(BUCKET)
        wanted = "spark.sql.shuffle.partitions"
        settings[wanted] = str(max(int(spark.conf.get(wanted)), min(2 * buckets * len(sizes), MOST_TASKS)))
    best = dedup(rows, keys, "global", determined=fixed).drop(BUCKET)
    with session_options(spark, settings), small_splits(spark):
        write_curated(
            best.withColumn("run_id", F.lit(run_id)),
            places.unique,
            fmt=cfg.output_format,
            parts=[*cfg.partition_by, "run_id"],
            dealt=together,
        )
    removed = [f for f in former.folders if not keyed or f.place in touched]
    added = manifest.written_by(spark, places.unique, cfg.partition_by, run_id)
    return manifest.entries(spark, run_id, started, manifest.UNIQUE, added, removed)


def _run_folders(spark: SparkSession, cfg: IngestConfig, table: str) -> list[tuple[str, str, str]]:
    """All folders of runs below a table, committed or not: names only."""
    return manifest.stored_folders(spark, table, f"{glob_literal(table)}/{'*/' * len(cfg.partition_by)}run_id=*")


def _bring_up_summaries(
    spark: SparkSession, cfg: IngestConfig, run_id: str, started: datetime, now: manifest.Snapshot, touched: set[str], unique: bool
) -> DataFrame:
    """Write the summaries of the partitions that the run touched anew; those of all partitions the first time.

    ``unique``: of the rows without duplicates between files, which this run has just brought up to date.
    """
    places = Places.of(cfg)
    former = snapshot(spark, cfg, manifest.SUMMARY)
    source, view = places.curated, now
    if unique:
        written = manifest.written_by(spark, places.unique, cfg.partition_by, run_id)
        stored = snapshot(spark, cfg, manifest.UNIQUE)
        # Places may have lost all their rows, and some runs write all of them anew.
        anew = touched | {f.place for f in written}
        touched, source = anew, places.unique
        view = manifest.Snapshot((*[f for f in stored.folders if f.place not in anew], *written), (), {}, 0)
    whole = not former.folders
    folders = [f for f in view.folders if whole or f.place in touched]
    rows = manifest.read(spark, source, folders, _stored_schema(()), cfg.output_format).where(view.visible())
    with small_splits(spark):
        write_curated(
            summaries.summarize(rows, cfg.partition_by).withColumn("run_id", F.lit(run_id)),
            places.summaries,
            parts=[*cfg.partition_by, "run_id"],
        )
    added = manifest.written_by(spark, places.summaries, cfg.partition_by, run_id)
    return manifest.entries(spark, run_id, started, manifest.SUMMARY, added, [f for f in former.folders if f.place in touched])


def _record_state(
    spark: SparkSession,
    cfg: IngestConfig,
    run_id: str,
    now: Column,
    done: DataFrame,
    counts: DataFrame,
    parts: DataFrame,
    gone: DataFrame | None = None,
) -> None:
    """Append new schemas, their drift events, and last of all the ledger rows.

    ``done``: the run's files with their status; ``parts``: their headers; ``gone``: ledger rows of files that a
    full refresh no longer found.
    """
    places = Places.of(cfg)
    if cfg.enable_schema_registry:
        sound = parts.where(F.col("status").isin(state.SUCCESS, state.SKIPPED)).select("source_file", "columns").distinct()
        allow = list(cfg.identifier_columns) if cfg.rules().allow_list else None
        new, drift = state.register(
            sound, read_registry(spark, cfg), cfg.sales_column_pattern, run_id, now, allow
        )
        append(drift, places.drift)
        append(new, places.registry)
    rows = state.ledger_rows(done, counts, run_id, now)
    append(rows if gone is None else rows.unionByName(gone), places.ledger)


def remove_superseded(spark: SparkSession, cfg: IngestConfig) -> int:
    """Delete stored folders that the manifest no longer names, and rejects of no committed run; returns how many.

    Rows of runs that stopped, of former versions of files, and of files that a full
    refresh no longer found are invisible already; this frees their space. A set difference of
    names: no curated row is read, and stopping on the way loses nothing. Rejects are few, and
    are looked at by file and run.
    """
    places, removed = Places.of(cfg), 0
    tables = ((places.curated, manifest.ROWS), (places.unique, manifest.UNIQUE), (places.summaries, manifest.SUMMARY))
    for table, dataset in tables:
        stored = _run_folders(spark, cfg, table)
        live = {f.path for f in snapshot(spark, cfg, dataset).folders} if stored else set()
        removed += sum(delete_folder(spark, path) for path, _, _ in stored if path not in live)
    try:
        rows = spark.read.schema("source_file string, run_id string").parquet(places.quarantine)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return removed
    return removed + delete_files(spark, state.dead_files(rows, read_ledger(spark, cfg)))


def write_summary(spark: SparkSession, cfg: IngestConfig) -> DataFrame:
    """Append the summary of the curated table, with figures of the last run, as JSON; returns it."""
    last = read_run_metrics(spark, cfg).agg(
        F.max_by(F.struct("duration_seconds", "files_processed", "end_time"), "start_time").alias("last")
    )
    summary = (
        reports.summary_months_list(read_curated(spark, cfg))
        .withColumn("last", last.scalar())
        .select("*", "last.duration_seconds", "last.files_processed", F.col("last.end_time").alias("timestamp"))
        .drop("last")
    )
    write_json(summary, Places.of(cfg).summary)
    return summary
