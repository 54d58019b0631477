"""Which stored folders hold committed rows: a manifest per run, so that reads need no join.

Data folders end in ``run_id=<run>``. A run appends its entries before its ledger rows;
entries count once the ledger names their run, so an interrupted run changes nothing.

=======  ==========================================================================
action   meaning
=======  ==========================================================================
add      a data folder (``path``, ``place`` below the table) the run wrote
remove   a data folder that no longer counts
hide     rows of ``source_file`` in the folders of ``of_run`` no longer count
moved    what counted of the logical run ``of_run`` was written anew by this run
ids      ``last_id``: the largest surrogate key the run gave out
=======  ==========================================================================

Hidden rows are left out by a literal predicate. Once there are more than
``MOST_HIDDEN`` of them, the run that goes beyond writes the folders concerned anew.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthfold.sources.discovery import _base, glob_literal

ENTRY = T.StructType(
    [T.StructField("run_id", T.StringType()), T.StructField("committed_at", T.TimestampType())]
    + [T.StructField(name, T.StringType()) for name in ("dataset", "action", "path", "place", "source_file", "of_run")]
    + [T.StructField("last_id", T.LongType())]
)
MOST_HIDDEN = 256
ROWS, UNIQUE, SUMMARY = "rows", "unique", "summary"


@dataclass(frozen=True)
class Folder:
    """A data folder: its path, its place below the table without the run, and its run."""

    path: str
    place: str
    run_id: str


@dataclass(frozen=True)
class Snapshot:
    """What counts of a dataset: folders, hidden (source_file, run) pairs, moved runs, the last surrogate key."""

    folders: tuple[Folder, ...]
    hidden: tuple[tuple[str, str], ...]
    moved: dict[str, str]
    last_id: int

    def physical(self, run_id: str) -> str:
        """The run whose folders hold what a logical run wrote."""
        while run_id in self.moved:
            run_id = self.moved[run_id]
        return run_id

    def visible(self) -> Column:
        """Predicate over (source_file, run_id): the row is not hidden."""
        hit = [(F.col("run_id") == run) & F.col("source_file").isin(*names) for run, names in self._by_run().items()]
        return ~reduce(lambda a, b: a | b, hit) if hit else F.lit(True)

    def _by_run(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for name, run in self.hidden:
            out.setdefault(run, []).append(name)
        return out


def snapshot(entries: DataFrame, ledger: DataFrame, dataset: str = ROWS) -> Snapshot:
    """The committed state. The driver gets what counts: live folders, pairs still hidden, moves."""
    done = ledger.select("run_id").distinct()
    own = entries.where(F.col("dataset") == dataset).join(done, "run_id", "left_semi")
    ended = F.max(F.col("action") == "remove").alias("ended")
    live = own.where(F.col("action").isin("add", "remove")).groupBy("path").agg(
        ended, F.max(F.when(F.col("action") == "add", F.struct("place", "run_id"))).alias("at")
    )
    kept = live.where(~F.col("ended") & F.col("at").isNotNull()).select(
        F.lit("add").alias("action"), "path", F.col("at.place").alias("place"), F.col("at.run_id").alias("run_id"), F.lit(None).alias("source_file"), F.lit(None).alias("of_run"), F.lit(None).cast("long").alias("last_id")
    )
    rest = own.where(F.col("action").isin("hide", "moved")).select("action", "path", "place", "run_id", "source_file", "of_run", "last_id")
    most = own.where(F.col("action") == "ids").groupBy("action").agg(F.max("last_id").alias("last_id"))
    ids = most.select("action", *[F.lit(None).alias(c) for c in ("path", "place", "run_id", "source_file", "of_run")], "last_id")
    rows = kept.unionByName(rest).unionByName(ids).collect()
    folders = tuple(sorted((Folder(r.path, r.place, r.run_id) for r in rows if r.action == "add"), key=lambda f: f.path))
    runs = {f.run_id for f in folders}
    hidden = tuple(sorted({(r.source_file, r.of_run) for r in rows if r.action == "hide" and r.of_run in runs}))
    return Snapshot(folders, hidden, {r.of_run: r.run_id for r in rows if r.action == "moved"}, max((r.last_id for r in rows if r.action == "ids"), default=0))


def written_by(spark: SparkSession, table: str, parts: Sequence[str], run_id: str) -> list[Folder]:
    """The data folders that a run wrote; ``parts`` are the partition columns before the run."""
    pattern = f"{glob_literal(table)}/{'*/' * len(parts)}run_id={glob_literal(run_id)}"
    return [Folder(path, place, run_id) for path, place, _ in stored_folders(spark, table, pattern)]


def stored_folders(spark: SparkSession, table: str, pattern: str) -> list[tuple[str, str, str]]:
    """(path, place below the table, run) of the data folders that match; names only, nothing is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(conf).globStatus(path) or []
    base, out = _base(table), []
    for status in found:
        name = status.getPath().toString()
        below = name[name.index(base) + len(base) :]
        place, _, run = below.rpartition("run_id=")
        out.append((name, place.rstrip("/"), run))
    return sorted(out)


def read(
    spark: SparkSession, table: str, folders: Iterable[Folder], schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """The rows of some folders of a table, with the values of the partition columns."""
    paths = [glob_literal(f.path) for f in folders]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).option("basePath", table).load(paths)


def entries(
    spark: SparkSession,
    run_id: str,
    now: datetime,
    dataset: str,
    added: Iterable[Folder] = (),
    removed: Iterable[Folder] = (),
    hidden: Iterable[tuple[str, str]] = (),
    moved: Iterable[str] = (),
    last_id: int | None = None,
) -> DataFrame:
    """The entries of a run for one dataset."""

    def row(action: str, path=None, place=None, name=None, of=None, last=None) -> tuple:
        return (run_id, now, dataset, action, path, place, name, of, last)

    rows = [row("add", f.path, f.place) for f in added] + [row("remove", f.path, f.place) for f in removed]
    rows += [row("hide", name=name, of=of) for name, of in hidden] + [row("moved", of=of) for of in moved]
    if last_id is not None:
        rows.append(row("ids", last=last_id))
    return spark.createDataFrame(rows, ENTRY)


def stored_columns(spark: SparkSession, table: str, fmt: str) -> set[str]:
    """Columns that any stored file of the table has."""
    try:
        return set(spark.read.format(fmt).option("mergeSchema", True).load(table).columns)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return set()
