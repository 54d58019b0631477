"""Finding input files and reading their headers."""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What tasks need of this module goes along with them: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTING = "path string, source_file string, length bigint, modification_time timestamp"

# Files that one task opens at a time, bytes of a file that are read at once, and tasks per core.
HEADER_THREADS = 16
FIRST_BYTES = 65_536
TASKS_PER_CORE = 4


def glob_literal(path: str) -> str:
    """The path as a glob that matches only itself."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _base(directory: str) -> str:
    base = urlsplit(directory).path.rstrip("/") + "/"
    if not base.startswith("/"):
        raise ValueError(f"not an absolute path or URI: {directory}")
    return base


def logical_name(path: Column, directory: str) -> Column:
    """First path component below ``directory``: a file, or a directory of part files."""
    base = _base(directory)
    below = F.substr(path, F.locate(base, path) + F.lit(len(base)))
    return F.substring_index(below, "/", 1)


def scanned_path() -> Column:
    """Path of the file a row was scanned from, in the plain form that listings have."""
    escaped = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(escaped)


def list_files(spark: SparkSession, directory: str, pattern: str = "sales_*.csv") -> DataFrame:
    """Physical files below ``directory`` whose top-level name matches ``pattern``.

    A match may itself be a directory of part files, as distributed writers leave
    them; its parts share one ``source_file``. File contents are not read, and zero
    matches give an empty frame. Zero-byte files do not appear in a Spark listing.
    """
    _base(directory)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        found = reader.load(f"{glob_literal(directory.rstrip('/'))}/{pattern}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING)
    return found.select(
        "path",
        logical_name(F.col("path"), directory).alias("source_file"),
        "length",
        F.col("modificationTime").alias("modification_time"),
    )


def logical_files(listing: DataFrame) -> DataFrame:
    """One row per logical file with the identity a later run compares: name, size, time."""
    return listing.groupBy("source_file").agg(
        F.sum("length").alias("length"),
        F.max("modification_time").alias("modification_time"),
        F.count(F.lit(1)).cast("int").alias("parts"),
    )


def parse_header(line: str) -> tuple[str, ...]:
    """Column names of a CSV header line; a blank name becomes ``_c<position>``."""
    names = next(csv.reader([line.removeprefix("\ufeff")]), [])
    return tuple(name or f"_c{position}" for position, name in enumerate(names))


def _filled(line: str) -> bool:
    return bool(line.strip("\ufeff \t\r"))


def file_system(path: str) -> tuple[pafs.FileSystem, str, str]:
    """(file system, the path's name in it, what to put before such a name for a Spark path)."""
    scheme, below = re.fullmatch(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(.*)", path, re.DOTALL).groups()
    if scheme in (None, "file"):
        return pafs.LocalFileSystem(), "/" + below.lstrip("/"), "file:"
    authority, _, rest = below.removeprefix("//").partition("/")
    system, base = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    base = base.rstrip("/")
    # Object stores have the bucket in their names, others start at the root.
    prefix = f"{scheme}://" if base else f"{scheme}://{authority}"
    return system, f"{base}/{rest}", prefix


def _open(path: str) -> pa.NativeFile:
    """The file as a stream of its decompressed bytes."""
    system, name, _ = file_system(path)
    return system.open_input_stream(name, compression="detect", buffer_size=FIRST_BYTES)


def _first_line(path: str) -> str:
    """The first line that is not blank, which is the one a scan takes as header; reads no further."""
    with _open(path) as stream:
        seen = b""
        while True:
            block = stream.read(FIRST_BYTES)
            seen += block
            # An unfinished line may go on in the next block.
            lines = re.split(rb"\r\n|\n|\r", seen)
            whole = lines if not block else lines[:-1]
            for line in whole:
                text = line.decode("utf-8", "replace")
                if _filled(text):
                    return text
            if not block:
                raise ValueError("file has no header line")
            seen = lines[-1]


def _read_header(path: str) -> tuple[list[str] | None, str | None, bool]:
    """(columns, error, whether a task reaches the file system at all)."""
    try:
        return list(parse_header(_first_line(path))), None, True
    except pa.ArrowInvalid as error:
        return None, str(error), "filesystem" not in str(error)
    except (OSError, ValueError) as error:
        return None, str(error), True
    except NotImplementedError as error:
        return None, str(error), False


def _heads(batches):
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        for batch in batches:
            found = list(pool.map(_read_header, batch.column("path").to_pylist()))
            columns, errors, reached = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(columns, pa.list_(pa.string())),
                    pa.array(errors, pa.string()),
                    pa.array(reached, pa.bool_()),
                ],
                [*batch.schema.names, "columns", "error", "reached"],
            )


def headers(files: DataFrame) -> DataFrame:
    """The files (``path`` and any other columns) with their header's ``columns``, or the ``error`` of reading it.

    Paths are dealt over tasks, and each task opens its files by itself: one job for
    any number of files, of which only the first block is read. ``reached`` is false
    where tasks have no access to a path's file system; see :func:`headers_by_scan`.
    """
    tasks = TASKS_PER_CORE * files.sparkSession.sparkContext.defaultParallelism
    read = T.StructType().add("columns", T.ArrayType(T.StringType())).add("error", T.StringType()).add("reached", T.BooleanType())
    schema = T.StructType([*files.schema.fields, *read.fields])
    return files.repartition(tasks, "path").mapInArrow(_heads, schema)


def headers_by_scan(spark: SparkSession, paths: Iterable[str]) -> Mapping[str, tuple[str, ...] | Exception]:
    """Header of each file, or the error that reading it raised, by Spark's reader and one small job per file.

    For file systems that only Spark reaches.
    """

    def first(path: str) -> tuple[str, ...] | Exception:
        filled = F.length(F.translate("value", "\ufeff \t\r", "")) > 0
        try:
            row = spark.read.text(glob_literal(path)).where(filled).head()
        except Exception as error:  # one unreadable file must not stop the others
            return error
        return parse_header(row.value) if row else ValueError("file has no header line")

    wanted = list(paths)
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        return dict(zip(wanted, pool.map(first, wanted), strict=True))


def read_headers(spark: SparkSession, paths: Iterable[str]) -> Mapping[str, tuple[str, ...] | Exception]:
    """Header of each file, or the error that reading it raised, as a mapping for a few files."""
    files = spark.createDataFrame([(path,) for path in paths], "path string")
    found = {row.path: row for row in headers(files).collect()}
    out = {path: tuple(row.columns) if row.error is None else ValueError(row.error) for path, row in found.items()}
    return out | headers_by_scan(spark, [path for path, row in found.items() if not row.reached])
