"""Session settings that hold for a step only."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Files that a task of a partitioned write keeps open, and bytes of a table that a task folds at most.
OPEN_FILES = 100
FOLD_BYTES = 16 << 20


@contextmanager
def session_options(spark: SparkSession, options: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the time of a run; settings that a session cannot change are errors."""
    former = {name: spark.conf.get(name, None) for name in options}
    try:
        for name, value in options.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in former.items():
            if value is not None:
                spark.conf.set(name, value)
            elif spark.conf.get(name, None) is not None:
                spark.conf.unset(name)


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Let tasks of a partitioned write keep one file per partition open, where the session says nothing else.

    Without it a task sorts all its rows by partition, and rows beyond its memory are spilled. A task
    with more partitions than ``OPEN_FILES`` sorts the rows of the others.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    with session_options(spark, {} if int(spark.conf.get(name)) else {name: str(OPEN_FILES)}):
        yield


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Scans in splits of at most ``FOLD_BYTES``, so that what a task folds before a shuffle fits its memory.

    Rows of the tables here take some ten times their Parquet size in an aggregate.
    """
    name = "spark.sql.files.maxPartitionBytes"
    unit = {"b": 0, "k": 10, "kb": 10, "m": 20, "mb": 20, "g": 30, "gb": 30, "t": 40, "tb": 40, "p": 50, "pb": 50}
    text = spark.conf.get(name).strip().lower()
    number = text.rstrip("bkmgtp")
    current = int(number) << unit[text[len(number) :] or "b"]
    with session_options(spark, {name: f"{FOLD_BYTES}b"} if current > FOLD_BYTES else {}):
        yield
