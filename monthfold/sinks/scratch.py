"""Where intermediate tables go: a folder that every executor reaches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's ``spark.checkpoint.dir``, else ``fallback``.

    Without either, a local session gets a temporary folder of its own; on a
    cluster that folder would exist on one machine only, so it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if folder:
        return folder.rstrip("/")
    if not (spark.conf.get("spark.master", None) or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="monthfold-")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_folder(spark)}/monthfold/{label}-{uuid.uuid4().hex}"
