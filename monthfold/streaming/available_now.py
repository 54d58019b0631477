"""Ingest driven by a file stream: take up what has arrived, then stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from monthfold.config import IngestConfig
from monthfold.plans.ingest import read_ledger, run
from monthfold.sources.discovery import logical_files
from monthfold.state import tables as state
from monthfold.streaming.arrivals import Arrivals


def run_available_now(
    spark: SparkSession,
    cfg: IngestConfig,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start a stream that ingests every file that arrived or was rewritten since the last call.

    The stream lists the folder once per trigger; its offset changes with the name, size or time
    of any file. Each micro-batch hands that listing to an ordinary incremental run, which
    takes what the ledger does not know in this version: new, rewritten and formerly failed files.
    So a repeated batch is harmless. ``max_files_per_trigger`` splits a batch into runs of so many files.
    """
    spark.dataSource.register(Arrivals)
    arrivals = (
        spark.readStream.format(Arrivals.name()).option("pattern", cfg.file_pattern).option("path", cfg.source.rstrip("/")).load()
    )

    def ingest(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # The source's rows are small but not kept: a run reads its listing more than once.
        waiting = state.pending(logical_files(batch), read_ledger(session, cfg))
        if max_files_per_trigger is None:
            if waiting.head() is not None:
                run(session, cfg, incremental=True, only=batch)
            return
        numbered = waiting.select("source_file", F.row_number().over(Window.orderBy("modification_time", "source_file")).alias("n"))
        last = numbered.agg(F.max("n")).head()[0] or 0
        for first in range(0, last, max_files_per_trigger):
            chosen = state.pending(logical_files(batch), read_ledger(session, cfg)).orderBy("modification_time", "source_file")
            names = chosen.limit(max_files_per_trigger).select("source_file")
            run(session, cfg, incremental=True, only=batch.join(names, "source_file", "left_semi"))

    return (
        arrivals.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
