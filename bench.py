"""Time the headline work and print one JSON line.

Reads the sample tables at $BENCH_SF_DIR and runs on local[$BENCH_CPUS]. Input
tables are derived and written before the clock starts. Every figure is the median
of $BENCH_RUNS runs after a warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from catalog import queries, tables  # noqa: E402
from monthfold.operators import audits, reports, reshape  # noqa: E402
from monthfold.operators.dedup import dedup  # noqa: E402
from monthfold.operators.validate import flag, metrics  # noqa: E402
from monthfold.plans import ingest  # noqa: E402
from monthfold.plans.normalize import normalize  # noqa: E402


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("monthfold-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def consume(df) -> None:
    """Compute every row and column and throw the result away."""
    df.write.format("noop").mode("overwrite").save()


def timed(job, runs: int):
    """Median seconds of the runs after a warm-up, and the last result."""
    job()
    taken, result = [], None
    for _ in range(runs):
        begun = time.time()
        result = job()
        taken.append(time.time() - begun)
    return round(statistics.median(taken), 3), result


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")

    started = time.time()
    source = tables.delivered(spark, sf)
    staged = tables.staged_wide(spark, sf)
    target = queries._config(spark, source)
    everything = tables.to_long(staged)
    repeated = tables.repeated(spark, sf)
    setup = time.time() - started

    def full_run():
        return ingest.run(spark, target, incremental=False)

    seconds = {}
    seconds["ingest_full_run"], last = timed(full_run, runs)
    curated = ingest.read_curated(spark, target)
    work = {
        "normalize_wide": lambda: consume(normalize(staged, queries.STRICT)),
        "unpivot_one_scan": lambda: consume(reshape.unpivot_months(staged, tables.IDS, tables.MEASURES, drop_nulls=True)),
        "unpivot_union_all": lambda: consume(reshape.unpivot_months_union(staged, tables.IDS, tables.MEASURES)),
        "validation_metrics": lambda: consume(metrics(flag(everything, queries.STRICT))),
        "dedup_within_file": lambda: consume(
            dedup(repeated, [*tables.IDS, "month"], determined=("month_number", "quarter"))
        ),
        "derive_wide": lambda: consume(tables.wide(spark, sf)),
        "sales_by_quarter": lambda: consume(reports.sales_by_quarter(curated)),
        "quarter_totals": lambda: consume(reports.quarter_totals(curated)),
        "sales_by_salesperson": lambda: consume(reports.sales_by_salesperson(curated)),
        "sales_by_state": lambda: consume(reports.sales_by_state(curated)),
        "null_key_audit": lambda: consume(audits.null_key_audit(staged)),
        "negative_by_month": lambda: consume(audits.negative_by_month(everything)),
        "duplicate_keys": lambda: consume(audits.duplicate_keys(curated)),
        "summary_stats": lambda: consume(reports.summary_stats(curated)),
        "summary_months_list": lambda: consume(reports.summary_months_list(curated)),
        "top10_salespeople": lambda: consume(reports.top_salespeople(curated)),
        "top10_states": lambda: consume(reports.top_states(curated)),
        "record_count": lambda: consume(reports.record_count(curated)),
    }
    for name, job in work.items():
        seconds[name], _ = timed(job, runs)
    figures = last.head()
    report = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "spark": spark.version,
        "setup_sec": round(setup, 3),
        "ingest_long_records": figures.long_records,
        "ingest_written_records": figures.total_records,
        "ingest_long_records_per_sec": round(figures.long_records / seconds["ingest_full_run"]),
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
