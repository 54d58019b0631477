"""Compare queries with their SQL at a scale factor: python tests/check_oracle.py [sf_dir] [name ...]."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from comparing import connect, spark_rows, sql_rows  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    wanted = sys.argv[2:] or list(entry.oracle_sql())
    bad = []
    for name in wanted:
        started = time.time()
        try:
            got = spark_rows(entry.queries()[name](spark, sf_dir))
            took = time.time() - started
            expected = sql_rows(connection, entry.oracle_sql()[name])
        except Exception as error:
            bad.append(name)
            print("FAIL", name, type(error).__name__, str(error)[:600], flush=True)
            continue
        if got == expected:
            print("ok  ", name, len(got[1]), f"{took:.1f}s", flush=True)
            continue
        bad.append(name)
        print("DIFF", name, got[0], expected[0], len(got[1]), len(expected[1]), flush=True)
        for mine, other in [(a, b) for a, b in zip(got[1], expected[1]) if a != b][:2]:
            print("   spark", mine, "\n   sql  ", other, flush=True)
    print(len(wanted) - len(bad), "of", len(wanted), "agree", bad)
