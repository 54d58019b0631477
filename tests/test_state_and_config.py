from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from monthfold.config import ConfigError, IngestConfig, from_mapping, load_config
from monthfold.schema import SALES_COLUMN_PATTERN
from monthfold.state import tables as state

PATHS = {name: f"/data/{name}" for name in ("source", "staging", "curated", "checkpoints", "logs")}
NOW = datetime(2026, 1, 2, 3, 4, 5)


def ledger(spark, *rows):
    return spark.createDataFrame(
        [(f, n, NOW, 1, status, 1, 1, 1, 0, run, NOW) for f, n, status, run in rows], state.LEDGER
    )


def files(spark, *rows):
    return spark.createDataFrame(
        [(f, n, NOW, 1) for f, n in rows], "source_file string, length bigint, modification_time timestamp, parts int"
    )


def test_pending(spark):
    known = ledger(
        spark, ("done", 1, state.SUCCESS, "r"), ("failed", 1, "error: x", "r"), ("grown", 1, state.SUCCESS, "r"),
        ("none", 1, state.SKIPPED, "r"),
    )
    now = files(spark, ("done", 1), ("failed", 1), ("grown", 2), ("none", 1), ("new", 1))
    assert sorted(r.source_file for r in state.pending(now, known).collect()) == ["failed", "grown", "new"]


def test_committed_rows_are_those_of_the_latest_success(spark):
    known = ledger(spark, ("a", 1, state.SUCCESS, "r1"), ("a", 2, state.SUCCESS, "r2"), ("b", 1, "error: x", "r2"))
    rows = spark.createDataFrame(
        [("a", "r1", 1), ("a", "r2", 2), ("b", "r2", 3), ("c", "r3", 4)], "source_file string, run_id string, v int"
    )
    assert [r.v for r in state.committed(rows, known).collect()] == [2]


def schemas(spark, **named):
    return spark.createDataFrame([(f, c.split()) for f, c in named.items()], "source_file string, columns array<string>")


def test_schemas_of_equal_size_stay_apart(spark):
    none = spark.createDataFrame([], state.REGISTRY)
    given = schemas(spark, q1="id Jan_sales Feb_sales", q2="id Apr_sales May_sales", again="Feb_sales Jan_sales id")
    new, drift = state.register(given, none, SALES_COLUMN_PATTERN, "r", F.lit(NOW))
    rows = {r.first_file: r for r in new.collect()}
    assert set(rows) == {"again", "q2"}
    assert {r.count_key for r in rows.values()} == {"cols_3_sales_2"}
    assert rows["q2"].sales_columns == ["Apr_sales", "May_sales"] and rows["q2"].identifier_columns == ["id"]
    assert drift.count() == 2
    more = schemas(spark, q3="id region Jul_sales", q1="id Jan_sales Feb_sales")
    later, events = state.register(more, new, SALES_COLUMN_PATTERN, "r2", F.lit(NOW))
    assert [r.first_file for r in later.collect()] == ["q3"]
    event = events.head()
    assert set(event.added_columns) == {"region", "Jul_sales"} and len(event.removed_columns) == 2
    assert [r.sales_column for r in state.known_measures(new.unionByName(later)).collect()] == [
        "Apr_sales", "Feb_sales", "Jan_sales", "Jul_sales", "May_sales"
    ]


def test_config_from_yaml(tmp_path):
    path = tmp_path / "config.yaml"
    path.write_text(
        "paths: {source: /in, staging: /st, curated: /cu, checkpoints: /cp, logs: /lg}\n"
        "schema: {sales_column_pattern: '^([A-Z][a-z]{2})_sales$', identifier_columns: [salesperson_id, year]}\n"
        "processing: {file_pattern: 'x_*.csv', partition_by: [year]}\n"
        "features: {enable_deduplication: false, enable_validation: true}\n"
        "validation: {reject_negative_sales: false, max_sales_value: 500}\n"
        "spark: {app_name: x, config: {spark.sql.adaptive.enabled: 'true'}}\n"
    )
    cfg = load_config(str(path))
    assert (cfg.source, cfg.file_pattern, cfg.partition_by) == ("/in", "x_*.csv", ("year",))
    rules = cfg.rules()
    assert rules.required == ("salesperson_id", "year")
    assert (rules.reject_negative, rules.max_amount, rules.dedup) == (False, Decimal(500), False)
    assert cfg.spark_options == {"spark.sql.adaptive.enabled": "true"}


def test_config_errors():
    with pytest.raises(ConfigError, match="paths not set"):
        from_mapping({"paths": {"source": "/in"}})
    with pytest.raises(ConfigError, match="unknown setting"):
        from_mapping({"paths": PATHS, "features": {"enable_magic": True}})
    with pytest.raises(ConfigError, match="profile"):
        IngestConfig(**PATHS, profile="none")
    with pytest.raises(ConfigError, match="scope"):
        IngestConfig(**PATHS, dedup_scope="all")
    with pytest.raises(ConfigError, match="refresh"):
        IngestConfig(**PATHS, refresh="some")


def test_switches_do_not_widen_a_profile():
    rules = IngestConfig(**PATHS, profile="sql_insert", max_sales_value=Decimal(5)).rules()
    assert (rules.max_amount, rules.reject_negative, rules.dedup) == (None, False, False)
