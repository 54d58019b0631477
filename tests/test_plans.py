"""What the physical plans look like: scans, shuffles, pushed filters, codegen."""

import re

import pytest

from catalog import queries, tables
from monthfold.operators import reports, reshape
from monthfold.operators.dedup import dedup
from monthfold.operators.validate import split
from monthfold.plans.normalize import long_rows, normalize
from monthfold.sinks import writers

SF = "/root/testdata/sf0.001"
MEASURES, IDS = tables.MEASURES, tables.IDS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern, text):
    return len(re.findall(pattern, text))


@pytest.fixture(scope="module")
def staged(spark):
    return tables.staged_wide(spark, SF)


def test_unpivot_is_one_scan_without_a_shuffle(staged):
    once = plan(reshape.unpivot_months(staged, IDS, MEASURES))
    assert count("FileScan", once) == 1 and "Exchange" not in once
    union = plan(reshape.unpivot_months_union(staged, IDS, MEASURES))
    assert count("FileScan", union) == 12


def test_identifier_filter_and_pruning_reach_the_scan(staged):
    long = reshape.unpivot_months(staged, IDS, MEASURES, months=("Jan",)).where("year = 1999").select("year", "sales_amount")
    text = plan(long)
    assert "EqualTo(year,1999)" in text
    assert "ReadSchema: struct<year:int,Jan_sales:decimal(18,2)>" in text


def test_normalize_shuffles_wide_rows_once(staged):
    text = plan(normalize(staged, queries.STRICT))
    assert count("Exchange hashpartitioning", text) == 1
    assert text.index("Expand") < text.index("Exchange")  # the tree prints the last operator first
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text and "Window" not in text


def test_dedup_is_a_partial_hash_aggregate(spark):
    rows = tables.repeated(spark, SF)
    text = plan(dedup(rows, [*IDS, "month"], determined=("month_number", "quarter")))
    assert "partial_max(sales_amount" in text
    assert "SortAggregate" not in text and "Window" not in text


def test_month_filter_prunes_partitions(spark, staged, tmp_path):
    path = str(tmp_path / "curated")
    writers.write_curated(tables.to_long(staged), path, mode="overwrite")
    text = plan(reports.sales_by_state(spark.read.parquet(path).where("month = 'Jan'")))
    assert re.search(r"PartitionFilters: \[[^\]]*month", text)
    assert "ReadSchema: struct<sales_state_id:int,sales_state_name:string,store_id:int,sales_amount:decimal(18,2)>" in text


def test_top_k_needs_no_full_sort(staged):
    assert "TakeOrderedAndProject" in plan(reports.top_salespeople(tables.to_long(staged)))


@pytest.mark.parametrize("name", ["lateral_month_number", "sales_by_quarter", "null_key_audit", "normalize_all_shapes"])
def test_no_cross_joins(spark, name):
    text = plan(queries.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_library_code_avoids_slow_paths():
    import pathlib

    root = pathlib.Path(queries.__file__).parent.parent
    for file in [*root.glob("monthfold/**/*.py"), *root.glob("catalog/*.py")]:
        text = file.read_text()
        for word in ("localCheckpoint", "crossJoin", "applyInPandas", "pandas_udf", ".toPandas(", ".rdd", "coalesce(1)"):
            assert word not in text, (file, word)


@pytest.mark.parametrize("name", ["normalize", "rejects", "by quarter", "wide"])
def test_generated_methods_stay_small_enough_to_compile(spark, staged, name):
    """Methods over 8000 bytes are interpreted by the JVM, not compiled."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = {
            "normalize": lambda: normalize(staged, queries.STRICT),
            "rejects": lambda: split(long_rows(staged, queries.STRICT))[1],
            "by quarter": lambda: reports.sales_by_quarter(tables.to_long(staged)),
            "wide": lambda: tables.wide(spark, SF),
        }[name]()
        executed = frame._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(executed)
    biggest = [
        int(re.search(r"\((\d+)", stages.apply(position)._3().toString()).group(1)) for position in range(stages.size())
    ]
    assert biggest and max(biggest) < 8000, biggest
