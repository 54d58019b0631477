from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from monthfold.functions.months import MONTHS, month_number, quarter_of
from monthfold.operators import reshape
from monthfold.schema import CURATED, SALES_COLUMN_PATTERN, add_record_id, classify


def test_classify_is_case_sensitive_and_three_letters():
    columns = ["salesperson_id", "Jan_sales", "jan_sales", "January_sales", "Foo_sales", "region"]
    ids, measures = classify(columns, SALES_COLUMN_PATTERN)
    assert measures == ["Jan_sales", "Foo_sales"]
    assert ids == ["salesperson_id", "jan_sales", "January_sales", "region"]
    ids, measures = classify(columns, SALES_COLUMN_PATTERN, allow=["salesperson_id", "year"])
    assert (ids, measures) == (["salesperson_id"], ["Jan_sales", "Foo_sales"])


def test_classify_leaves_provenance_out():
    assert classify(["source_file", "load_timestamp", "a"], SALES_COLUMN_PATTERN) == (["a"], [])


def test_month_numbers_and_quarters(spark):
    rows = spark.createDataFrame([(m,) for m in (*MONTHS, "Foo", None)], "month string")
    got = rows.select(
        "month",
        month_number(F.col("month"), "zero").alias("zero"),
        month_number(F.col("month"), "null").alias("null"),
    ).withColumns({"q0": quarter_of(F.col("zero")), "qn": quarter_of(F.col("null"))})
    by_month = {row.month: row for row in got.collect()}
    for number, month in enumerate(MONTHS, start=1):
        assert by_month[month].zero == by_month[month]["null"] == number
        assert by_month[month].q0 == by_month[month].qn == (number + 2) // 3
    assert (by_month["Foo"].zero, by_month["Foo"].q0) == (0, 0)
    assert (by_month["Foo"]["null"], by_month["Foo"].qn) == (None, None)
    assert (by_month[None].zero, by_month[None]["null"]) == (0, None)


def test_mixed_measure_types_meet(spark):
    df = spark.sql("SELECT 1 AS id, 5 AS Jan_sales, 2.5D AS Feb_sales, 'N/A' AS Mar_sales")
    typed = reshape.cast_measures(df, ["Jan_sales", "Feb_sales", "Mar_sales"])
    assert typed.head() == (1, Decimal("5.00"), Decimal("2.50"), None)
    raw = reshape.unpivot_months(df, ["id"], ["Jan_sales", "Feb_sales", "Mar_sales"])
    assert sorted(raw.collect()) == [(1, "Feb", "2.5"), (1, "Jan", "5"), (1, "Mar", "N/A")]


def test_nan_and_overflow_become_null(spark):
    df = spark.sql("SELECT 'NaN' AS Jan_sales, '1e30' AS Feb_sales, ' 7 ' AS Mar_sales")
    got = reshape.cast_measures(df, ["Jan_sales", "Feb_sales", "Mar_sales"]).head()
    assert tuple(got) == (None, None, Decimal("7.00"))


@pytest.fixture(scope="module")
def wide(spark):
    columns = ", ".join(
        f"CAST(IF((id * 7 + {n}) % 5 = 0, NULL, id * {n} - 20) AS decimal(18,2)) AS {m}_sales"
        for n, m in enumerate(MONTHS, start=1)
    )
    return spark.sql(f"SELECT id, concat('n', id) AS name, {columns} FROM range(50)")


def test_unpivot_forms_agree(spark, wide):
    measures = [f"{m}_sales" for m in MONTHS]
    once = reshape.unpivot_months(wide, ["id", "name"], measures, drop_nulls=True)
    once = reshape.add_quarter(reshape.add_month_number(once, "null"))
    union = reshape.unpivot_months_union(wide, ["id", "name"], measures)
    wide.createOrReplaceTempView("unpivot_input")
    listed = ", ".join(f"{m}_sales AS {m}" for m in MONTHS)
    in_sql = spark.sql(f"SELECT * FROM unpivot_input UNPIVOT (sales_amount FOR month IN ({listed}))")
    order = union.columns
    assert sorted(once.select(*order).collect()) == sorted(union.collect())
    assert sorted(once.select(*in_sql.columns).collect()) == sorted(in_sql.collect())


def test_unpivot_row_law_and_round_trip(wide):
    measures = [f"{m}_sales" for m in MONTHS]
    long = reshape.unpivot_months(wide, ["id", "name"], measures)
    assert long.count() == wide.count() * 12
    back = long.groupBy("id", "name").pivot("month", list(MONTHS)).agg(F.max("sales_amount"))
    renamed = back.select("id", "name", *[F.col(m).alias(f"{m}_sales") for m in MONTHS])
    assert sorted(map(repr, renamed.collect())) == sorted(map(repr, wide.select(*renamed.columns).collect()))


def test_months_argument_reads_only_those_columns(wide):
    measures = [f"{m}_sales" for m in MONTHS]
    some = reshape.unpivot_months(wide, ["id"], measures, months=("Jan", "Dec"))
    assert {row.month for row in some.select("month").distinct().collect()} == {"Jan", "Dec"}
    assert reshape.unpivot_months(wide, ["id"], measures, months=("Foo",)).count() == 0


def test_no_measures_is_an_error(wide):
    with pytest.raises(reshape.NoMeasureColumns):
        reshape.unpivot_months(wide, ["id"], [])


def test_label_that_is_an_identifier_is_an_error(spark):
    df = spark.sql("SELECT 1 AS Jan, 2 AS Jan_sales")
    with pytest.raises(ValueError, match="collide"):
        reshape.unpivot_months(df, ["Jan"], ["Jan_sales"])


def test_union_keeps_reordered_columns_in_place(spark):
    first = spark.sql("SELECT 1 AS salesperson_id, 2 AS store_id, 10 AS Jan_sales")
    second = spark.sql("SELECT 20 AS Feb_sales, 4 AS store_id, 3 AS salesperson_id")
    got = sorted(map(tuple, reshape.union_shapes([first, second]).collect()))
    assert got == [(1, 2, 10, None), (3, 4, None, 20)]


def test_output_schema(spark):
    df = reshape.to_output(spark.sql("SELECT 1L AS year, 'Jan' AS month, 'x' AS region"), ["region"])
    assert df.columns == [*CURATED.names, "region"]
    assert df.schema["year"].dataType == CURATED["year"].dataType
    assert df.head().salesperson_name is None


def test_record_ids_are_unique_and_offset(spark):
    ids = [row.record_id for row in add_record_id(spark.range(0, 1000, 1, 7), start=100).collect()]
    assert len(set(ids)) == 1000
    assert min(ids) == 100
