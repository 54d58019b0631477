import gzip
import os

import pytest
from pyspark.sql import functions as F

from monthfold.sources.discovery import list_files, logical_files, parse_header, read_headers
from monthfold.sources.tables import read_or_empty, read_table
from monthfold.sources.wide import group_by_header, read_wide, typed_wide
from monthfold.schema import CURATED
from monthfold.sinks import writers


def put(folder, name, text):
    path = os.path.join(str(folder), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(text)
    return path


def names(df):
    return sorted(row.source_file for row in df.collect())


def test_discovery_matches_names_and_keeps_parts_together(spark, tmp_path):
    put(tmp_path, "sales_a.csv", "x\n1\n")
    put(tmp_path, "other.csv", "x\n1\n")
    put(tmp_path, "sales_zero.csv", "")
    put(tmp_path, "sales_dir.csv/part-0.csv", "x\n1\n")
    put(tmp_path, "sales_dir.csv/part-1.csv", "x\n22\n")
    listing = list_files(spark, str(tmp_path))
    assert names(listing) == ["sales_a.csv", "sales_dir.csv", "sales_dir.csv"]
    files = {row.source_file: row for row in logical_files(listing).collect()}
    assert (files["sales_dir.csv"].parts, files["sales_dir.csv"].length) == (2, 9)


def test_discovery_of_nothing(spark, tmp_path):
    assert list_files(spark, str(tmp_path / "absent")).count() == 0
    with pytest.raises(ValueError, match="absolute"):
        list_files(spark, "relative/folder", "*").count()


@pytest.mark.parametrize("name", ["sales_a b.csv", "sales_a+b%20c.csv", "sales_[x].csv", "sales_{y}.csv", "sales_ü.csv"])
def test_awkward_names(spark, tmp_path, name):
    put(tmp_path, name, "store_id,Jan_sales\n1,2\n")
    put(tmp_path, "sales_x.csv", "store_id,Feb_sales\n1,2\n")
    headers = read_headers(spark, [row.path for row in list_files(spark, str(tmp_path)).collect()])
    frames = [read_wide(spark, shape, str(tmp_path)) for shape in group_by_header(headers)]
    assert len(frames) == 2
    assert sorted(name for frame in frames for name in names(frame)) == sorted([name, "sales_x.csv"])


def test_header_parsing():
    assert parse_header('a,"b,c",,d') == ("a", "b,c", "_c2", "d")
    assert parse_header("﻿a,b") == ("a", "b")
    assert parse_header("") == ()


def test_headers_of_many_files(spark, tmp_path):
    for number in range(30):
        body = "1,2\n" * (50_000 if number == 0 else 3)
        put(tmp_path, f"sales_{number}.csv", f"a,b{number % 4}\n{body}")
    put(tmp_path, "sales_only_header.csv", "a,b\n")
    paths = [row.path for row in list_files(spark, str(tmp_path)).collect()]
    got = read_headers(spark, paths)
    assert len(got) == 31
    for path, header in got.items():
        number = os.path.basename(path).removeprefix("sales_").removesuffix(".csv")
        assert header == (("a", "b") if number == "only_header" else ("a", f"b{int(number) % 4}"))


def test_header_of_a_broken_file_is_an_error(spark, tmp_path):
    put(tmp_path, "sales_ok.csv", "a\n1\n")
    with open(tmp_path / "sales_bad.csv.gz", "wb") as handle:
        handle.write(b"this is no gzip data")
    with open(tmp_path / "sales_good.csv.gz", "wb") as handle:
        handle.write(gzip.compress(b"a,c\n1,2\n"))
    paths = [row.path for row in list_files(spark, str(tmp_path), "sales_*").collect()]
    paths.append(f"file:{tmp_path}/sales_gone.csv")
    got = {os.path.basename(path): header for path, header in read_headers(spark, paths).items()}
    assert got["sales_ok.csv"] == ("a",) and got["sales_good.csv.gz"] == ("a", "c")
    assert isinstance(got["sales_bad.csv.gz"], Exception) and isinstance(got["sales_gone.csv"], Exception)


def test_blank_lines_before_the_header(spark, tmp_path):
    put(tmp_path, "sales_a.csv", "\n  \na,b\n1,2\n")
    (path,) = [row.path for row in list_files(spark, str(tmp_path)).collect()]
    headers = read_headers(spark, [path])
    assert headers == {path: ("a", "b")}
    (shape,) = group_by_header(headers)
    assert [(r.a, r.b) for r in read_wide(spark, shape, str(tmp_path)).collect()] == [("1", "2")]


def test_shapes_follow_the_column_order():
    shapes = group_by_header({"p1": ("a", "b"), "p2": ("b", "a"), "p3": ("a", "b")})
    assert [(s.columns, s.paths) for s in shapes] == [(("a", "b"), ("p1", "p3")), (("b", "a"), ("p2",))]


def test_short_rows_are_padded(spark, tmp_path):
    put(tmp_path, "sales_a.csv", "store_id,Jan_sales,Feb_sales\n1,2\n3,4,5\n")
    (shape,) = group_by_header(read_headers(spark, [str(tmp_path / "sales_a.csv")]))
    got = sorted(map(tuple, read_wide(spark, shape, str(tmp_path)).drop("source_file").collect()))
    assert got == [("1", "2", None, None), ("3", "4", "5", None)]


def test_unparsed_values_are_kept(spark):
    df = spark.sql("SELECT 'x' AS store_id, '5' AS year, 'N/A' AS Jan_sales, '1' AS Feb_sales, 'it''s' AS region")
    row = typed_wide(df, ["store_id", "year", "region"], {"Jan_sales": "Jan", "Feb_sales": "Feb"}).head()
    assert (row.store_id, row.year, row.Jan_sales, row.region) == (None, 5, None, "it's")
    assert row.unparsed == {"store_id": "x", "Jan": "N/A"}
    clean = spark.sql("SELECT '1' AS store_id, NULL AS Jan_sales")
    assert typed_wide(clean, ["store_id"], {"Jan_sales": "Jan"}).head().unparsed is None


def test_table_reads(spark, tmp_path):
    assert read_or_empty(spark, str(tmp_path / "absent"), CURATED).count() == 0
    spark.range(3).createOrReplaceTempView("three_rows")
    assert read_table(spark, "three_rows").count() == 3


def test_dynamic_overwrite_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.sql("SELECT id AS v, 2025 AS year, IF(id < 5, 'Jan', 'Feb') AS month FROM range(10)")
    writers.write_curated(df, path, mode="overwrite")
    writers.write_curated(df.where("month = 'Jan'").withColumn("v", F.lit(0)), path, "overwrite", dynamic=True)
    got = {row.month: row.total for row in read_table(spark, path).groupBy("month").agg(F.sum("v").alias("total")).collect()}
    assert got == {"Jan": 0, "Feb": 35}
    writers.write_curated(df.where("month = 'Jan'"), path, mode="overwrite")
    assert read_table(spark, path).count() == 5
