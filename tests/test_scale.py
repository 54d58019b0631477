"""What keeps the memory and the shuffle of a task from growing with the tables."""

import re
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql.readwriter import DataFrameWriter

from catalog import tables
from monthfold.sinks import settings, writers

WRITERS, SPLITS = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def seen(spark, monkeypatch):
    """The settings under which frames are saved."""
    found, save = [], DataFrameWriter.save

    def recorded(self, *args, **kwargs):
        found.append((spark.conf.get(WRITERS), spark.conf.get(SPLITS)))
        return save(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "save", recorded)
    return found


def test_partitioned_writes_keep_files_open_instead_of_sorting(spark, tmp_path, seen):
    before = spark.conf.get(WRITERS)
    rows = spark.range(40).selectExpr("id", "cast(id % 4 as int) AS year", "cast(id % 3 as string) AS month")
    writers.write_curated(rows, str(tmp_path / "rows"))
    assert seen[0][0] == str(settings.OPEN_FILES)
    assert spark.conf.get(WRITERS) == before
    back = spark.read.parquet(str(tmp_path / "rows")).selectExpr("id", "year", "cast(month as string)")
    assert sorted(back.collect()) == sorted(rows.collect())


def test_a_session_that_sets_open_files_keeps_its_number(spark, tmp_path, seen):
    with settings.session_options(spark, {WRITERS: "7"}):
        writers.write_curated(spark.range(5).selectExpr("id", "1 AS year", "'Jan' AS month"), str(tmp_path / "rows"))
    assert seen[0][0] == "7"


@pytest.mark.parametrize(("given", "held"), [("128m", f"{16 << 20}b"), ("134217728b", f"{16 << 20}b"), ("1MB", "1MB"), ("4096", "4096")])
def test_small_splits_only_lower_the_setting(spark, given, held):
    with settings.session_options(spark, {SPLITS: given}):
        with settings.small_splits(spark):
            assert spark.conf.get(SPLITS) == held
        assert spark.conf.get(SPLITS) == given


def test_lines_are_dealt_by_group_before_they_are_summed(spark, tmp_path):
    def table(name, **columns):
        pq.write_table(pa.table(columns), tmp_path / f"{name}.parquet")

    from datetime import date

    table("lineitem", l_suppkey=[1, 1, 1, None], l_partkey=[1, 1, 2, 1], l_shipdate=[date(1998, 1, 5), date(1998, 1, 9), date(1998, 2, 1), date(1998, 2, 1)], l_extendedprice=[1.5, 2.0, 4.0, 8.0], l_returnflag=["A", "R", None, "A"])
    table("part", p_partkey=[1, 2], p_brand=["Brand#13", "Brand#21"])
    table("supplier", s_suppkey=[1], s_nationkey=[3], s_name=["S"])
    table("nation", n_nationkey=[3], n_name=["N"])
    wide = tables.wide(spark, str(tmp_path))
    got = {(r.store_name, r.store_id, r.year, r.Jan_sales, r.Feb_sales) for r in wide.collect()}
    assert {(a, b, c, d and float(d), e and float(e)) for a, b, c, d, e in got} == {("Brand#13", None, 1998, -0.5, None), ("Brand#21", 21, 1998, None, 4.0)}
    with settings.session_options(spark, {"spark.sql.adaptive.enabled": "false"}):
        plan = tables.wide(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    # The exchange by group lies below both halves of the aggregate.
    first = next(i for i, line in enumerate(plan.splitlines()) if re.search(r"Exchange hashpartitioning\(l_suppkey", line))
    assert all(i < first for i, line in enumerate(plan.splitlines()) if "HashAggregate" in line)


def test_unique_rows_are_dealt_once_and_equal_keys_meet_in_any_number_of_buckets(spark, tmp_path, cfg_for, monkeypatch):
    from monthfold.plans import ingest

    source = tmp_path / "in"
    source.mkdir()
    head = "salesperson_id,salesperson_name,sales_state_id,sales_state_name,store_id,store_name,year,Jan_sales,Feb_sales\n"
    for number, name in enumerate(("a", "b")):
        rows = [f"{i},S{i},1,N,{i % 3},Store,2024,{i + number},{i - number}\n" for i in range(1, 30)]
        (source / f"sales_{name}.csv").write_text(head + "".join(rows))
    cfg = cfg_for(source, dedup_scope="global")
    monkeypatch.setattr(ingest, "FOLD_BYTES", 300)
    plans, write = [], ingest.write_curated

    def recorded(df, path, **options):
        if path.endswith("sales_unique"):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            assert options["dealt"] and int(spark.conf.get("spark.sql.shuffle.partitions")) > 8
        write(df, path, **options)

    monkeypatch.setattr(ingest, "write_curated", recorded)
    ingest.run(spark, cfg)
    got = ingest.read_curated(spark, cfg).select("salesperson_id", "month", "sales_amount").collect()
    assert sorted((r[0], r[1], int(r[2])) for r in got) == sorted((i, m, i + d) for i in range(1, 30) for m, d in (("Jan", 1), ("Feb", 0)))
    assert len(plans) == 1 and plans[0].count("Exchange") == 1


def test_folded_rows_are_sorted_before_the_unpivot(spark):
    from pyspark.sql import functions as F

    from monthfold.operators.dedup import dedup_wide

    rows = spark.range(50).selectExpr("cast(id as int) AS seller", "2024 AS year", "id * 2.0 AS a")
    long = dedup_wide(rows, ["seller", "year"], {"Jan": (F.col("a"), F.lit(True))}, spread=["year"])
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Sort [") < plan.index("REBALANCE")


def test_rejects_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    plans, write = [], writers.write_curated
    monkeypatch.setattr(writers, "write_curated", lambda df, path, **options: (plans.append(options.get("dealt")), write(df, path, **options)))
    writers.write_quarantine(spark.range(4).selectExpr("id", "'r' AS run_id"), str(tmp_path / "rejects"))
    assert plans == [True] and spark.read.parquet(str(tmp_path / "rejects")).count() == 4


@pytest.fixture
def sample(tmp_path):
    """A folder with the sample tables that the wide table is derived from."""
    from datetime import date

    folder = tmp_path / "sample"
    folder.mkdir()
    tables_of = {
        "lineitem": {
            "l_suppkey": [1, 1, 2, 2, 1],
            "l_partkey": [1, 2, 1, 2, 2],
            "l_shipdate": [date(1995, 1, 5), date(1998, 1, 9), date(1999, 9, 1), date(2001, 12, 1), date(1996, 3, 1)],
            "l_extendedprice": [1.5, 2.0, 4.0, 8.0, 16.0],
            "l_returnflag": ["A", "R", None, "A", "N"],
        },
        "part": {"p_partkey": [1, 2], "p_brand": ["Brand#13", "Brand#21"]},
        "supplier": {"s_suppkey": [1, 2], "s_nationkey": [3, 3], "s_name": ["S", "T"]},
        "nation": {"n_nationkey": [3], "n_name": ["N"]},
    }
    for name, columns in tables_of.items():
        pq.write_table(pa.table(columns), folder / f"{name}.parquet")
    return str(folder)


def test_compressed_exports_are_cut_into_parts_that_hold_all_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "PART_ROWS", 10)
    writers.write_csv(spark.range(35).coalesce(1), str(tmp_path / "out"), compression="gzip")
    names = [p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    assert len(names) == 4 and all(n.endswith(".csv.gz") for n in names)
    back = spark.read.csv(str(tmp_path / "out"), header=True, schema="id long")
    assert sorted(r.id for r in back.collect()) == list(range(35))


def test_export_and_deliveries_are_gzipped_and_read_back_whole(spark, sample, tmp_path, monkeypatch):
    from catalog import queries

    def folder(spark, label):
        return str(tmp_path / label)

    monkeypatch.setattr(queries, "fresh_folder", folder)
    monkeypatch.setattr(tables, "fresh_folder", folder)
    got = queries.QUERIES["csv_export_roundtrip"](spark, sample)
    want = queries.plain(tables.long(spark, sample))
    assert got.schema.names == want.schema.names and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    source = tables.delivered(spark, sample)
    for top in (tmp_path / "export", *(tmp_path / "deliveries").iterdir()):
        assert all(p.name.endswith(".csv.gz") for p in top.iterdir() if p.name.startswith("part-"))
    records = {r.source_file: r.records for r in queries._records_per_file(queries._scan(spark, source)).collect()}
    assert sum(records.values()) == 2 + 1 + 2 + 4


@pytest.mark.parametrize(
    ("name", "columns"), [("surrogate_keys_over_runs", "month, records"), ("sales_by_quarter_from_summaries", "year, quarter, total_sales")]
)
def test_later_files_come_from_the_staged_wide_table(spark, sample, monkeypatch, name, columns):
    from catalog import queries

    calls, wide = [], tables.wide
    monkeypatch.setattr(tables, "wide", lambda *given: (calls.append(given), wide(*given))[1])
    rows = queries.QUERIES[name](spark, sample)
    assert len(calls) == 1 and rows.selectExpr(*columns.split(", ")).count() > 0


def _fold_partitions(frame):
    """Partitions that the lines are dealt into before they are summed."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return int(re.search(r"hashpartitioning\(l_suppkey#\d+L?, store_name#\d+, year#\d+, (\d+)\)", plan)[1])


def test_a_task_folds_no_more_lines_as_the_table_grows(spark, sample, monkeypatch):
    want = tables.wide(spark, sample)
    assert _fold_partitions(want) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A table of 40 portions or more, in a session of 8 partitions.
    monkeypatch.setattr(tables, "FOLD_BYTES", (Path(sample) / "lineitem.parquet").stat().st_size // 40, raising=False)
    got = tables.wide(spark, sample)
    assert _fold_partitions(got) >= 40
    assert got.schema == want.schema and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_the_staged_wide_table_is_joined_in_portions_too(spark, sample, monkeypatch):
    from catalog import queries

    name, seen, write = "spark.sql.shuffle.partitions", [], tables.write_parquet
    before = spark.conf.get(name)
    monkeypatch.setattr(tables, "FOLD_BYTES", (Path(sample) / "lineitem.parquet").stat().st_size // 40, raising=False)
    monkeypatch.setattr(tables, "write_parquet", lambda df, path: (seen.append(int(spark.conf.get(name))), write(df, path))[1])
    got = queries.QUERIES["schema_registry_state"](spark, sample).collect()
    assert len(seen) == 1 and seen[0] >= 40 and spark.conf.get(name) == before
    # Two rows to 1996, one of 1998, one of 1999 in two files, one of 2001 in four.
    assert sum(r.records for r in got) == 2 + 1 + 2 + 4


IDS_OF_KEYS = {
    "sound": [("Jan", i) for i in range(1, 300, 2)] + [("Feb", i) for i in range(2, 300, 2)],
    "word edges": [("Jan", i) for i in (1, 63, 64, 127, 128, 2**40 + 63, 2**62)],
    "twice in a month": [("Jan", 5), ("Jan", 5), ("Jan", 5), ("Jan", 6), ("Feb", 70)],
    "twice in two months": [("Jan", 64), ("Feb", 64), ("Feb", 65), ("Mar", 64)],
    "missing and below 1": [("Jan", None), ("Jan", None), ("Feb", None), ("Feb", 0), ("Mar", -1), ("Mar", -64), ("Mar", 1)],
    "only missing": [("Jan", None)],
    "no month": [(None, 3), (None, 4), ("Jan", 3)],
    "empty": [],
}


@pytest.mark.parametrize("case", IDS_OF_KEYS)
def test_keys_are_counted_as_bits_of_words(spark, case):
    from catalog.queries import _counted_keys

    rows = IDS_OF_KEYS[case]
    got = _counted_keys(spark.createDataFrame(rows, "month string, record_id long")).collect()
    times = {key: sum(k == key for _, k in rows) for _, key in rows}
    bad = sum(n > 1 or key is None or key < 1 for key, n in times.items())
    want = [
        (m, sum(a == m for a, _ in rows), len({k for a, k in rows if a == m and k is not None}), bad) for m in {m for m, _ in rows}
    ]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_keys_are_folded_by_word_before_they_are_shuffled(spark):
    from catalog.queries import _counted_keys

    plan = _counted_keys(spark.range(10).selectExpr("'Jan' AS month", "id AS record_id"))._jdf.queryExecution().executedPlan().toString()
    first = plan[: plan.index("Subquery")] if "Subquery" in plan else plan
    assert "record_id" not in "".join(line for line in first.splitlines() if "Exchange hashpartitioning" in line)
