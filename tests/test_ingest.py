import gzip
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_sources import put

from monthfold.config import ConfigError
from monthfold.plans import ingest
from monthfold.streaming.available_now import run_available_now

IDS = "salesperson_id,salesperson_name,sales_state_id,sales_state_name,store_id,store_name,year"
ANN, BOB = "1,Ann,1,TX,5,S5,2025", "2,Bob,1,TX,6,S6,2025"


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "in"
    put(folder, "sales_q1.csv", f"{IDS},Jan_sales,Feb_sales,Mar_sales\n{ANN},10,20.5,\n{ANN},11,20.5,\n{BOB},N/A,-1,3\n")
    put(folder, "sales_q2.csv", f"year,store_id,{IDS.replace(',store_id', '').replace(',year', '')},Apr_sales\n2025,5,1,Ann,1,TX,S5,7\n")
    return folder


def cells(spark, cfg, **kw):
    rows = ingest.read_curated(spark, cfg, **kw).select("source_file", "salesperson_id", "month", "sales_amount")
    return sorted((r.source_file, r.salesperson_id, r.month, None if r.sales_amount is None else str(r.sales_amount)) for r in rows.collect())


Q1 = [
    ("sales_q1.csv", 1, "Feb", "20.50"),
    ("sales_q1.csv", 1, "Jan", "11.00"),
    ("sales_q1.csv", 1, "Mar", None),
    ("sales_q1.csv", 2, "Mar", "3.00"),
]
Q2 = [("sales_q2.csv", 1, "Apr", "7.00")]


def by_name(rows):
    return sorted(rows, key=repr)


def test_first_run(spark, source, cfg_for):
    cfg = cfg_for(source)
    row = ingest.run(spark, cfg).head()
    assert (row.files_discovered, row.files_processed, row.files_skipped, row.errors) == (2, 2, 0, [])
    assert (row.input_records, row.long_records, row.valid_records, row.invalid_records) == (4, 10, 8, 2)
    assert (row.duplicates_removed, row.total_records) == (3, 5)
    assert by_name(cells(spark, cfg)) == by_name(Q1 + Q2)
    rejects = {(r.month, r.sales_raw, tuple(r.reject_reasons)) for r in ingest.read_quarantine(spark, cfg).collect()}
    assert rejects == {("Jan", "N/A", ("unparseable_amount",)), ("Feb", None, ("negative_amount",))}


def test_second_run_writes_nothing(spark, source, cfg_for):
    cfg = cfg_for(source)
    ingest.run(spark, cfg)
    row = ingest.run(spark, cfg).head()
    assert (row.files_processed, row.files_skipped, row.total_records) == (0, 2, 0)
    assert by_name(cells(spark, cfg, committed=False)) == by_name(Q1 + Q2)
    assert ingest.read_run_metrics(spark, cfg).count() == 2
    assert ingest.read_drift(spark, cfg).count() == 2


def test_new_and_rewritten_files(spark, source, cfg_for):
    cfg = cfg_for(source)
    ingest.run(spark, cfg)
    put(source, "sales_q2.csv", f"{IDS},Apr_sales\n{ANN},70\n{BOB},80\n")
    put(source, "sales_q3.csv", f"{IDS},Jul_sales\n{BOB},9\n")
    row = ingest.run(spark, cfg).head()
    assert (row.files_processed, row.files_skipped) == (2, 1)
    latest = [("sales_q2.csv", 1, "Apr", "70.00"), ("sales_q2.csv", 2, "Apr", "80.00"), ("sales_q3.csv", 2, "Jul", "9.00")]
    assert by_name(cells(spark, cfg)) == by_name(Q1 + latest)
    assert by_name(cells(spark, cfg, committed=False)) == by_name(Q1 + Q2 + latest)


def test_run_that_stops_before_its_ledger_is_invisible_and_repeated(spark, source, cfg_for, monkeypatch):
    cfg = cfg_for(source)

    def stop(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "_record_state", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            ingest.run(spark, cfg)
    assert cells(spark, cfg) == []
    assert ingest.run(spark, cfg).head().files_processed == 2
    assert by_name(cells(spark, cfg)) == by_name(Q1 + Q2)


def test_bad_files_do_not_stop_the_others_and_are_retried(spark, source, cfg_for):
    cfg = cfg_for(source, file_pattern="sales_*")
    put(source, "sales_dup.csv", f"{IDS},Jan_sales,Jan_sales\n{ANN},1,2\n")
    put(source, "sales_reserved.csv", f"{IDS},month,Jan_sales\n{ANN},May,2\n")
    put(source, "sales_case.csv", f"{IDS},jan_sales,May_sales\n{ANN},1,2\n")
    put(source, "sales_none.csv", f"{IDS}\n{ANN}\n")
    put(source, "sales_empty.csv", "")
    rng = random.Random(1)
    text = f"{IDS},Jan_sales\n" + "".join(f"{n},N{rng.random()},1,TX,5,S,2025,{n}\n" for n in range(20_000))
    with open(os.path.join(str(source), "sales_broken.csv.gz"), "wb") as handle:
        handle.write(gzip.compress(text.encode())[:60_000])
    row = ingest.run(spark, cfg).head()
    assert (row.files_discovered, row.files_processed, row.files_skipped) == (7, 2, 0)
    assert [e.file for e in row.errors] == ["sales_broken.csv.gz", "sales_case.csv", "sales_dup.csv", "sales_reserved.csv"]
    assert by_name(cells(spark, cfg)) == by_name(Q1 + Q2)
    assert ingest.read_drift(spark, cfg).where("event = 'no_measure_columns'").count() == 1
    with open(os.path.join(str(source), "sales_broken.csv.gz"), "wb") as handle:
        handle.write(gzip.compress(f"{IDS},Jan_sales\n{BOB},1\n".encode()))
    again = ingest.run(spark, cfg).head()
    assert (again.files_processed, again.files_skipped, len(again.errors)) == (1, 3, 3)
    assert ("sales_broken.csv.gz", 2, "Jan", "1.00") in cells(spark, cfg)


def test_parts_of_one_file_are_deduplicated_together(spark, tmp_path, cfg_for):
    folder = tmp_path / "in"
    put(folder, "sales_a.csv/part-0.csv", f"{IDS},Jan_sales\n{ANN},1\n")
    put(folder, "sales_a.csv/part-1.csv", f"{IDS},Jan_sales,Feb_sales\n{ANN},4,2\n")
    put(folder, "sales_b.csv", f"{IDS},Jan_sales\n{ANN},9\n")
    cfg = cfg_for(folder)
    ingest.run(spark, cfg)
    a = [("sales_a.csv", 1, "Feb", "2.00"), ("sales_a.csv", 1, "Jan", "4.00")]
    assert cells(spark, cfg) == [*a, ("sales_b.csv", 1, "Jan", "9.00")]
    wide = cfg_for(folder, dedup_scope="global", curated=str(tmp_path / "g"), checkpoints=str(tmp_path / "gc"))
    ingest.run(spark, wide)
    assert cells(spark, wide) == [("sales_a.csv", 1, "Feb", "2.00"), ("sales_b.csv", 1, "Jan", "9.00")]


def test_columns_that_only_some_files_have(spark, tmp_path, cfg_for):
    folder = tmp_path / "in"
    put(folder, "sales_a.csv", f"{IDS},region,Jan_sales\n{ANN},west,1\n{ANN},east,2\n")
    put(folder, "sales_b.csv", "salesperson_id,year,Foo_sales\n3,2025,4\n,2025,5\n")
    cfg = cfg_for(folder)
    row = ingest.run(spark, cfg).head()
    assert (row.valid_records, row.invalid_records, row.total_records) == (3, 1, 3)
    got = ingest.read_curated(spark, cfg, extra=("region",)).orderBy("sales_amount").collect()
    assert [(r.region, r.month, r.month_number, r.quarter, r.store_id) for r in got] == [
        ("west", "Jan", 1, 1, 5), ("east", "Jan", 1, 1, 5), (None, "Foo", 0, 0, None)
    ]


@pytest.mark.parametrize(
    "profile, valid, invalid, written",
    [("strict_ids", 8, 2, 5), ("notebook", 6, 4, 6), ("core_keys", 6, 4, 6), ("sql_insert", 7, 1, 7)],
)
def test_profiles(spark, source, cfg_for, profile, valid, invalid, written):
    cfg = cfg_for(source, profile=profile)
    row = ingest.run(spark, cfg).head()
    assert (row.valid_records, row.invalid_records, row.total_records) == (valid, invalid, written)
    assert ingest.read_curated(spark, cfg).count() == written


def test_switches(spark, source, cfg_for, tmp_path):
    loose = cfg_for(source, enable_validation=False, enable_deduplication=False, enable_schema_registry=False)
    row = ingest.run(spark, loose).head()
    assert (row.valid_records, row.invalid_records, row.total_records) == (10, 0, 10)
    assert ingest.read_registry(spark, loose).count() == 0
    with pytest.raises(ConfigError):
        ingest.run(spark, cfg_for(source, enable_incremental=False))


def test_full_refresh(spark, source, cfg_for):
    cfg = cfg_for(source)
    ingest.run(spark, cfg)
    os.replace(source / "sales_q2.csv", source / "other.csv")
    ingest.run(spark, cfg_for(source, refresh="touched_partitions"), incremental=False)
    assert by_name(cells(spark, cfg, committed=False)) == by_name(Q1 + Q2)
    ingest.run(spark, cfg, incremental=False)
    assert by_name(cells(spark, cfg, committed=False)) == by_name(Q1)


def test_nothing_to_do(spark, tmp_path, cfg_for):
    cfg = cfg_for(tmp_path / "absent")
    row = ingest.run(spark, cfg).head()
    assert (row.files_discovered, row.total_records) == (0, 0)
    assert cells(spark, cfg) == []


def test_header_only_file(spark, tmp_path, cfg_for):
    put(tmp_path / "in", "sales_a.csv", f"{IDS},Jan_sales\n")
    cfg = cfg_for(tmp_path / "in")
    row = ingest.run(spark, cfg, incremental=False).head()
    assert (row.files_processed, row.input_records, row.total_records) == (1, 0, 0)


def test_published_row_law(spark, tmp_path, cfg_for):
    """Files of 3, 7 and 12 months give their rows times their months."""
    from monthfold.functions.months import MONTHS

    for months in (3, 7, 12):
        head = ",".join([IDS, *[f"{m}_sales" for m in MONTHS[:months]]])
        body = "".join(f"{n},N,1,TX,5,S,2025" + f",{n}.5" * months + "\n" for n in range(200))
        put(tmp_path / "in", f"sales_{months}.csv", f"{head}\n{body}")
    cfg = cfg_for(tmp_path / "in")
    assert ingest.run(spark, cfg).head().total_records == 200 * 22
    total = ingest.read_curated(spark, cfg).agg(F.sum("sales_amount")).head()[0]
    assert total == sum(Decimal(n) + Decimal("0.5") for n in range(200)) * 22
    summary = ingest.write_summary(spark, cfg).head()
    assert (summary.total_records, summary.files_processed, len(summary.months_covered)) == (4400, 3, 12)


def test_stream_takes_up_what_arrived(spark, source, cfg_for, tmp_path):
    cfg, checkpoint = cfg_for(source), str(tmp_path / "stream")
    run_available_now(spark, cfg, checkpoint).awaitTermination()
    assert by_name(cells(spark, cfg)) == by_name(Q1 + Q2)
    run_available_now(spark, cfg, checkpoint).awaitTermination()
    assert ingest.read_run_metrics(spark, cfg).count() == 1
    put(source, "sales_q3.csv", f"{IDS},Jul_sales\n{BOB},9\n")
    run_available_now(spark, cfg, checkpoint, max_files_per_trigger=1).awaitTermination()
    assert by_name(cells(spark, cfg, committed=False)) == by_name([*Q1, *Q2, ("sales_q3.csv", 2, "Jul", "9.00")])


def test_stream_batch_that_is_repeated_adds_nothing(spark, source, cfg_for, tmp_path):
    cfg = cfg_for(source)
    run_available_now(spark, cfg, str(tmp_path / "one")).awaitTermination()
    run_available_now(spark, cfg, str(tmp_path / "two")).awaitTermination()
    assert by_name(cells(spark, cfg, committed=False)) == by_name(Q1 + Q2)


def test_rows_that_do_not_fit_their_header_are_rejects(spark, tmp_path, cfg_for):
    put(tmp_path / "in", "sales_a.csv", f"\n{IDS},Jan_sales\n{ANN},2,99,98\n{BOB},3,\n1.0,Ann,1.,TX,5.00,S5,2025,4\n1.5,Ann,1,TX,5,S5,2025,4\n")
    cfg = cfg_for(tmp_path / "in")
    row = ingest.run(spark, cfg).head()
    assert (row.input_records, row.valid_records, row.invalid_records, row.errors) == (4, 2, 2, [])
    assert cells(spark, cfg) == [("sales_a.csv", 1, "Jan", "4.00"), ("sales_a.csv", 2, "Jan", "3.00")]
    rejects = {(tuple(r.reject_reasons), tuple(r.unparsed.values())) for r in ingest.read_quarantine(spark, cfg).collect()}
    assert rejects == {(("row_beyond_header",), ("99",)), (("null_salesperson_id", "unparseable_identifier"), ("1.5",))}


def test_odd_headers_are_errors_of_their_files(spark, source, cfg_for):
    put(source, "sales_month.csv", f"{IDS},Jan,Jan_sales\n{ANN},x,2\n")
    put(source, "sales_label.csv", f"{IDS},apr,May_sales\n{ANN},x,2\n")
    put(source, "sales_cell.csv", f"{IDS},cell,Jan_sales\n{ANN},x,2\n")
    put(source, "sales_inner.csv", f"{IDS},__bits_0,Jan_sales\n{ANN},x,2\n")
    put(source, "sales_case.csv", f"{IDS.replace('salesperson_id', 'Salesperson_ID')},Jan_sales\n{ANN},2\n")
    put(source, "sales_parts.csv/part-0.csv", f"{IDS},Jan_sales\n{ANN},2\n")
    put(source, "sales_parts.csv/part-1.csv", f"{BOB},3\n{BOB},3\n")
    cfg = cfg_for(source)
    for _ in range(2):
        row = ingest.run(spark, cfg).head()
        assert {e.file for e in row.errors} == {f"sales_{n}.csv" for n in ("month", "label", "cell", "inner", "case", "parts")}
        assert by_name(cells(spark, cfg)) == by_name(Q1 + Q2)
    assert row.files_processed == 0


@pytest.mark.parametrize("step", ["_write_long", "write_quarantine", "_record_state"])
def test_full_refresh_that_stops_leaves_the_former_rows(spark, source, cfg_for, monkeypatch, step):
    cfg = cfg_for(source)
    ingest.run(spark, cfg)
    rejects = ingest.read_quarantine(spark, cfg).count()
    put(source, "sales_q2.csv", f"{IDS},Apr_sales\n{ANN},70\n{BOB},-80\n")
    os.remove(source / "sales_q1.csv")
    real = getattr(ingest, step)

    def stop(*args, **kw):
        if step != "_record_state":
            real(*args, **kw)
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, step, stop)
        with pytest.raises(RuntimeError, match="stopped"):
            ingest.run(spark, cfg, incremental=False)
    assert by_name(cells(spark, cfg)) == by_name(Q1 + Q2) and ingest.read_quarantine(spark, cfg).count() == rejects
    ingest.run(spark, cfg, incremental=False)
    latest = [("sales_q2.csv", 1, "Apr", "70.00")]
    assert cells(spark, cfg) == latest == cells(spark, cfg, committed=False)
    assert [r.sales_amount for r in ingest.read_quarantine(spark, cfg).collect()] == [Decimal("-80.00")]


def test_refresh_without_files_leaves_nothing(spark, source, cfg_for):
    cfg = cfg_for(source)
    ingest.run(spark, cfg)
    for name in ("sales_q1.csv", "sales_q2.csv"):
        os.remove(source / name)
    ingest.run(spark, cfg, incremental=False)
    assert cells(spark, cfg) == [] == cells(spark, cfg, committed=False)


def test_global_scope_brings_back_what_a_rewritten_file_outdid(spark, tmp_path, cfg_for):
    folder = tmp_path / "in"
    put(folder, "sales_a.csv", f"{IDS},Jan_sales\n{ANN},9\n")
    put(folder, "sales_b.csv", f"{IDS},Jan_sales\n{ANN},5\n")
    cfg = cfg_for(folder, dedup_scope="global")
    ingest.run(spark, cfg)
    assert cells(spark, cfg) == [("sales_a.csv", 1, "Jan", "9.00")]
    put(folder, "sales_a.csv", f"{IDS},Jan_sales\n{BOB},1\n")
    ingest.run(spark, cfg)
    assert cells(spark, cfg) == [("sales_a.csv", 2, "Jan", "1.00"), ("sales_b.csv", 1, "Jan", "5.00")]


def test_global_scope_tells_further_identifiers_apart(spark, tmp_path, cfg_for):
    folder = tmp_path / "in"
    put(folder, "sales_a.csv", f"{IDS},region,Jan_sales\n{ANN},west,9\n")
    put(folder, "sales_b.csv", f"{IDS},region,Jan_sales\n{ANN},east,5\n{ANN},west,5\n")
    cfg = cfg_for(folder, dedup_scope="global", enable_schema_registry=False)
    assert ingest.read_curated(spark, cfg).collect() == []
    ingest.run(spark, cfg)
    assert cells(spark, cfg) == [("sales_a.csv", 1, "Jan", "9.00"), ("sales_b.csv", 1, "Jan", "5.00")]


def test_no_shuffle_above_the_unpivot(spark, source, cfg_for, monkeypatch):
    plans = []
    real = ingest.write_curated

    def watched(df, *args, **kw):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        real(df, *args, **kw)

    monkeypatch.setattr(ingest, "write_curated", watched)
    ingest.run(spark, cfg_for(source))
    (plan,) = plans
    assert plan.index("Expand") < plan.index("RebalancePartitions")


def test_stream_takes_up_a_rewritten_file(spark, source, cfg_for, tmp_path):
    cfg, checkpoint = cfg_for(source), str(tmp_path / "stream")
    run_available_now(spark, cfg, checkpoint).awaitTermination()
    put(source, "sales_q2.csv", f"{IDS},Apr_sales\n{BOB},80.25\n")
    put(source, "_hidden.csv", "x\n")
    run_available_now(spark, cfg, checkpoint, max_files_per_trigger=1).awaitTermination()
    assert by_name(cells(spark, cfg)) == by_name([*Q1, ("sales_q2.csv", 2, "Apr", "80.25")])


def test_stream_lists_what_a_spark_listing_gives(spark, tmp_path):
    from monthfold.sources.discovery import list_files
    from monthfold.streaming.arrivals import listed

    for name in ("sales_a b.csv", "sales_dir.csv/part-0.csv", "sales_dir.csv/_SUCCESS", ".sales_h.csv", "other.csv", "sales_{x}.csv"):
        put(tmp_path, name, "a\n1\n")
    put(tmp_path, "sales_zero.csv", "")
    for pattern in ("sales_*.csv", "sales_{a,d}*", "sales_[ad]*.csv", "sales_?i*"):
        rows = list_files(spark, str(tmp_path), pattern).select("path", "source_file", "length", F.unix_millis("modification_time")).collect()
        mine = [(p, n, size, round(t.timestamp() * 1000)) for p, n, size, t in listed(str(tmp_path), pattern)]
        assert sorted(map(tuple, rows)) == mine
    assert listed(str(tmp_path / "absent"), "*") == []


def test_bad_files_of_one_wave_leave_the_others_alone(spark, tmp_path, cfg_for, monkeypatch):
    """Three corrupt files: sound waves are read once, and sound files of a bad wave at most once per halving."""
    folder = tmp_path / "in"
    rng = random.Random(1)
    for n in range(8):
        put(folder, f"sales_{n}.csv", f"{IDS},Jan_sales\n{n},N,1,TX,5,S,2025,{n}\n" + "".join(f"{n},N{i},1,TX,5,S,2025,{n}\n" for i in range(3000)))
    text = f"{IDS},Jan_sales\n" + "".join(f"{n},N{rng.random()},1,TX,5,S,2025,{n}\n" for n in range(20_000))
    for n in (2, 3, 5):
        with open(folder / f"sales_{n}_bad.csv.gz", "wb") as handle:
            handle.write(gzip.compress(text.encode())[:90_000])
    scans = []
    real = ingest.read_wide
    monkeypatch.setattr(ingest, "read_wide", lambda spark, shape, source: scans.append(shape.paths) or real(spark, shape, source))
    row = ingest.run(spark, cfg_for(folder, file_pattern="sales_*"), wave_bytes=70_000).head()
    assert (row.files_processed, sorted(e.file for e in row.errors)) == (8, [f"sales_{n}_bad.csv.gz" for n in (2, 3, 5)])
    read = [os.path.basename(p) for paths in scans for p in paths]
    assert {name: read.count(name) for name in set(read)} == {name: 1 for name in set(read)}
    assert row.input_records == 8 * 3001


def test_headers_are_one_job(spark, tmp_path):
    from monthfold.sources.discovery import headers, list_files

    for n in range(60):
        put(tmp_path, f"sales_{n}.csv", f"a,b{n % 3}\n1,2\n")
    files = spark.createDataFrame(list_files(spark, str(tmp_path)).collect(), "path string, source_file string, length long, modification_time timestamp")
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    headers(files).write.format("noop").mode("overwrite").save()
    assert len(set(tracker.getJobIdsForGroup(None)) - before) <= 2  # the dealing of paths and the reading


def test_reads_have_no_join_and_prune_partitions(spark, source, cfg_for):
    cfg = cfg_for(source)
    ingest.run(spark, cfg)
    put(source, "sales_q2.csv", f"{IDS},Apr_sales\n{ANN},70\n")
    ingest.run(spark, cfg)
    rows = ingest.read_curated(spark, cfg).where("year = 2025 and month = 'Apr'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and "Exchange" not in plan
    assert "PartitionFilters: [isnotnull(year" in plan and "month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert [(r.source_file, str(r.sales_amount)) for r in rows.collect()] == [("sales_q2.csv", "70.00")]


def test_many_replaced_files_are_written_anew(spark, source, cfg_for, monkeypatch):
    """Beyond the bound of hidden pairs, folders are rewritten; later runs still find what was moved."""
    from monthfold.state import manifest

    monkeypatch.setattr(manifest, "MOST_HIDDEN", 0)
    cfg = cfg_for(source)
    ingest.run(spark, cfg)
    for amount in ("70", "71"):
        put(source, "sales_q2.csv", f"{IDS},Apr_sales\n{ANN},{amount}\n")
        ingest.run(spark, cfg)
        assert by_name(cells(spark, cfg)) == by_name([*Q1, ("sales_q2.csv", 1, "Apr", f"{amount}.00")])
        assert ingest.snapshot(spark, cfg).hidden == ()
    put(source, "sales_q1.csv", f"{IDS},Jan_sales\n{ANN},1\n")
    ingest.run(spark, cfg)
    assert cells(spark, cfg) == [("sales_q1.csv", 1, "Jan", "1.00"), ("sales_q2.csv", 1, "Apr", "71.00")]
    assert ingest.remove_superseded(spark, cfg) > 0
    assert cells(spark, cfg, committed=False) == cells(spark, cfg)


def test_surrogate_keys_are_unique_over_runs(spark, source, cfg_for):
    cfg = cfg_for(source)
    ingest.run(spark, cfg)
    first = {r.record_id for r in ingest.read_curated(spark, cfg, record_ids=True).collect()}
    put(source, "sales_q3.csv", f"{IDS},Jul_sales\n{BOB},9\n")
    ingest.run(spark, cfg)
    ids = [r.record_id for r in ingest.read_curated(spark, cfg, record_ids=True).collect()]
    assert len(ids) == len(set(ids)) == 6 and first < set(ids) and min(ids) >= 1
    assert min(set(ids) - first) > max(first)


def test_global_scope_reads_without_an_aggregate(spark, tmp_path, cfg_for):
    folder = tmp_path / "in"
    put(folder, "sales_a.csv", f"{IDS},Jan_sales,Feb_sales\n{ANN},9,1\n")
    put(folder, "sales_b.csv", f"{IDS},Jan_sales,Mar_sales\n{ANN},5,2\n")
    cfg = cfg_for(folder, dedup_scope="global")
    ingest.run(spark, cfg)
    put(folder, "sales_c.csv", f"{IDS},Mar_sales\n{ANN},7\n")
    ingest.run(spark, cfg)
    plan = ingest.read_curated(spark, cfg)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
    assert cells(spark, cfg) == [("sales_a.csv", 1, "Feb", "1.00"), ("sales_a.csv", 1, "Jan", "9.00"), ("sales_c.csv", 1, "Mar", "7.00")]


def test_spark_options_hold_for_the_run(spark, source, cfg_for, monkeypatch):
    seen = []
    real = ingest.write_curated

    def watched(df, *args, **kw):
        seen.append(spark.conf.get("spark.sql.shuffle.partitions"))
        real(df, *args, **kw)

    monkeypatch.setattr(ingest, "write_curated", watched)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    ingest.run(spark, cfg_for(source, spark_options={"spark.sql.shuffle.partitions": "3"}))
    assert seen == ["3"] and spark.conf.get("spark.sql.shuffle.partitions") == before
