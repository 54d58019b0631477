import random
from decimal import Decimal

import pytest
from test_ingest import ANN, BOB, IDS
from test_sources import put

from monthfold.config import ConfigError
from monthfold.operators import reports, summaries
from monthfold.plans import ingest

REPORTS = ("sales_by_quarter", "sales_by_state", "summary_stats", "summary_months_list")
LONG = "salesperson_id int, sales_state_id int, sales_state_name string, store_id int, year int, quarter int, month string, sales_amount decimal(18,2)"


def rows_of(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


def agree(summary, long):
    for name in REPORTS:
        got, want = getattr(summaries, name)(summary), getattr(reports, name)(long)
        assert rows_of(got) == rows_of(want), name


@pytest.fixture
def long(spark):
    rng = random.Random(3)
    ids = [None, 0, -1, -64, -65, 63, 64, 2**31 - 1, -(2**31), *range(100, 300)]
    rows = []
    for _ in range(2000):
        month = rng.randrange(12)
        amount = None if rng.random() < 0.1 else Decimal(rng.randrange(-5000, 10**9)) / 100
        state = rng.choice([None, 1, 2, -3])
        rows.append((rng.choice(ids), state, f"s{state}", rng.choice(ids), rng.choice([None, 2024, 2025]), month // 3 + 1, f"m{month}", amount))
    return spark.createDataFrame(rows, LONG)


def test_reports_equal_those_over_rows(long):
    """Null, negative and extreme ids, null groups, null amounts."""
    agree(summaries.summarize(long), long)


def test_summaries_of_disjoint_rows_merge(long):
    parts = [long.where(f"coalesce(salesperson_id, 0) % 3 = {k}") for k in (-2, -1, 0, 1, 2)]
    merged = summaries.summarize(parts[0])
    for part in parts[1:]:
        merged = merged.unionAll(summaries.summarize(part))
    agree(merged, long)
    # A second time: ids are counted once, amounts twice.
    twice = summaries.summary_stats(merged.unionAll(merged)).head()
    once = summaries.summary_stats(merged).head()
    assert twice.unique_stores == once.unique_stores and twice.total_records == 2 * once.total_records


def test_no_rows(long):
    agree(summaries.summarize(long.limit(0)), long.limit(0))


def test_only_hash_aggregates(long):
    for df in (summaries.summarize(long), summaries.sales_by_quarter(summaries.summarize(long))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "Expand" not in plan


@pytest.mark.parametrize("scope", ["file", "global"])
def test_runs_keep_summaries(spark, tmp_path, cfg_for, scope):
    folder = tmp_path / "in"
    put(folder, "sales_a.csv", f"{IDS},Jan_sales,Feb_sales\n{ANN},10,20\n{BOB},30,40\n")
    cfg = cfg_for(folder, dedup_scope=scope)
    ingest.run(spark, cfg)
    with pytest.raises(ConfigError):
        ingest.read_summaries(spark, cfg)
    keeping = cfg_for(folder, dedup_scope=scope, keep_summaries=True)
    put(folder, "sales_b.csv", f"{IDS},Feb_sales,Mar_sales\n{ANN},25,5\n")
    # The first run that keeps them summarises what was there before, too.
    ingest.run(spark, keeping)
    agree(ingest.read_summaries(spark, cfg), ingest.read_curated(spark, cfg))
    # Once there, every run keeps them: a rewritten file, and one that goes.
    put(folder, "sales_a.csv", f"{IDS},Jan_sales\n{ANN},11\n")
    ingest.run(spark, cfg)
    agree(ingest.read_summaries(spark, cfg), ingest.read_curated(spark, cfg))
    (folder / "sales_b.csv").unlink()
    ingest.run(spark, cfg, incremental=False)
    agree(ingest.read_summaries(spark, cfg), ingest.read_curated(spark, cfg))
    assert reports.record_count(ingest.read_curated(spark, cfg)).head()[0] == 1


def test_only_touched_partitions_are_summarised(spark, tmp_path, cfg_for):
    folder = tmp_path / "in"
    put(folder, "sales_a.csv", f"{IDS},Jan_sales,Feb_sales\n{ANN},10,20\n")
    cfg = cfg_for(folder, keep_summaries=True)
    ingest.run(spark, cfg, run_id="one")
    put(folder, "sales_b.csv", f"{IDS},Feb_sales\n{BOB},25\n")
    ingest.run(spark, cfg, run_id="two")
    live = ingest.snapshot(spark, cfg, ingest.manifest.SUMMARY).folders
    assert sorted((f.place, f.run_id) for f in live) == [("year=2025/month=Feb", "two"), ("year=2025/month=Jan", "one")]
