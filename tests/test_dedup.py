import random
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from monthfold.operators.dedup import dedup, dedup_wide, removed_count
from monthfold.operators.validate import PROFILES, split
from monthfold.plans.normalize import DETERMINED, long_rows, normalize


def long(spark, rows):
    return spark.createDataFrame(
        [(k, m, f, None if a is None else Decimal(a)) for k, m, f, a in rows],
        "k string, month string, source_file string, sales_amount decimal(18,2)",
    )


def test_one_row_per_key_and_largest_amount_wins(spark):
    df = long(spark, [("a", "Jan", "f", 1), ("a", "Jan", "f", 3), ("a", "Jan", "f", None), ("a", "Feb", "f", 2)])
    assert sorted(map(tuple, dedup(df, ["k", "month"]).collect())) == [
        ("a", "Feb", "f", Decimal("2.00")),
        ("a", "Jan", "f", Decimal("3.00")),
    ]


def test_null_keys_and_null_amounts_form_groups(spark):
    df = long(spark, [(None, "Jan", "f", None), (None, "Jan", "f", None)])
    assert [tuple(r) for r in dedup(df, ["k", "month"]).collect()] == [(None, "Jan", "f", None)]


def test_scope(spark):
    df = long(spark, [("a", "Jan", "f", 1), ("a", "Jan", "g", 2), ("a", "Jan", "g", 2)])
    assert dedup(df, ["k", "month"]).count() == 2
    assert [tuple(r) for r in dedup(df, ["k", "month"], "global").collect()] == [("a", "Jan", "g", Decimal("2.00"))]
    with pytest.raises(ValueError):
        dedup(df, ["k"], "everywhere")


def test_counts(spark):
    df = long(spark, [("a", "Jan", "f", 1)] * 3 + [("b", "Jan", "f", 1)])
    assert tuple(removed_count(df, ["k", "month"]).head()) == (4, 2, 2)
    assert tuple(removed_count(df.where("false"), ["k", "month"]).head()) == (0, 0, 0)
    copies = {r.k: r.n for r in dedup(df, ["k", "month"], copies="n").collect()}
    assert copies == {"a": 3, "b": 1}


def test_order_and_partitioning_do_not_matter(spark):
    rng = random.Random(5)
    rows = [(f"k{rng.randrange(9)}", "Jan", f"f{rng.randrange(3)}", rng.choice([None, 1, 2, 3])) for _ in range(300)]
    results = set()
    for parts in (1, 3, 16):
        rng.shuffle(rows)
        for scope in ("file", "global"):
            got = dedup(long(spark, rows).repartition(parts), ["k", "month"], scope).collect()
            results.add((scope, tuple(sorted(map(repr, got)))))
    assert len(results) == 2


def test_wide_form_needs_distinct_labels(spark):
    df = spark.sql("SELECT 1 AS Jan, 2 AS x")
    with pytest.raises(ValueError, match="collide"):
        dedup_wide(df, ["Jan"], {"Jan": (F.col("x"), F.lit(True))})


def random_wide(spark, seed, measures):
    rng = random.Random(seed)
    texts = ["", "N/A", "-4", "7", "8.25", "300000", "1e3", "NaN"]
    rows = []
    for _ in range(400):
        key = rng.randrange(6)
        rows.append(
            (
                rng.choice([str(key), "x", ""]), f"n{key}", "1", rng.choice(["TX", ""]), "5", "S", "2025",
                rng.choice(["west", ""]), rng.choice(["a.csv", "b.csv"]), *[rng.choice(texts) for _ in measures],
            )
        )
    names = (
        "salesperson_id salesperson_name sales_state_id sales_state_name store_id store_name year region source_file"
    ).split()
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in [*names, *measures]))
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in df.columns])


@pytest.mark.parametrize("seed", range(3))
def test_folding_wide_rows_equals_folding_cells(spark, seed):
    """The production path (before the unpivot) against the plain one (after it)."""
    measures = ["Jan_sales", "Feb_sales", "Foo_sales"]
    df = random_wide(spark, seed, measures)
    profile = replace(PROFILES["strict_ids"], max_amount=Decimal(200_000))
    wide_path = normalize(df, profile).drop("load_timestamp")
    cells = split(long_rows(df, profile))[0].drop("unparsed", "sales_raw")
    keys = [c for c in df.columns if c not in measures]
    long_path = dedup(cells, [*keys, "month"], determined=DETERMINED).select(*wide_path.columns)
    assert sorted(map(repr, wide_path.collect())) == sorted(map(repr, long_path.collect()))


def test_more_measures_than_bits(spark):
    labels = [f"L{a}{b}" for a in "abcdefghi" for b in "abcdefghi"]
    cells = ", ".join(f"CAST(IF(id = 1, NULL, {n}) AS decimal(18,2)) AS m{n}" for n in range(len(labels)))
    df = spark.sql(f"SELECT id % 2 AS k, {cells} FROM range(4)")
    odd = {label: (F.col(f"m{n}"), F.lit(n % 2 == 1)) for n, label in enumerate(labels)}
    got = dedup_wide(df, ["k"], odd)
    assert got.count() == 2 * (len(labels) // 2)
    assert {r.month for r in got.select("month").collect()} == {label for n, label in enumerate(labels) if n % 2}
