import numpy as np
import pytest
from comparing import connect, spark_rows, sql_rows

from monthfold.llm import topk
from monthfold.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, score double, ints string"


def brute(ids, rows, query, top):
    score = [(-int(sum(int(a) * int(b) for a, b in zip(r, query[1], strict=True))), i) for i, r in zip(ids, rows, strict=True) if i != query[0]]
    return [(i, -s) for s, i in sorted(score)[:top]]


@pytest.mark.parametrize("seed,n,high", [(0, 700, 30), (1, 400, 2), (2, 10, 5), (3, 500, 3000), (4, 300, 2**29)])
def test_search_against_brute_force(seed, n, high):
    rng = np.random.default_rng(seed)
    ids = np.sort(rng.choice(10 * n, n, replace=False)).astype(np.int64)
    rows = rng.integers(-high, high, (n, 8), dtype=np.int64)
    if seed == 1:
        rows[: n // 2] = rows[0]  # a very common vector
    asked = ids[:: max(1, n // 20)]
    queries = rows[:: max(1, n // 20)]
    i, k, score = topk.search(asked, queries, ids, rows, 5)
    for at, name in enumerate(asked):
        mine = [(int(ids[r]), int(s)) for q, r, s in zip(i, k, score, strict=True) if q == at]
        assert sorted(mine, key=lambda x: (-x[1], x[0])) == brute(ids, rows, (name, queries[at]), 5)


def test_search_stops_early():
    rng = np.random.default_rng(7)
    rows = rng.integers(-3, 4, (4000, 4))
    rows[:40] = rng.integers(200, 260, (40, 4))
    ids = np.arange(4000)
    _, k, _ = topk.search(ids[:10], np.abs(rows[:10]) + 1, ids, rows, 5)
    assert set(k) <= set(range(40))


def test_query_matches_sql(spark):
    assert spark_rows(QUERIES["op6_topk"](spark, SF)) == sql_rows(connect(SF), ORACLE["op6_topk"])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -0.01]), (20, [0.5, 0.5]), (3, [1.0, 0.0]), (4, [1.0, 0.0]), (5, None), (6, [nan, 1.0]), (7, [inf, 0.0]),
            (8, [None, 1.0]), (None, [1.0, 1.0]), (9, []), (40, [1.0])]
    df = spark.createDataFrame([(*r, 0.0, "") for r in rows], SCHEMA)
    got = {}
    for r in topk.search_vectors(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {k: sorted(v) for k, v in got.items()} == {
        0: [(1, 3, 4096), (2, 4, 4096), (3, 40, 4096), (4, 20, 2016), (5, 9, 0)],
        20: [(1, 3, 2048), (2, 4, 2048), (3, 40, 2048), (4, 0, 2016), (5, 9, 0)],
        40: [(1, 0, 4096), (2, 3, 4096), (3, 4, 4096), (4, 20, 2048), (5, 9, 0)],
    }
    assert topk.search_vectors(df.limit(0)).collect() == []


def test_vectors_too_long_for_64_bits_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [1e12, 0.0]), (2, [-1e300, 1e300]), (3, [1e6, 0.0]), (20, [1e7, -1e7])]
    df = spark.createDataFrame([(*r, 0.0, "") for r in rows], SCHEMA)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search_vectors(df).collect())
    assert got == [(0, 1, 3, 64 * 64_000_000), (0, 2, 20, -64 * 640_000_000), (20, 1, 3, 640_000_000 * 64_000_000), (20, 2, 0, -64 * 640_000_000)]
