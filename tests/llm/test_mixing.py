import re
from collections import Counter, defaultdict

import pytest

from monthfold.llm import mixing
from monthfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Targets by sharing again and again what is above a cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed, open_names, total = {}, set(names), sum(sizes.values())
    while open_names:
        left, weights = total - sum(fixed.values()), sum(weight[s] for s in open_names)
        over = [s for s in open_names if left * weight[s] / weights > 3 * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / weights for s in open_names}
        for s in over:
            fixed[s] = 3 * sizes[s]
            open_names.discard(s)
    return fixed


@pytest.mark.parametrize(
    "sizes",
    [{"a": 100, "b": 1000, None: 50}, {"a": 1, "b": 2, "c": 1000, "d": 5, "e": 0}, {"x": 7}, {"é": 10, "z": 10, "A": 10, "a": 10}, {None: 3, "": 9}],
)
def test_targets(spark, sizes):
    got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    assert {r.source: r.target for r in got} == pytest.approx(brute_targets(sizes))


def test_permutations_are_one_to_one(spark):
    for n in (1, 2, 3, 5, 7, 97, 4096, 536870909 % 10_007):
        spots = spark.range(n).select(mixing.permuted(mixing.F.col("id"), mixing.F.lit(n).cast("long"), mixing.F.lit(2)).alias("p"))
        assert sorted(r.p for r in spots.collect()) == list(range(n))


def test_steps_of_permutations_differ_within_and_between_keys(spark):
    def places(key):
        spots = spark.range(4096).select("id", mixing.permuted(mixing.F.col("id"), mixing.F.lit(4096), mixing.F.lit(key)).alias("p"))
        return [r.p for r in sorted(spots.collect())]

    one, two = places(1), places(2)
    for p in (one, two):
        assert len({(b - a) % 4096 for a, b in zip(p, p[1:])}) > 1500
    assert sum(a == b for a, b in zip(one, two)) < 20
    assert len({(b - a) % 4096 for a, b in zip(one, two)}) > 1500


def test_query_meets_targets(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op7_mixing"](spark, SF).collect()
    again = QUERIES["op7_mixing"](spark, SF).collect()
    assert sorted(rows) == sorted(again)
    sizes, taken = Counter(), Counter()
    for i, r in docs.items():
        sizes[r.source] += size(r.text)
    goals = brute_targets(sizes)
    assert len(rows) == len(docs)
    for r in rows:
        source = docs[r.doc_id].source
        assert r["size"] == size(docs[r.doc_id].text) and r.source_size == sizes[source]
        assert r.target == pytest.approx(goals[source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[source] += r.taken
    for source, goal in goals.items():
        assert abs(taken[source] - goal) <= 0.5 + 1e-6


def test_stretches_are_blocks_of_the_stream(spark):
    rows = mixing.stretches(spark.read.parquet(f"{SF}/documents.parquet")).where("words > 0").collect()
    slots = defaultdict(int)
    for r in rows:
        slots[r.source, r.slot] += r.words
        assert 0 <= r["first"] and r["first"] + r.words <= r["size"] and 0 <= r.shard < mixing.SHARDS
    short = Counter(source for (source, _), n in slots.items() if n != mixing.BLOCK_WORDS)
    assert all(n <= 3 for n in short.values())


def test_odd_rows(odd_docs):
    rows = mixing.taken_words(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert Counter(r["size"] for r in rows) == Counter(size(r.text) for r in odd_docs.collect())
    assert all(r.taken <= 3 * r["size"] for r in rows)
    assert mixing.taken_words(odd_docs.limit(0)).collect() == []
    assert mixing.mixed_documents(odd_docs.limit(0)).collect() == []


def test_mixed_documents_hold_the_words_taken(odd_docs):
    taken = Counter()
    for r in mixing.taken_words(odd_docs).collect():
        taken[r.doc_id] += r.taken
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    found = Counter()
    for r in mixed.collect():
        found[r.doc_id] += size(r.text)
        assert r.n_chars == len(r.text)
    assert +taken == +found


def test_equal_rows_without_words_all_stay(spark):
    rows = [(1, "", "a"), (1, "", "a"), (None, None, "a"), (None, " ", "a"), (None, None, "a"), (2, "x y", "a"), (2, "x y", "a"), (3, "", None), (3, "", None)]
    got = mixing.taken_words(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, size(text)) for i, text, _ in rows)
