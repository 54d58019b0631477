import hashlib
from collections import Counter

import pytest

from monthfold.llm import sharding
from monthfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_table(shards, slots):
    """Whole preference lists, walked turn by turn."""
    lists = {}
    for s in sorted(shards):
        d = hashlib.sha256(s.encode()).digest()
        first, step = int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:16], "big") % (slots - 1) + 1
        lists[s] = [(first + k * step) % slots for k in range(slots)]
    table = {}
    while len(table) < slots:
        for s, wanted in lists.items():
            free = next((x for x in wanted if x not in table), None)
            if free is not None:
                table[free] = s
    return [table[i] for i in range(slots)]


@pytest.mark.parametrize("slots,count", [(7, 3), (101, 10), (211, 1)])
def test_table(slots, count):
    shards = tuple(f"s{i}" for i in range(count))
    table = sharding.fill(shards, slots)
    assert table == brute_table(shards, slots)
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1


def test_losing_a_shard_moves_little():
    shards = tuple(f"s{i}" for i in range(20))
    before, after = sharding.fill(shards, 10007), sharding.fill(shards[:-1], 10007)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != shards[-1])
    assert moved < 0.1 * 10007


def test_refused():
    for bad in ((), ("a", "a")):
        with pytest.raises(ValueError):
            sharding.fill(bad, 7)
    with pytest.raises(ValueError):
        sharding.fill(("a",), 8)


def test_query_against_brute_force(spark):
    table = sharding.fill(sharding.SHARDS, sharding.SLOTS)
    rows = QUERIES["op2_sharding"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        slot = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:8], 16) % sharding.SLOTS
        assert (r.slot, r.shard) == (slot, table[slot])


def test_odd_rows(odd_docs):
    rows = sharding.place(odd_docs, "doc_id").collect()
    assert len(rows) == odd_docs.count() and len({r.shard for r in rows if r.doc_id is None}) == 1
    assert sharding.place(odd_docs.limit(0), "doc_id").collect() == []
