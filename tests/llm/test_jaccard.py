import random
import re
from itertools import combinations

import numpy as np
import pytest

from monthfold.llm import jaccard
from monthfold.llm.groups import components
from monthfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()


def brute(docs):
    """Class and number of links of every place in a list of (doc_id, text)."""
    found = [sets(t) for _, t in docs]
    root, links = list(range(len(docs))), [0] * len(docs)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(docs)), 2):
        if found[a] and found[b] and len(found[a] & found[b]) >= 0.8 * len(found[a] | found[b]):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted((str(d), str(least.get(find(i))), links[i]) for i, (d, _) in enumerate(docs))


def check(rows, docs):
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in rows) == brute(docs)


def test_prefix_is_the_longest_that_meets_the_recall():
    k = jaccard.prefix_for(0.8, 0.999, 32, 8)
    assert 1 - (1 - 0.8**k) ** 32 >= 0.999 > 1 - (1 - 0.8 ** (k + 1)) ** 32
    with pytest.raises(ValueError):
        jaccard.prefix_for(0.1, 0.999, 2, 8)


def prefix_families(rows, length):
    """Node sets connected by common prefixes of ``length`` hashes in some tree; rows of (node, labels by tree)."""
    root = {n: n for n, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    first = {}
    for node, labels in rows:
        for tree, label in enumerate(labels):
            root[find(node)] = find(first.setdefault((tree, label[: 2 * length]), node))
    families = {}
    for n in root:
        families.setdefault(find(n), set()).add(n)
    return {frozenset(f) for f in families.values() if len(f) > 1}


@pytest.mark.parametrize("ranges", ["1", "7"])
@pytest.mark.parametrize("shortest", [1, 2, 3])
def test_tries_meet_all_common_prefixes(spark, ranges, shortest):
    """Ties connect what shares a prefix, in whatever ranges the sorted labels are cut, hot labels too."""
    rng = random.Random(shortest)
    rows = []
    for i in range(600):
        hot = i % 3 == 0
        labels = [bytes([7, 0] * 3) if hot and t == 0 else b"".join(bytes([rng.randrange(40), rng.randrange(4)]) for _ in range(3)) for t in range(2)]
        rows.append((rng.randbytes(16), labels))
    nodes = spark.createDataFrame([(bytearray(n), bytearray(b"".join(ls))) for n, ls in rows], "node binary, labels binary")
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in zip(names, (ranges, "false", "50"), strict=True):
            spark.conf.set(name, value)
        roots = components(jaccard.ties(nodes, 2, 3, shortest)).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    families = {}
    for r in roots:
        families.setdefault(bytes(r.root), set()).add(bytes(r.node))
    assert {frozenset(f) for f in families.values()} == prefix_families(rows, shortest)


def test_entries_are_tied_once_at_their_longest_match():
    """Of four labels two are equal, one shares two hashes and one shares one: each is tied to its stretch's head."""
    label = np.array([[1, 2, 3], [1, 2, 3], [1, 2, 4], [1, 5, 5]], np.uint16).view(np.uint8)
    node = np.arange(4, dtype=np.uint8)[:, None].repeat(16, axis=1)
    whole = jaccard.Walk(3, 1)
    met, head = whole.step(np.zeros(4, np.int32), label, node)
    assert met.tolist() == [0, 3, 2, 1] and head[1:, 0].tolist() == [0, 0, 0]
    cut = jaccard.Walk(3, 1)
    parts = [cut.step(np.zeros(1, np.int32), label[i : i + 1], node[i : i + 1]) for i in range(4)]
    assert [int(m[0]) for m, _ in parts] == met.tolist() and [int(h[0, 0]) for _, h in parts][1:] == [0, 0, 0]


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(QUERIES["op8_jaccard"](spark, SF).collect(), docs)


def test_near_copies_of_one_text(spark, monkeypatch):
    """A family larger than a part: all links within and between parts count."""
    monkeypatch.setattr(jaccard, "PART", 16)
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    docs = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 10**6)}"
        docs.append((i, (" " if i % 2 else "\n").join(words)))
    docs += [(200 + i, docs[i][1]) for i in range(20)]
    rows = jaccard.similar(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    check(rows, docs)


def test_odd_rows(odd_docs):
    rows = jaccard.similar(odd_docs).collect()
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in rows)
    want = brute(docs)
    # Texts without words are classes of their own.
    assert got == want
    kept = jaccard.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted({str(r.doc_id) for r in kept.collect()}) == ["1", "4", "5", "6", "7", "8", "None"]
    assert jaccard.similar(odd_docs.limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
