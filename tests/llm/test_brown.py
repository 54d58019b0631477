import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from monthfold.llm import brown
from monthfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def base(docs):
    counts = Counter(t for i, text in docs if not held_out(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in docs:
        own = tokens(text)
        out.append((i, held_out(i), len(own), sum(counts[t] > 0 for t in own), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)))
    return out


def check(rows, docs):
    key = lambda r: (str(r[0]), r[2], r[5])
    for got, want in zip(sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows), key=key), sorted(base(docs), key=key), strict=True):
        assert got[:5] == want[:5]
        assert got[5] == pytest.approx(want[5], rel=1e-9, abs=1e-9)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op1_brown"](spark, SF).collect()
    check(rows, docs)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    assert all(r.score < 0 and r.perplexity > 1 for r in rows)


def test_odd_rows(odd_docs):
    check(brown.score_documents(odd_docs, rounds=1).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert brown.score_documents(odd_docs.limit(0), rounds=1).collect() == []


def test_without_training_rows(spark):
    ids = [i for i in range(200) if held_out(i)][:3]
    docs = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")
    check(brown.score_documents(docs, rounds=1).collect(), [(i, "a b") for i in ids])


def test_exchange_splits_languages_apart():
    """Two vocabularies that never follow each other get classes of their own."""
    rng = np.random.default_rng(0)
    size, number = 21, 3
    stream = []
    for _ in range(400):
        side = rng.integers(2)
        stream += [*(side * 10 + rng.integers(0, 10, 8)), 20]
    left, right = np.array([20, *stream[:-1]]), np.array(stream)
    classes = np.arange(size) % 2
    classes[20] = 2
    for _ in range(6):
        after, before = np.zeros((size, number), np.int64), np.zeros((size, number), np.int64)
        np.add.at(after, (left, classes[right]), 1)
        np.add.at(before, (right, classes[left]), 1)
        twice = np.bincount(right[left == right], minlength=size)
        classes = brown.exchange(after, before, twice, classes, number)
    assert len(set(classes[:10])) == 1 and len(set(classes[10:20])) == 1 and classes[0] != classes[10]


def test_probabilities_sum_to_one():
    class Small:
        singles, units = 2, 2 + brown.TAILS + 1
        unit_counts = np.zeros(units, np.int64)
        unit_kinds = np.zeros(units, np.int64)

    unit_counts, unit_kinds = Small.unit_counts, Small.unit_kinds
    unit_counts[[0, 1, 2, -1]] = [5, 4, 6, 3]
    unit_kinds[2] = 2
    classes = np.arange(Small.units) % 2
    classes[-1] = 2
    pairs = np.array([[3, 2, 1], [4, 1, 2], [2, 1, 0]])
    model = brown.Model(Small, classes, pairs)
    tail = np.arange(2, Small.units - 1)
    known = {2: [4, 2]}  # counts of the two words of the first tail unit
    for before in range(3):
        total = 0.0
        for u in range(Small.units):
            start = 10 ** (model.step[before, classes[u]] + model.emit[u])
            total += start * (sum(c + 1 for c in known.get(u, [])) + 1) if u in tail else start
        assert total == pytest.approx(1)
