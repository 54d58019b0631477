import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthfold.llm import suffixes
from monthfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(docs, length):
    """What is left of (doc_id, text): all strings before, by place."""
    seen, order, out = {}, sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0)), []
    for i in order:
        body = (docs[i][1] or "").encode()
        for at in range(len(body) - length + 1):
            seen.setdefault(body[at : at + length], (docs[i][0] is None, docs[i][0] or 0, at))
            seen[body[at : at + length]] = min(seen[body[at : at + length]], (docs[i][0] is None, docs[i][0] or 0, at))
    for i in order:
        body = (docs[i][1] or "").encode()
        gone = bytearray(len(body))
        for at in range(len(body) - length + 1):
            if seen[body[at : at + length]] < (docs[i][0] is None, docs[i][0] or 0, at):
                gone[at : at + length] = b"\1" * length
        kept = bytes(c for c, g in zip(body, gone, strict=True) if not g)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((str(docs[i][0]), len(body), sum(gone), runs, kept))
    return sorted(out)


def rows_of(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect())


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op10_suffixes"](spark, SF).collect())
    assert got == [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(docs, 100)]


@pytest.mark.parametrize("hot", [2, 3, 64])
@pytest.mark.parametrize("seed", range(2))
def test_random_texts(spark, monkeypatch, seed, hot):
    """Short strings over a small alphabet: many grams repeat, with and without the way for hot ones."""
    monkeypatch.setattr(suffixes, "HOT", hot)
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.randint(5, 60))) for _ in range(12)]
    docs = [(i, "".join(rng.choice([*pool, "ab" * 30, "a"]) for _ in range(rng.randint(0, 9)))) for i in rng.sample(range(500), 60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert rows_of(suffixes.remaining(df, 24, 8)) == brute(docs, 24)


def test_anchors_hold_the_least_gram_of_every_string():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 4000).astype(np.uint8)
    bounds = np.array([0, 1500, 1500, 1530, 4000])
    found, _ = suffixes.anchors(data, bounds, 40, 10)
    hashed = suffixes.hash_of(suffixes.words_at(data), np.arange(len(data) - 9), 10, 1)
    wanted = set()
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        for at in range(low, high - 39):
            part = hashed[at : at + 31]
            wanted |= {at + int(k) for k in np.flatnonzero(part == part.min())}
    assert wanted <= set(found.tolist())


def test_odd_rows(spark, odd_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert rows_of(suffixes.remaining(odd_docs, 16, 8)) == brute(docs, 16)
    assert suffixes.remaining(odd_docs.limit(0)).collect() == []
    twins = spark.createDataFrame([(1, "x" * 300), (1, "x" * 300), (1, "y" + "x" * 120), (2, "x" * 150)], "doc_id long, text string").withColumn("kept", F.lit(1))
    got = rows_of(suffixes.remaining(twins, 100, 20))
    assert got == brute([(r.doc_id, r.text) for r in twins.collect()], 100)


def test_splitters_are_of_the_whole_table(spark):
    """Rows that come first are alike; the ranges must fit those after them too."""
    rng = random.Random(4)
    texts = ["".join(rng.choices(letters, k=400)) for letters in ("abcd", "wxyz") for _ in range(2 * suffixes.SAMPLE)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, text string").coalesce(1)
    leading = suffixes.leading_splitters(docs, suffixes.LENGTH, suffixes.GRAM) >> np.uint64(56)
    assert 0.3 < (leading >= ord("w")).mean() < 0.7
