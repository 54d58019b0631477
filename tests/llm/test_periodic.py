"""Runs against a brute-force search over all starts and periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from monthfold.llm import periodic, queries


def brute_runs(words):
    """Every maximal stretch of three periods and 24 words, with its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        x = 0
        while x + q < n:
            if words[x] != words[x + q]:
                x += 1
                continue
            y = x
            while y + q < n and words[y] == words[y + q]:
                y += 1
            length = y - x + q
            if length >= max(24, 3 * q):
                found.setdefault((x, length), q)
            x = y
    return sorted((s, n, q) for (s, n), q in found.items())


def runs_of_lists(texts):
    ids = np.array([w for t in texts for w in t], np.int64)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return [[tuple(r) for r in runs.tolist()] for runs in periodic.runs_of(ids, bounds)]


def repetitive(rng):
    """Words with runs of all kinds: repeated stretches, nested ones, cut and shifted."""
    out = []
    for _ in range(rng.randint(1, 5)):
        out += [rng.randint(0, 3) for _ in range(rng.randint(0, 20))]
        unit = [rng.randint(0, rng.choice([1, 2, 50])) for _ in range(rng.randint(1, rng.choice([4, 12, 60])))]
        if rng.random() < 0.4:
            unit = unit * rng.randint(1, 4) + [rng.randint(0, 2)]
        whole = unit * rng.randint(2, 9)
        out += whole[rng.randint(0, len(unit)) : len(whole) - rng.randint(0, len(unit))]
    return out


@pytest.mark.parametrize("seed", range(60))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    texts = [repetitive(rng) for _ in range(12)] + [[]] + [[0] * rng.randint(0, 90)]
    assert runs_of_lists(texts) == [brute_runs(t) for t in texts]


def test_long_periods_and_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    rng = random.Random(5)
    unit = [rng.randint(0, 10**6) for _ in range(700)]
    texts = [b, unit * 4 + unit[:99], unit, unit * 2, [1] * 3000, ([1] * 30 + [2]) * 40]
    assert runs_of_lists(texts) == [brute_runs(t) for t in texts]


def expected(doc_id, text):
    words = [w for w in _words(text or "")]
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


def _words(text):
    out, word = [], ""
    for c in text:
        if c in " \t\n\x0b\x0c\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out + [word] if word else out


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(9)
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0][:40]
    rows = [(i, " ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 150)))) for i in [*ids, *range(20)]]
    rows += [(1, " \t".join(["a", "b\x1c", "ü\x00"] * 20)), (1, " \t".join(["a", "b\x1c", "ü\x00"] * 20)), (None, "x\n" * 24), (None, None), (ids[0], None), (ids[1], " \n"), (ids[2], "one")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op13_periodic(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((expected(*r) for r in rows), key=repr)
    assert sum(r[1] for r in got) > 20


def test_odd_rows(odd_docs):
    got = {(r.doc_id, r.n_words, len(r.runs)): r.collapsed for r in periodic.word_runs(odd_docs).collect()}
    assert got[(5, 0, 0)] == "" and got[(6, 0, 0)] == "" and got[(4, 0, 0)] == ""
    assert got[(8, 7, 0)] == "ünï\x00 çödé 　 日本語 🙂 \x85 end"
    assert got[(7, 20000, 1)].split() == [f"w{i * 7919 % 5003}" for i in range(5003)]
    assert periodic.word_runs(odd_docs.limit(0)).count() == 0
    assert periodic.word_runs(odd_docs).count() == odd_docs.count()
