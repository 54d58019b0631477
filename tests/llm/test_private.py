"""Base spans against plain regular expressions, weights against a plain EM, and what is added."""

import hashlib
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from monthfold.llm import private, queries

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base(text):
    found = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        found += [(m.start(), number, m.end()) for m in re.finditer(pattern, text or "") if passes(kind, m.group())]
    return sorted(found)


def texts():
    rng = random.Random(4)
    parts = "a@b.c_d@e.f a@@b.c x.y%z@-a.b.c. 1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 4111-1111 1111-1111 +1 (269) 555-3296 ü🙂 +49 30 1234567 + 4111111111111111 12 - . ) ( \n _@a.b".split(" ")
    out = ["".join(rng.choice([*parts, " ", " ", "7", "日"]) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    out += ["tel +1 (269) 555-3296 4524132264652876 end", "1.1.1.1 " * 700, "p@q.rs," * 300, "", " 4111 1111 1111 1111", "9" * 40]
    return out


def test_base_spans(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    got = {r.doc_id: r for r in private.private_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    for i, text in rows:
        assert [tuple(s) for s in got[i].base] == base(text), text
        assert set(map(tuple, got[i].base)) <= set(map(tuple, got[i].spans))
    assert max(len(r.base) for r in got.values()) > 2 * private.CHUNK


def plain_em(patterns, rounds):
    weights = {}
    for kind in range(4):
        rows = [(v, n) for k, v, n in patterns if k == kind]

        def estimate(posts):
            mass = {1: sum(n * p for (_, n), p in zip(rows, posts, strict=True)), 0: sum(n * (1 - p) for (_, n), p in zip(rows, posts, strict=True))}
            out = [math.log((mass[1] + 1) / (mass[0] + 1))]
            for i in range(private.LABELERS):
                for v in range(3):
                    share = {}
                    for z in (0, 1):
                        hit = sum(n * (p if z else 1 - p) for (vs, n), p in zip(rows, posts, strict=True) if vs[i] == v - 1)
                        share[z] = (hit + private.PRIOR[z][v]) / (mass[z] + sum(private.PRIOR[z]))
                    out.append(math.log(share[1] / share[0]))
            return out

        w = [0.0] + [math.log(private.PRIOR[1][v] / private.PRIOR[0][v]) for _ in range(private.LABELERS) for v in range(3)]
        for _ in range(rounds):
            odds = [w[0] + sum(w[2 + 3 * i + vs[i]] for i in range(private.LABELERS)) for vs, _ in rows]
            w = estimate([1 / (1 + math.exp(-max(min(o, 30), -30))) for o in odds])
        weights[kind] = w
    return [x for kind in range(4) for x in weights[kind]]


def test_weights_against_a_plain_em(spark):
    rng = random.Random(2)
    rows = {(rng.randint(0, 2), tuple(rng.randint(-1, 1) for _ in range(private.LABELERS))): rng.randint(1, 50) for _ in range(80)}
    flat = [(k, *v, n) for (k, v), n in rows.items()]
    names = ", ".join(f"v{i} int" for i in range(private.LABELERS))
    got = private.reliabilities(spark.createDataFrame(flat, f"kind int, {names}, n long"), 5)
    assert got == pytest.approx(plain_em([(k, v, n) for (k, v), n in rows.items()], 5))


def test_what_is_added_and_what_is_not(spark):
    rng = random.Random(8)

    def card():
        body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return next(body + d for d in "0123456789" if luhn(body + d))

    rows = []
    for i in range(300):
        number = f"+1 ({rng.randint(200, 989)}) 555-{rng.randint(1000, 9999)}"
        rows.append((i, f"word anne.{i}@mail{i % 9}.example.com then {number} more {card()} text 10.2.{i % 250}.7 end"))
    known = card()
    cases = {
        1000: (f"ask +1 (269) 555-3296 {known} now", {"+1 (269) 555-3296", known}),
        1001: ("write to jane.doe [at] example [dot] com today", {"jane.doe [at] example [dot] com"}),
        1002: ("call me: (415) 555-2671 soon", {"(415) 555-2671"}),
        1003: ("my email is bob at example dot org ok", {"bob at example dot org"}),
        2000: ("password=4111111111111112aa order 4929000000000001 ready at noon dots", set()),
        2001: ("it starts at 12:30:45 and ends 2024-05-06, page 123-4567", set()),
        2002: ("look at the dot on the i", set()),
    }
    rows += [(i, t) for i, (t, _) in cases.items()]
    got = {r.doc_id: r for r in private.private_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for i, (text, wanted) in cases.items():
        assert {text[s.start : s.end] for s in got[i].spans} == wanted, i
    assert all(len(got[i].base) == 4 and got[i].spans == got[i].base for i in range(300))


def test_query_columns(spark, tmp_path):
    rows = [(1, "a@b.cd and 10.0.0.1"), (1, "a@b.cd and 10.0.0.1"), (None, None), (2, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in queries.op11_private(spark, str(tmp_path)).where("doc_id = 1").collect())
    shown = "email:0:6,ip:11:19"
    assert got == [(1, 1, 1, 0, 0, hashlib.sha256(shown.encode()).hexdigest(), shown)] * 2
    assert queries.op11_private(spark, str(tmp_path)).where("doc_id is null or doc_id = 2").select("spans").collect() == [("",), ("",)]


def test_odd_rows_and_long_runs(spark, odd_docs):
    assert private.private_spans(odd_docs).count() == odd_docs.count()
    assert private.private_spans(odd_docs.limit(0)).count() == 0
    long = [(1, "a" * 2_000_000), (2, "1" * 2_000_000), (3, "1.1." * 300_000), (4, "a@" * 500_000), (5, "+1 " * 400_000), (6, "1:" * 500_000)]
    began = time.time()
    assert private.private_spans(spark.createDataFrame(long, "doc_id long, text string").repartition(6)).agg(F.sum(F.size("spans"))).head()[0] >= 0
    assert time.time() - began < 120


def test_no_python_in_the_plan(spark, odd_docs):
    shown = private.private_spans(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in shown and "Arrow" not in shown and "Pandas" not in shown
