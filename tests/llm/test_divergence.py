"""The audit against a brute-force version; transducers against sorted lists."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from monthfold.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least_docs, top):
    docs = [(lang or "", source or "", [t.translate(LOWER) for t in TERM.findall(text or "")]) for text, lang, source in rows]
    held, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        held[lang].update(set(terms))
        counts[lang, source].update(terms)
    kept = {lang: sorted((t for t, n in c.items() if n >= least_docs), key=str.encode) for lang, c in held.items()}
    out = []
    figures = {}
    for (lang, source), c in counts.items():
        terms = kept.get(lang, [])
        total = sum(c[t] for t in terms)
        figures[lang, source] = [1 + 10**9 * (c[t] + 5) // (total + 5 * len(terms)) for t in terms]
    for (lang, source), c in counts.items():
        terms, p = kept.get(lang, []), figures[lang, source]
        whole = Counter()
        for (other_lang, _), other in counts.items():
            if other_lang == lang:
                whole.update({t: other[t] for t in terms})
        total = sum(whole.values())
        q = [1 + 10**9 * (whole[t] + 5) // (total + 5 * len(terms)) for t in terms]
        pairs = [(o, sum(abs(x - y) for x, y in zip(p, figures[ol, o], strict=True))) for ol, o in counts if ol == lang and o != source]
        typical = [(t, x - y) for t, x, y in zip(terms, p, q, strict=True) if c[t] and x > y]
        for part, items, most in (("pair", pairs, None), ("term", typical, top)):
            ordered = sorted(items, key=lambda i: (-i[1], i[0].encode()))[:most]
            out += [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_odd_rows(spark, odd_docs):
    rows = [(r.text, r.lang, r.source) for r in odd_docs.collect()]
    for least in (1, 2):
        assert got(divergence.audit(odd_docs, least, 3)) == brute(rows, least, 3)
    assert divergence.audit(odd_docs.limit(0)).count() == 0
    # Nothing is in 30 documents: pairs at 0, no terms.
    assert {(r.part, r.value) for r in divergence.audit(odd_docs).collect()} == {("pair", 0)}


@pytest.mark.parametrize("volume_bytes, pass_bytes", [(4_000_000, 16_000_000), (3000, 5000)])
def test_many_sources_terms_and_volumes(spark, monkeypatch, volume_bytes, pass_bytes):
    # More sources than a side, more terms than a block; with small volumes also several passes.
    monkeypatch.setattr(divergence, "VOLUME_BYTES", volume_bytes)
    monkeypatch.setattr(divergence, "PASS_BYTES", pass_bytes)
    rng = random.Random(3)
    pool = ["".join(rng.choice("abcéßñ日Z") for _ in range(rng.randint(1, 6))) for _ in range(5000)]
    rows = []
    for i in range(330):
        lang = "xy"[i % 7 == 0]
        rows.append((" ".join(rng.choice(pool[: rng.choice([50, 5000])]) for _ in range(90)), lang, f"s{i % 150}" if lang == "x" else f"s{i % 3}"))
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert got(divergence.audit(docs, 2, 5)) == brute(rows, 2, 5)


def test_transducer_gives_places_and_is_minimal():
    rng = random.Random(1)
    terms = sorted({("de", "".join(rng.choice("abcé") for _ in range(rng.randint(1, 7))).encode()) for _ in range(900)})
    terms += sorted({("en", "".join(rng.choice("ab") for _ in range(rng.randint(1, 9))).encode()) for _ in range(400)})
    made = divergence.build(terms)
    machine = divergence.Transducer({**made, "base": 100})
    asked = [*terms, ("fr", b"a"), ("en", b"abc"), ("de", b"zz"), ("en", b"ab" * 9), ("de", terms[0][1] + b"q")]
    data = np.frombuffer(b"".join(t for _, t in asked), np.uint8)
    end = np.cumsum([len(t) for _, t in asked])
    start = end - [len(t) for _, t in asked]
    langs = ["de", "en", "fr"]
    places = machine.ordinals(data, start, end, np.array([langs.index(lang) for lang, _ in asked]), langs)
    order = {t: 100 + i for i, t in enumerate(terms)}
    assert places.tolist() == [order.get(t, -1) for t in asked]
    # As many states as there are different sets of endings, over both languages.
    endings = {frozenset(t[len(p) :] for lg, t in terms if lg == lang and t.startswith(p)) for lang, w in terms for p in (w[:i] for i in range(len(w) + 1))}
    assert made["states"] == len(endings)


def test_probability_is_exact_for_large_counts(spark):
    n, total, terms = 3 * 10**17 + 1, 7 * 10**17 + 3, 10**9
    row = spark.range(1).select(divergence.probability(*[divergence.F.lit(x).cast("long") for x in (n, total, terms)]).alias("p")).head()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * terms)
