import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from monthfold.llm import packing
from monthfold.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
ODD = [
    "", " ", "a", "a  b", "a \n b", "\n\n a", "é b", "é  b", "é \n b", "x　　 y", "a\x1c b", "it's 12 we'll  ",
    "tail \n", "\tq   w", "<|endoftext|> x", "ünï    z", "ab\x00 cd", "日本 語　 テ", "a\x85 b", "🙂 🙂\n\n🙂",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_units_encode_like_whole_texts(tokenizer):
    rng = random.Random(3)
    marks = [" ", "\n", "\t", " ", " ", "　", "\x0b", "a", "é", "'s", "9", "!", "日", "\x1f", "​"]
    texts = ODD + ["".join(rng.choice(marks) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    raw = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    tokens, ends = packing.encode(np.frombuffer(b"".join(raw), np.uint8), bounds, tokenizer, packing.Known(tokenizer), 0)
    for i, text in enumerate(texts):
        assert tokens[ends[i] : ends[i + 1]].tolist() == whole(tokenizer, text), repr(text)


@pytest.mark.parametrize("seed", range(4))
def test_plan_fills_sequences_without_gaps(seed):
    rng = random.Random(seed)
    counts = Counter(rng.choice([rng.randint(1, 64), 64, 20]) for _ in range(rng.randint(0, 3000)))
    plan = packing.best_fit(counts, 64)
    ranks, spans = defaultdict(list), defaultdict(list)
    for length, first, last, sequence, offset in plan:
        ranks[length] += range(first, last + 1)
        for k in range(last - first + 1):
            spans[sequence + k].append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(k * n for k, n in counts.items())
    assert len(spans) <= -(-total // 64) * 1.03 + 1


def test_query_against_brute_force(spark, tokenizer):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op4_packing"](spark, SF).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert pieces.keys() == docs.keys()
    for doc_id, text in docs.items():
        ids, at = whole(tokenizer, text), 0
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert len(own) == -(-len(ids) // 2048)
        for i, r in enumerate(own):
            assert (r.piece, r.start) == (i, at)
            part = ids[at : at + r.length]
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r.length
        assert at == len(ids) and all(r.length == 2048 for r in own[1:])
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) <= -(-sum(r.length for r in rows) // 2048) + 2


def test_odd_tables(spark, tokenizer):
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, "word " * 5000, 3), (3, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank int").withColumn("length", F.lit("x")).withColumn("_slice", F.lit(0))
    got = packing.pack_documents(docs, PATH).collect()
    assert sorted((r.doc_id or 0, r.piece, r.length) for r in got)[:4] == [(0, 0, 1), (1, 0, 1), (1, 0, 1), (2, 0, 5002 % 2048)]
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert packing.pack_documents(docs.limit(0), PATH).collect() == []


def test_units_of_a_tokenizer_without_bytes_are_encoded_one_by_one(tokenizer):
    units = packing.pa.array([b" one", b" two", b"three", b" \n", b" <|endoftext|>"], packing.pa.large_binary())
    plain = packing.encode_units(units, tokenizer, packing.Known(tokenizer).token_bytes)
    single = packing.encode_units(units, tokenizer, np.ones(60_000, np.int64))
    assert plain[0].tolist() == single[0].tolist() and plain[1].tolist() == single[1].tolist()


def test_worker_memory_is_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    known = packing.Known(tokenizer)
    for n in range(20):
        texts = [f"w{n} x{n} shared {i}" for i in range(9)]
        raw = [t.encode() for t in texts]
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        tokens, ends = packing.encode(np.frombuffer(b"".join(raw), np.uint8), bounds, tokenizer, known, 0)
        assert [tokens[ends[i] : ends[i + 1]].tolist() for i in range(9)] == [whole(tokenizer, t) for t in texts]
        assert len(known.units) <= 50
