import zlib

import numpy as np
from pyspark.sql import functions as F

from monthfold.llm import quality
from monthfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute_maxima(model, body):
    """Filter responses at every position, with plain loops."""
    body = np.concatenate([body, np.zeros(max(0, quality.WIDTH - len(body)), np.uint8)])
    rest = -(len(body) - quality.WIDTH) % quality.STRIDE
    body = np.concatenate([body, np.zeros(rest, np.uint8)])
    best = np.full(quality.FILTERS, -np.inf)
    for at in range(0, len(body) - quality.WIDTH + 1, quality.STRIDE):
        patch = model["bytes"][body[at : at + quality.WIDTH]].reshape(-1)
        best = np.maximum(best, patch @ model["filters"] + model["shift"])
    return best


def test_chunks_cover_all_positions():
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 256, n).astype(np.uint8) for n in (0, 1, 15, 16, 17, 18, 8191, 8192, 8193, 20_001)]
    model = quality.fit([rng.integers(0, 256, 60).astype(np.uint8) for _ in range(8)], [0, 1] * 4, steps=3)
    got = quality.pooled(model, texts)
    for text, found in zip(texts, got, strict=True):
        np.testing.assert_allclose(found, brute_maxima(model, text), rtol=1e-4, atol=1e-4)


def test_slope_is_the_loss_slope():
    rng = np.random.default_rng(2)
    texts = [rng.integers(60, 120, 50).astype(np.uint8) for _ in range(6)]
    labels = np.array([0, 1, 1, 0, 1, 1], np.float32)
    model = quality.fit(texts, labels, steps=2)
    slope = quality.gradient(model, texts, labels)

    def loss(m):
        p = np.clip(quality.probability(m, texts), 1e-9, 1 - 1e-9)
        return float((-np.where(labels > 0, np.log(p), quality.RARE_WEIGHT * np.log(1 - p))).mean())

    for name, at in (("weights", (3,)), ("shift", (5,)), ("filters", (7, 2)), ("bytes", (texts[0][10], 1))):
        step = 1e-2
        up, down = ({k: v.copy() if hasattr(v, "copy") else v for k, v in model.items()} for _ in range(2))
        up[name][at] += step
        down[name][at] -= step
        assert abs((loss(up) - loss(down)) / (2 * step) - slope[name][at]) < 0.02 * max(1, abs(slope[name][at])) + 5e-3


def test_query_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in QUERIES["op3_quality"](spark, SF).collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null").collect()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(rows[x.doc_id].predicted, x.quality) for x in labels if rows[x.doc_id].held_out]
    assert sum(p == q for p, q in held) / len(held) > 0.93


def test_odd_rows_and_labels(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (99, 0)], "doc_id long, quality int").withColumn("text", F.lit("q"))
    rows = quality.score_documents(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    same = {r.score for r in rows if r.doc_id in (4, 5)}
    assert len(same) == 1
    assert quality.accepted(odd_docs, labels).columns == odd_docs.columns
    assert quality.score_documents(odd_docs.limit(0), labels).collect() == []
    none = quality.score_documents(odd_docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_chunks_reach_the_end_of_every_text():
    for n in (*range(20), *range(8170, 8200), *range(16345, 16380), *range(24_520, 24_560)):
        parts, _ = quality.chunks([np.ones(n, np.uint8)])
        positions = sum((len(p) - quality.WIDTH) // quality.STRIDE + 1 for p in parts)
        assert positions == max(-(-(n - quality.WIDTH) // quality.STRIDE), 0) + 1, n
        # Chunks share what a filter position reaches beyond the step.
        assert sum(int(p.sum()) for p in parts) == n + (len(parts) - 1) * (quality.WIDTH - quality.STRIDE), n
