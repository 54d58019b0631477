import re
from collections import Counter

import corpus_pipeline
from monthfold.llm import exact_dedup, jaccard, quality
from monthfold.llm.common import drop_written, session_folder, written

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        if name != "packing":
            assert got.columns == columns
        docs = written(got, name)
        steps[name] = docs.collect()
    good = {r.doc_id for r in quality.score_documents(spark.read.parquet(f"{SF}/documents.parquet"), labels).collect() if r.predicted}
    assert {r.doc_id for r in steps["quality"]} == good
    unique = {}
    for r in steps["quality"]:
        key = re.sub(r"[\x20\x09-\x0D]+", "", r.text)
        unique[key] = min(unique.get(key, (0, r.doc_id)), (-len(r.text), r.doc_id))
    assert {r.doc_id for r in steps["exact_dedup"]} == {i for _, i in unique.values()}
    near = jaccard.similar(spark.createDataFrame(steps["exact_dedup"], spark.read.parquet(f"{SF}/documents.parquet").schema)).collect()
    assert {r.doc_id for r in steps["near_dedup"]} == {r.class_id for r in near}
    kept = {r.doc_id: Counter(words(r.text)) for r in steps["near_dedup"]}
    total = sum(len(words(r.text)) for r in steps["near_dedup"])
    assert abs(sum(len(words(r.text)) for r in steps["mixing"]) - total) < 64 * 2 * 20
    for r in steps["mixing"]:
        assert not Counter(words(r.text)) - kept[r.doc_id]
        assert r.source == before[r.doc_id].source
    pieces = steps["packing"]
    assert Counter(r.doc_id for r in pieces if r.piece == 0) == Counter(r.doc_id for r in steps["mixing"])


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_written_tables_can_be_dropped(spark):
    import os

    folder = session_folder(spark)
    assert exact_dedup.exact_groups(spark.read.parquet(f"{SF}/documents.parquet")).count() and os.path.isdir(folder)
    drop_written(spark)
    assert not os.path.exists(folder)
