import pytest
from comparing import connect, spark_rows, sql_rows

from monthfold.llm import exact_dedup
from monthfold.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_query_matches_sql(spark):
    got = spark_rows(QUERIES["op9_exact_dedup"](spark, SF))
    assert got == sql_rows(connect(SF), ORACLE["op9_exact_dedup"])


def test_odd_rows(spark, odd_docs):
    rows = exact_dedup.exact_groups(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    # The longest text stays, though its id is larger; the repeated row is dropped too.
    assert {(r.keep_id, r.group_size, r.kept) for i in (1, 2) for r in by_id[i]} == {(3, 4, False)}
    assert [r.kept for r in by_id[3]] == [True]
    # Empty, null and blank texts are one group; the blank one is the longest.
    assert {(r.keep_id, r.group_size) for i in (4, 5, 6) for r in by_id[i]} == {(6, 4)}
    assert sorted(r.kept for r in by_id[None]) == [False, True]
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})


def test_repeated_rows_stay_once(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "ab")], "doc_id long, text string")
    assert sorted((r.doc_id, r.kept) for r in exact_dedup.exact_groups(docs).collect()) == [(1, False), (1, True), (2, False)]
    assert [tuple(r) for r in exact_dedup.exact_unique(docs).collect()] == [(1, "a b")]


def test_unique_documents_keep_their_columns(odd_docs):
    got = exact_dedup.exact_unique(odd_docs)
    assert got.schema == odd_docs.schema or got.columns == odd_docs.columns
    rows = got.collect()
    assert sorted(str(r.doc_id) for r in rows) == ["3", "6", "7", "8", "None"]
    assert {r.text for r in rows if r.doc_id == 3} == {" one  two three\nfour five six seven"}


def test_empty_table(odd_docs):
    assert exact_dedup.exact_groups(odd_docs.limit(0)).collect() == []
    assert exact_dedup.exact_unique(odd_docs.limit(0)).collect() == []


@pytest.mark.parametrize("copies", [5000])
def test_hot_group(spark, copies):
    docs = spark.range(copies).selectExpr("id as doc_id", "if(id % 3 > 0, 'same  text', concat('t', id)) as text")
    rows = exact_dedup.exact_groups(docs).where("doc_id % 3 > 0").collect()
    assert {(r.keep_id, r.group_size) for r in rows} == {(1, copies - -(-copies // 3))}


@pytest.mark.parametrize("lanes", [1, 2, 5, 16])
def test_rounds_of_any_number_of_lanes(spark, lanes):
    docs = spark.range(300).selectExpr("id as doc_id", "repeat(concat('t', id % 7, ' '), 1 + int(id % 3)) as text")
    rows = exact_dedup.merge_runs(exact_dedup.digests(docs), lanes).collect()
    groups = {}
    for i in range(300):
        groups.setdefault((i % 7, i % 3), []).append(i)
    assert sorted((r.keep_id, r.group_size) for r in rows) == sorted((min(g), len(g)) for g in groups.values())


def test_runs_are_sorted_and_merged_without_another_exchange(spark):
    plan = exact_dedup.merge_runs(exact_dedup.digests(spark.range(10).selectExpr("id as doc_id", "cast(id as string) as text")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    # One exchange for the first runs and one for each of the four rounds; every merge reads sorted rows.
    assert text.count("Exchange hashpartitioning(lane") == 5
    assert text.count("SortAggregate(") == 10 and "HashAggregate(" not in text
