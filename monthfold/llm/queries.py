"""The queries of this subpackage and the SQL that some are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthfold.llm import (
    brown,
    divergence,
    exact_dedup,
    jaccard,
    licences,
    mixing,
    packing,
    periodic,
    private,
    quality,
    sharding,
    suffixes,
    topk,
)
from monthfold.llm.common import WORD_CLASS, whole_text

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(function):
    """Register a query under its function's name."""
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_brown(spark, sf_dir):
    """Every document's log10 probability under the class bigram model."""
    return brown.score_documents(table(spark, sf_dir, "documents"))


@query
def op2_sharding(spark, sf_dir):
    """Every document's shard by the permutation-filled table."""
    return sharding.place(table(spark, sf_dir, "documents"), "doc_id")


@query
def op3_quality(spark, sf_dir):
    """Every document's probability of label 1 of quality."""
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op4_packing(spark, sf_dir):
    """Every document's pieces and their places in sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file())


@query
def op5_licences(spark, sf_dir):
    """The licences of every document and the sentences that show them."""
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[F.concat_ws(",", c).alias(c) for c in ("licences", "line_ids", "sentence_ids")])


ORACLE["op5_licences"] = licences.scan_sql()


@query
def op6_topk(spark, sf_dir):
    """The 20 best rows by inner product for every 20th vector."""
    return topk.search_vectors(table(spark, sf_dir, "embeddings"))


ORACLE["op6_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.ints, c.ints), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


@query
def op7_mixing(spark, sf_dir):
    """Words taken of every document for the target mix of sources."""
    return mixing.taken_words(table(spark, sf_dir, "documents"))


@query
def op8_jaccard(spark, sf_dir):
    """Every document's class of near copies and its number of links."""
    return jaccard.similar(table(spark, sf_dir, "documents"))


@query
def op9_exact_dedup(spark, sf_dir):
    """The row that stays for every document, by digest of its normalised text."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


ORACLE["op9_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER g AS place
  FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r
"""


@query
def op10_suffixes(spark, sf_dir):
    """What is left of every document without passages that stand earlier."""
    left = suffixes.remaining(table(spark, sf_dir, "documents"))
    return left.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def folded(docs: DataFrame) -> DataFrame:
    """The documents, those with a CRC-32 of the decimal doc_id that ends in 0 with words that repeat.

    With g that number's tenth and n words: from word a = g % n on, the next
    1 + (n - a) // (3 + g % 8) words repeat to the end. Rows without doc_id stay as
    they are.
    """
    words = F.regexp_extract_all(whole_text(), F.lit(f"({WORD_CLASS})"))
    number = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", F.when(number % 10 == 0, F.struct(words.alias("words"), F.floor(number / 10).alias("g"))).alias("fold"))
    n, g = F.size("fold.words"), F.col("fold.g")
    sized = chosen.withColumn("a", F.when(n > 0, g % n).cast("int"))
    period = F.floor((n - F.col("a")) / (3 + g % 8)).cast("int") + 1
    placed = sized.withColumn("p", period)
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    joined = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(F.col("fold.words"), place(i))), " ")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), joined).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic(spark, sf_dir):
    """Every document's periodic runs of words, the most repetitive one, and the text without repeats."""
    found = periodic.word_runs(folded(table(spark, sf_dir, "documents")))
    # Runs come by start and period, so of equal exponents the first stays.
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))),
        F.get("runs", F.lit(0)),
        lambda a, x: F.when(x["length"] * a["period"] > a["length"] * x["period"], x).otherwise(a),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_divergence(spark, sf_dir):
    """Every source against the others of its language, and its most typical terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLE["op12_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
  FROM documents),
w AS (
  SELECT id, lang, source, translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
gp AS (
  SELECT gn.lang, gn.source, kept.term, coalesce(n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p
  FROM gn JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
lp AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (any_value(total) + 5 * any_value(v)) AS q
  FROM c JOIN v USING (lang) JOIN (SELECT lang, sum(total) AS total FROM gn GROUP BY ALL) USING (lang) GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         coalesce((SELECT sum(abs(x.p - y.p)) FROM gp x JOIN gp y USING (lang, term)
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
terms AS (
  SELECT gp.lang, gp.source, gp.term AS item, p - q AS value FROM gp JOIN lp USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
FROM pairs
UNION ALL
SELECT lang, source, 'term' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
FROM terms QUALIFY rank <= 50
"""


@query
def op11_private(spark, sf_dir):
    """Personal data of every document: base spans, and those that weak supervision adds."""
    found = private.private_spans(table(spark, sf_dir, "documents"))


    def count(number):
        return F.size(F.filter("base", lambda x: x["kind"] == number)).cast("long").alias(f"n_{private.KINDS[number]}")

    return found.select(
        "doc_id", *[count(i) for i in range(len(private.KINDS))], F.sha2(private.shown(F.col("base")), 256).alias("base_sha256"), private.shown(F.col("spans")).alias("spans")
    )
