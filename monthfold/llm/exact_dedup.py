"""Exact duplicates by a tree-merge of sorted runs of digests.

Every row is one digest; rows are dealt to lanes by the hash of their id. A lane's
run is sorted by digest and holds, per digest, the row that stays. In binomial
rounds (16 lanes, then 8, 4, 2, 1) every second lane hands its run to its
neighbour. A run is cut into ranges of digests, so that a round's tasks each merge
the pieces of one range from all tasks of the round before: rows are dealt by lane
and range, sorted by digest, and neighbours with one digest become the better of
them, with their counts added up. A hot digest is thereby one row per task of the
first round and two rows per merge later.

Digests are verified by the length and a second hash of the normalised text: they
are part of the key, so texts with equal digests but other content stay apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthfold.llm.common import SPACE_CLASS, carried, own, restored, whole_text, written

LANES = 16
KEY = ["digest", "norm_chars", "second"]
# Leading hexadecimal digits of a digest that name its range.
RANGE_DIGITS = 3


def digests(docs: DataFrame) -> DataFrame:
    """One row per document: its id, digest, verification and original length."""
    text = whole_text()
    rows = own(docs, "doc_id", "text").select(
        "doc_id",
        F.char_length(text).cast("long").alias("chars"),
        F.regexp_replace(text, SPACE_CLASS, "").alias("norm"),
    )
    return rows.select(
        "doc_id",
        "chars",
        F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("digest"),
        F.char_length("norm").cast("long").alias("norm_chars"),
        F.xxhash64("norm").alias("second"),
    )


def merge_runs(rows: DataFrame, lanes: int = LANES) -> DataFrame:
    """One row per digest: the id that stays, its length and the group's size."""
    better = F.struct(F.col("chars"), F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("before"))
    lane = F.pmod(F.xxhash64("doc_id"), F.lit(lanes)).cast("int")
    place = F.conv(F.substring(F.hex("digest"), 1, RANGE_DIGITS), 16, 10).cast("int")
    single = rows.select(lane.alias("lane"), place.alias("range"), *KEY, better.alias("best"), F.lit(1).cast("long").alias("n"))
    # Tasks fold what they read before anything is dealt.
    runs = merged(single)
    while lanes > 1:
        lanes = -(-lanes // 2)
        handed = runs.withColumn("lane", F.floor(F.col("lane") / 2).cast("int"))
        runs = merged(handed.repartition("lane", "range").sortWithinPartitions("lane", "range", *KEY))
    return runs.select(*KEY, (-F.col("best.before")).alias("keep_id"), F.col("best.chars").alias("keep_chars"), F.col("n").alias("group_size"))


def merged(runs: DataFrame) -> DataFrame:
    """Rows of a lane with one digest put together: the better of them, and their number.

    The maximum of a struct is a sort aggregate: it reads rows in the order of lane, range and digest.
    """
    return runs.groupBy("lane", "range", *KEY).agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): keep_id, group_size, kept, text_sha256.

    Equal: same text without ``[\\x20\\x09-\\x0D]``. The row with the most code
    points stays, then the smallest doc_id. Null texts are empty ones; a null
    doc_id comes after all others. Of rows with the same doc_id and length in a
    group exactly one is kept. Other columns are not looked at; an empty table
    gives no rows.
    """
    rows = written(digests(docs), "digests")
    best = merge_runs(rows).select(
        *[F.col(k).alias(f"best_{k}") for k in KEY], "keep_id", "keep_chars", "group_size"
    )
    same = F.lit(True)
    for k in KEY:
        same = same & (F.col(k) == F.col(f"best_{k}"))
    joined = rows.join(best, same)
    twin = Window.partitionBy("doc_id", "digest", "chars").orderBy("second")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    return joined.withColumn("twin", F.row_number().over(twin)).select(
        "doc_id",
        "keep_id",
        "group_size",
        (stays & (F.col("twin") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_unique(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows with one doc_id and one normalised text are the same document; of them
    the longest comes, once.
    """
    kept = exact_groups(docs).where("kept").select(F.struct("doc_id").alias("id"), F.col("text_sha256").alias("key"))
    digest = F.sha2(F.regexp_replace(whole_text(), SPACE_CLASS, "").cast("binary"), 256)
    rows = carried(docs, "doc_id", "text")
    keyed = rows.select("doc", F.struct("doc_id").alias("id"), digest.alias("key"), F.char_length(whole_text()).alias("chars"))
    # Same keys as the join, so the texts are shuffled once for both.
    twin = Window.partitionBy("id", "key").orderBy(F.col("chars").desc())
    one = keyed.withColumn("twin", F.row_number().over(twin)).where("twin = 1")
    return restored(one.join(kept, ["id", "key"], "left_semi"), docs)
