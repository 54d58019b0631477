"""Mixing sources to target weights over fixed-length blocks.

The words of a source form one stream (its documents in a fixed order), cut into
blocks of ``block_words``. A source's target becomes a number of slots, each
taking one block. Slots are drawn to output shards independently of each other,
so a shard's counts by source are a multinomial draw, and their totals meet the
targets to the word. Slot k of a source takes block ``perm(k mod blocks)``, where
``perm`` is a pseudorandom permutation keyed by seed, source and pass over the
source; slots and blocks meet in a join by index.

Everything is DataFrame expressions. Streams are laid out by sums over slices of
a source (see ``common.running``), so a hot source is no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthfold.llm.common import WORD_CLASS, carried, own, restored, running, whole_text, written

BLOCK_WORDS = 512
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
SHARDS = 64
SEED = 17
# Rounds of the Feistel network.
ROUNDS = 6


def word_count(name: str = "text") -> Column:
    return F.regexp_count(whole_text(name), F.lit(WORD_CLASS)).cast("long")


def targets(sizes: DataFrame, share: float = 1.0, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) to target: words to take of each source.

    Sources in code point order (null last) get the weights in turn and share
    ``share`` of all sizes; none gets over ``most`` times its size, and what is
    cut there is shared again by weight. Targets are min(cap, level * weight);
    the level follows from running sums over the sources by cap / weight, since
    sources are capped in that order. One row per source: the sort is of sources,
    not of documents.
    """
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights))) + 1).cast("int")))
    capped = ranked.withColumn("cap", F.col("source_size").cast("double") * most)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    on = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    levels = capped.withColumn(
        "level",
        (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("weight").over(on),
    )
    # The running level rises while sources are capped and falls after: its top is the level.
    level = F.max("level").over(everything)
    return levels.withColumn("_level", level).select(
        "source", "source_size", F.least(F.col("cap"), F.col("_level") * F.col("weight")).alias("target")
    )


def permuted(index: Column, size: Column, key: Column) -> Column:
    """A pseudorandom place for ``index`` below ``size``; one to one for a given ``key``.

    A keyed Feistel network over a rectangle of about ``size`` cells: the two coordinates are in turn shifted by
    a hash of key, round and the other one. A place outside ``size`` is sent through again until it is inside;
    fewer than ``wide`` cells are outside, which bounds the walk.
    """
    one = F.lit(1).cast("long")
    size = size.cast("long")
    wide = F.greatest(F.ceil(F.sqrt(size)).cast("long"), one)
    high = F.greatest(F.floor((size + wide - 1) / wide), one)

    def turned(at: Column, i: Column) -> Column:
        low, top = at["low"], at["top"]
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(low + F.pmod(F.xxhash64(key, i, top), wide), wide)).otherwise(low).alias("low"),
            F.when(even, top).otherwise(F.pmod(top + F.pmod(F.xxhash64(key, i, low), high), high)).alias("top"),
        )

    def sent(place: Column) -> Column:
        at = F.struct((place % wide).alias("low"), F.floor(place / wide).alias("top"))
        done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), at, turned)
        return done["top"] * wide + done["low"]

    first = sent(index.cast("long"))
    inside = F.aggregate(F.sequence(one, wide), first, lambda at, _: F.when(at < size, at).otherwise(sent(at)))
    return F.when(first < size, first).otherwise(inside)


def plan_slots(goals: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS) -> DataFrame:
    """One row per slot: source_id, slot, turn (pass over the source), shard, block (index in its source), most (words it takes).

    A pass takes the source's full blocks in a permuted order, then the shorter one at its end. The
    last pass stops at the target: its last slot takes only the words that are left.
    """
    size, target = F.col("source_size"), F.col("target")
    full = F.floor(size / block_words)
    blocks = F.ceil(size / block_words).cast("long")
    passes = F.floor(target / size)
    rest = F.round(target - passes * size).cast("long")
    whole = F.least(F.floor(rest / block_words), full)
    left = rest - whole * block_words
    counted = goals.where("source_size > 0").select(
        "source_id",
        F.xxhash64(F.lit(SEED), "source").alias("key"),
        full.alias("full"),
        blocks.alias("blocks"),
        left.alias("left"),
        (passes * blocks + whole + (left > 0).cast("long")).alias("slots"),
    )
    # Runs of slots first, so that a hot source is spread before it is expanded.
    run = 4096
    runs = counted.where("slots > 0").withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / run))))
    spread = runs.repartition("source_id", "run")
    slot = spread.withColumn("slot", F.explode(F.sequence(F.col("run") * run, F.least(F.col("run") * run + run, F.col("slots")) - 1)))
    turn = F.floor(F.col("slot") / F.col("blocks"))
    place = F.col("slot") % F.col("blocks")
    last = (F.col("left") > 0) & (F.col("slot") == F.col("slots") - 1)
    return slot.select(
        "source_id",
        "slot",
        turn.cast("long").alias("turn"),
        F.pmod(F.xxhash64(F.lit(SEED), "source_id", "slot"), F.lit(shards)).cast("int").alias("shard"),
        F.when(place < F.col("full"), permuted(place, F.col("full"), F.xxhash64("key", turn))).otherwise(place).alias("block"),
        F.when(last, F.col("left")).otherwise(F.lit(block_words)).cast("long").alias("most"),
    )


def stream_layout(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with size, row (a number of their own), source_id and start in their source's stream; and targets by source."""
    rows = own(docs, "doc_id", "source", "text")
    # Rows without words do not move the start of those that follow: only a number tells equal ones apart.
    sized = written(rows.select("doc_id", "source", word_count().alias("size"), F.monotonically_increasing_id().alias("row")), "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    goals = written(targets(sizes).withColumn("source_id", F.row_number().over(order).cast("long")), "targets")
    named = goals.select(F.col("source").alias("_source"), "source_id", "source_size", "target")
    keyed = sized.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # Rows without doc_id take their own number, so that many of them are no single slice.
    unnamed = F.when(F.col("doc_id").isNull(), F.col("row"))
    return running(keyed, ["source_id"], [F.col("doc_id"), F.col("size"), unnamed], "size"), goals


def stretches(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS) -> DataFrame:
    """One row per taken stretch of a document: doc_id, source, size, source_size,
    target, shard, slot, turn, first (word in the document, from 0), words; and the
    document's start in its source's stream and its row's number.

    Documents that give nothing have one row with null shard, slot, turn and first,
    and words 0. Null texts have size 0; a null source is a source, the last. Rows
    that repeat are separate documents. An empty table gives no rows.
    """
    placed, goals = stream_layout(docs)
    covered = F.when(
        F.col("size") > 0,
        F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)),
    )
    blocks = placed.withColumn("block", F.explode_outer(covered))
    slots = plan_slots(goals, block_words, shards).withColumnsRenamed({"source_id": "_id", "block": "_block"})
    # Block indexes spread a hot source over all tasks. Expanded rows are no part of
    # the planner's estimate of the slots, so it must be told not to broadcast them.
    met = blocks.join(slots.hint("merge"), (F.col("source_id") == F.col("_id")) & (F.col("block") == F.col("_block")), "left")
    begin = F.greatest(F.col("start"), F.col("block") * block_words)
    end = F.least(F.col("start") + F.col("size"), F.col("block") * block_words + F.col("most"))
    taken = F.col("slot").isNotNull() & (begin < end)
    return met.select(
        "doc_id", "source", "size", "source_size", "target",
        *[F.when(taken, F.col(c)).alias(c) for c in ("shard", "slot", "turn")],
        F.when(taken, begin - F.col("start")).alias("first"),
        F.when(taken, end - begin).otherwise(F.lit(0)).cast("long").alias("words"),
        "start",
        "row",
    )


def taken_words(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    parts = stretches(docs, block_words)
    return (
        parts.groupBy("row", "doc_id", "source", "start", "size", "source_size", "target")
        .agg(F.sum("words").cast("long").alias("taken"))
        .select("doc_id", "size", "source_size", "target", "taken")
    )


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: what each pass over the sources takes.

    A document has one row for each pass that takes words of it; its text is the
    words taken, with the white space before them, in their order. A column
    ``n_chars`` is counted anew. Documents without words have nothing to take.
    """
    parts = stretches(docs, block_words).where("words > 0")
    takes = parts.groupBy("doc_id", "source", "size", "start", "turn").agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("takes"))
    copies = Window.partitionBy("doc_id", "source", "size").orderBy("start")
    takes = takes.withColumn("copy", F.dense_rank().over(copies)).select(F.struct("doc_id", "source", "size").alias("id"), "copy", "takes")
    rows = carried(docs, "doc_id", "source", "text")
    named = rows.select("doc", "text", F.struct("doc_id", "source", word_count().alias("size")).alias("id"))
    same = Window.partitionBy("id").orderBy(F.xxhash64(whole_text()))
    met = named.withColumn("copy", F.row_number().over(same)).join(takes.hint("merge"), ["id", "copy"])
    words = F.regexp_extract_all(whole_text(), F.lit(r"[\x20\x09-\x0D]*" + WORD_CLASS), F.lit(0))
    # Bound to a name of its own: an expression inside the inner function would be
    # worked out anew for every stretch.
    joined = F.transform(
        F.array(words),
        lambda every: F.array_join(
            F.flatten(F.transform("takes", lambda t: F.slice(every, (t["first"] + 1).cast("int"), t["words"].cast("int")))), ""
        ),
    )
    mixed = met.withColumn("taken", F.element_at(joined, 1))
    changed = {"text": F.col("taken")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length("taken").cast(docs.schema["n_chars"].dataType)
    return restored(mixed, docs, **changed)
