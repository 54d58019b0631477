"""Sources against each other and their language, over a vocabulary held in transducers.

Terms are runs of letters A-Z, a-z and of code points from U+0080 on; A-Z is
lower-cased. A language keeps the terms that at least ``least_docs`` of its
documents hold. Steps:

1. Tasks count, per batch of text, in how many documents a term stands; Spark adds
   the counts up by language and term.
2. The kept terms are dealt by ranges and sorted, so that each has an ordinal over all
   (language, term) in UTF-8 order: its place in its range, shifted by the counts of the
   ranges before. No task gets more than a range.
3. Consecutive ordinals make a volume of at most ``VOLUME_BYTES`` of terms, or one
   longer term. Of each a minimal acyclic transducer is built from the sorted terms: equal
   endings share their states, every language has its own root, and each arc carries how
   many terms come before those behind it, so that the sum along a term's path is its place.
4. The texts are streamed through the volumes: every place where a term starts walks the
   transducer byte by byte, all places of a batch at once, and what is accepted is
   counted by (language, source, ordinal). Terms not kept fall out. Volumes that
   together hold up to ``PASS_BYTES`` of terms go along in one broadcast; a larger
   vocabulary takes further passes over the texts, so no broadcast grows with the data.
5. Figures are integers: probabilities come from exact decimals. For pairs of sources,
   blocks of ``BLOCK`` ordinals by ``SIDE`` and ``SIDE`` sources are compared in tasks.
   A row of counts goes to one block for each SIDE sources of the language; pairs come
   out once per block, as sums, and there are as many as the result has rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthfold.llm.common import own, written
from monthfold.llm.units import by_bytes, text_bytes

LEAST_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
BATCH_BYTES = 4_000_000
VOLUME_BYTES = 4_000_000
PASS_BYTES = 16_000_000
BLOCK = 4096
SIDE = 128


# --- terms of a batch


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z."""
    return np.where((data >= 0x41) & (data <= 0x5A), data + 0x20, data).astype(np.uint8)


def term_places(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of lower-cased letters and non-ASCII bytes."""
    inside = (data >= 0x80) | ((data >= 0x61) & (data <= 0x7A))
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(bounds, start, "right") - 1


def term_array(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The terms as an Arrow array; the bytes between terms are left out."""
    sizes = end - start
    edges = np.zeros(len(data) + 1, np.int64)
    np.add.at(edges, start, 1)
    np.add.at(edges, end, -1)
    letters = np.ascontiguousarray(data[np.cumsum(edges[:-1]) > 0])
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])


def document_counts(batches):
    """(lang, term, docs): in how many rows of a batch of text the term stands."""
    for batch in by_bytes(batches, BATCH_BYTES):
        data, bounds = text_bytes(batch.column("text"))
        data = lowered(data)
        start, end, row = term_places(data, bounds)
        if not len(start):
            continue
        terms = term_array(data, start, end).dictionary_encode()
        ids = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        langs = pa.array(batch.column("lang")).dictionary_encode()
        lang_ids = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        width = len(terms.dictionary)
        once = np.unique(row * width + ids)
        pairs, docs = np.unique(lang_ids[once // width] * width + once % width, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [
                langs.dictionary.take(pa.array(pairs // width)),
                terms.dictionary.take(pa.array(pairs % width)).cast(pa.binary()).cast(pa.string()),
                pa.array(docs, pa.int64()),
            ],
            ["lang", "term", "docs"],
        )


# --- transducers


def build(terms: list[tuple[str, bytes]]) -> dict:
    """The minimal acyclic transducer of sorted (lang, term) rows.

    States are told apart by what can follow them: whether a term may end there,
    and their arcs. A state is settled when the next term leaves it; a settled
    state that equals an earlier one, in any language, is replaced by that one.
    """
    known: dict[tuple, int] = {}
    final, behind, arcs = [], [], []  # per state: ends a term, number of terms, [(byte, state, terms before)]

    def settle(ends: bool, out: list[tuple[int, int]]) -> int:
        key = (ends, tuple(out))
        if key not in known:
            before, listed = int(ends), []
            for byte, state in out:
                listed.append((byte, state, before))
                before += behind[state]
            known[key] = len(final)
            final.append(ends)
            behind.append(before)
            arcs.append(listed)
        return known[key]

    roots: list[tuple[str, int, int]] = []
    path: list[list] = [[False, []]]  # open states along the last term: [ends, settled arcs]
    last, lang, first = b"", None, 0

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            ends, out = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(ends, out)))

    for place, (at, term) in enumerate(terms):
        if at != lang:
            if lang is not None:
                close(0)
                roots.append((lang, settle(*path[0]), first))
            path, last, lang, first = [[False, []]], b"", at, place
        shared = 0
        while shared < min(len(last), len(term)) and last[shared] == term[shared]:
            shared += 1
        close(shared)
        path.extend([False, []] for _ in term[shared:])
        path[-1][0], last = True, term
    if lang is not None:
        close(0)
        roots.append((lang, settle(*path[0]), first))
    state = np.repeat(np.arange(len(arcs)), [len(out) for out in arcs])
    flat = np.array([arc for out in arcs for arc in out], np.int64).reshape(-1, 3)
    return {
        "langs": [r[0] for r in roots],
        "roots": [r[1] for r in roots],
        "firsts": [r[2] for r in roots],
        "final": np.packbits(np.array(final, bool)).tobytes(),
        "states": len(final),
        "keys": (state * 256 + flat[:, 0]).astype(np.int64).tobytes(),
        "targets": flat[:, 1].astype(np.int32).tobytes(),
        "skips": flat[:, 2].astype(np.int32).tobytes(),
    }


class Transducer:
    """A volume's transducer, its arcs in an open hash table, for many walks at once."""

    def __init__(self, volume: dict):
        self.base = volume["base"]
        self.roots = {lang: (root, first) for lang, root, first in zip(volume["langs"], volume["roots"], volume["firsts"], strict=True)}
        self.final = np.unpackbits(np.frombuffer(volume["final"], np.uint8), count=volume["states"]).astype(bool)
        keys = np.frombuffer(volume["keys"], np.int64)
        targets, skips = np.frombuffer(volume["targets"], np.int32), np.frombuffer(volume["skips"], np.int32)
        self.bits = max(4, (2 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys, self.targets, self.skips = np.full(size, -1, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = np.flatnonzero(self.keys[slot] < 0)
            _, one = np.unique(slot[free], return_index=True)
            put = free[one]
            self.keys[slot[put]], self.targets[slot[put]], self.skips[slot[put]] = keys[left[put]], targets[left[put]], skips[left[put]]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, slot = left[rest], (slot[rest] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ordinals(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, lang: np.ndarray, langs: list[str]) -> np.ndarray:
        """The ordinal of each term, -1 where the volume does not hold it for its language."""
        known = [self.roots.get(name, (-1, 0)) for name in langs]
        root = np.array([k[0] for k in known] or [-1], np.int64)[lang]
        out = np.full(len(start), -1, np.int64)
        live = np.flatnonzero(root >= 0)
        state, place = root[live], start[live]
        total = np.array([k[1] for k in known] or [0], np.int64)[lang[live]]
        while len(live):
            done = place == end[live]
            ended = done & self.final[state]
            out[live[ended]] = total[ended] + self.base
            on = np.flatnonzero(~done)
            live, state, place, total = live[on], state[on], place[on], total[on]
            wanted = state * 256 + data[place]
            slot = self._slot(wanted)
            found = np.full(len(wanted), -1, np.int64)
            ask = np.arange(len(wanted))
            while len(ask):
                there = self.keys[slot[ask]]
                hit = there == wanted[ask]
                found[ask[hit]] = slot[ask[hit]]
                ask = ask[~hit & (there >= 0)]
                slot[ask] = (slot[ask] + 1) & (len(self.keys) - 1)
            on = np.flatnonzero(found >= 0)
            live, place, found = live[on], place[on] + 1, found[on]
            state, total = self.targets[found].astype(np.int64), total[on] + self.skips[found]
        return out


def streamed(volumes):
    """A task that walks texts through the broadcast volumes and counts (lang, source, ordinal)."""

    def task(batches):
        machines = [Transducer(v) for v in volumes.value]
        for batch in by_bytes(batches, BATCH_BYTES):
            data, bounds = text_bytes(batch.column("text"))
            data = lowered(data)
            start, end, row = term_places(data, bounds)
            langs = pa.array(batch.column("lang")).dictionary_encode()
            sources = pa.array(batch.column("source")).dictionary_encode()
            lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            source = sources.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            names = langs.dictionary.to_pylist()
            group, groups = lang * len(sources.dictionary) + source, len(names) * len(sources.dictionary)
            for machine in machines:
                ordinal = machine.ordinals(data, start, end, lang[row], names)
                kept = ordinal >= 0
                keys, n = np.unique((ordinal[kept] - machine.base) * groups + group[row[kept]], return_counts=True)
                at = keys % max(groups, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.dictionary.take(pa.array(at // max(len(sources.dictionary), 1))),
                        sources.dictionary.take(pa.array(at % max(len(sources.dictionary), 1))),
                        pa.array(keys // max(groups, 1) + machine.base, pa.int64()),
                        pa.array(n, pa.int64()),
                    ],
                    ["lang", "source", "ordinal", "n"],
                )

    return task


# --- the audit


def plain_docs(docs: DataFrame) -> DataFrame:
    """lang, source and text, null as empty."""
    rows = own(docs, "lang", "source", "text")
    return rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns])


def vocabulary(rows: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, ordinal, volume) of the kept terms; ordinals run over lang and term in UTF-8 order."""
    counted = rows.select("lang", "text").mapInArrow(document_counts, "lang string, term string, docs long")
    kept = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    size = F.octet_length("term").cast("long")
    dealt = kept.select("lang", "term").repartitionByRange("lang", "term")
    placed = written(dealt.select("lang", "term", F.spark_partition_id().alias("part")), "kept-terms")
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("terms"), F.sum(size).alias("bytes"))
    # One row per range: as many as there are shuffle partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select("part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("terms", "bytes")])
    within = Window.partitionBy("part").orderBy("lang", "term")
    numbered = placed.select(
        "*",
        (F.row_number().over(within) - 1).cast("long").alias("_place"),
        (F.sum(size).over(within) - size).alias("_bytes"),
    )
    joined = numbered.join(F.broadcast(shifts), "part")
    return written(
        joined.select(
            "lang",
            "term",
            (F.col("_place") + F.col("terms_before")).alias("ordinal"),
            F.floor((F.col("_bytes") + F.col("bytes_before")) / VOLUME_BYTES).alias("volume"),
        ),
        "vocabulary",
    )


VOLUME = (
    "volume long, base long, bytes long, langs array<string>, roots array<int>, firsts array<int>, final binary, "
    "states int, keys binary, targets binary, skips binary"
)


def build_volume(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One volume's transducer, from its terms sorted by (lang, term)."""
    table = table.sort_by("ordinal")
    langs, terms = table.column("lang").to_pylist(), table.column("term").cast(pa.binary()).to_pylist()
    made = build(list(zip(langs, terms, strict=True)))
    fixed = {"volume": key[0].as_py(), "base": table.column("ordinal")[0].as_py(), "bytes": sum(map(len, terms))}
    types = {"langs": pa.list_(pa.string()), "roots": pa.list_(pa.int32()), "firsts": pa.list_(pa.int32()), "states": pa.int32()}
    types |= {"volume": pa.int64(), "base": pa.int64(), "bytes": pa.int64()}
    return pa.table({k: pa.array([v], types.get(k, pa.binary())) for k, v in (fixed | made).items()})


def transducers(words: DataFrame) -> DataFrame:
    """One row per volume of the vocabulary with its transducer."""
    return written(words.groupBy("volume").applyInArrow(build_volume, VOLUME), "transducers")


def passes(volumes: DataFrame) -> list[list[int]]:
    """Volumes by the pass they go along in; the driver sees two numbers per volume."""
    out, room = [], 0
    for row in volumes.select("volume", "bytes").orderBy("volume").toLocalIterator():
        if not out or row.bytes > room:
            out.append([])
            room = PASS_BYTES
        out[-1].append(row.volume)
        room -= row.bytes
    return out


def recounted(rows: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, source, ordinal, n): how often each source's texts hold each kept term of their language."""
    spark = rows.sparkSession
    volumes = transducers(words)
    counts = spark.createDataFrame([], "lang string, source string, ordinal long, n long")
    for members in passes(volumes):
        carried = [row.asDict() for row in volumes.where(F.col("volume").between(members[0], members[-1])).collect()]
        shared = spark.sparkContext.broadcast(carried)
        found = rows.mapInArrow(streamed(shared), counts.schema)
        summed = written(found.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "recounted")
        shared.destroy()
        counts = counts.unionByName(summed)
    return counts


def probability(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * terms)), exactly."""
    above = (n + F.lit(SMOOTH)).cast("decimal(27,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = F.greatest(total + F.lit(SMOOTH) * terms, F.lit(1)).cast("decimal(27,0)")
    return F.call_function("floor", F.call_function("div", above, below)).cast("long") + 1


def compare_block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Sums of absolute differences between the sources of two sides, over one block's terms."""
    _, _, left, right = (k.as_py() for k in key)
    index = table.column("index").to_numpy()
    ordinal = table.column("ordinal").to_pandas().to_numpy(np.float64, na_value=-1).astype(np.int64)
    value = table.column("p").to_numpy()
    marks = ordinal < 0
    width = int(table.column("terms").to_numpy()[marks].max(initial=0))
    members = np.unique(index[marks])
    zero = np.zeros(len(members), np.int64)
    zero[np.searchsorted(members, index[marks])] = value[marks]
    columns, column = np.unique(ordinal[~marks], return_inverse=True)
    # Terms that none of these sources holds are alike: one difference, as often as there are such terms.
    matrix = np.repeat(zero[:, None], len(columns), axis=1)
    matrix[np.searchsorted(members, index[~marks]), column] = value[~marks]
    unseen = width - len(columns)
    out = [[], [], []]
    for i in np.flatnonzero(members // SIDE == left):
        others = np.flatnonzero((members // SIDE == right) & (members > members[i]))
        sums = np.abs(matrix[others] - matrix[i]).sum(axis=1) + unseen * np.abs(zero[others] - zero[i])
        out[0].append(np.full(len(others), members[i]))
        out[1].append(members[others])
        out[2].append(sums)
    a, b, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
    return pa.table({"lang": pa.array([key[0].as_py()] * len(a), pa.string()), "a": pa.array(a), "b": pa.array(b), "value": pa.array(v)})


def pair_sums(counts: DataFrame, groups: DataFrame, blocks: DataFrame) -> DataFrame:
    """(lang, a, b, value): summed differences of every two sources of a language, by their indexes, a < b.

    ``counts``: lang, index, ordinal, p of the terms a source holds; ``groups``: lang, index, sides, zero
    (p of a term that the source lacks); ``blocks``: lang, block, terms.
    """
    marks = groups.join(blocks, "lang").select(
        "lang", "block", "index", "sides", F.lit(None).cast("long").alias("ordinal"), F.col("zero").alias("p"), "terms"
    )
    held = counts.select("lang", F.floor(F.col("ordinal") / BLOCK).alias("block"), "index", "sides", "ordinal", "p", F.lit(0).cast("long").alias("terms"))
    side = F.floor(F.col("index") / SIDE)
    met = marks.unionByName(held).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)).alias("_other")
    )
    dealt = met.select(
        "lang", "block", F.least(side, "_other").alias("left"), F.greatest(side, "_other").alias("right"), "index", "ordinal", "p", "terms"
    )
    parts = dealt.groupBy("lang", "block", "left", "right").applyInArrow(compare_block, "lang string, a long, b long, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Per (lang, source): its distance to every other source of the language, and its most typical terms.

    Columns lang, source, part, item, value, rank. Part ``pair``: item is the other source, value
    the summed difference of probabilities over the language's kept terms (0 without any), all ranks. Part ``term``: item
    is a kept term that the source uses more than its language, value the difference, the first ``top_terms``.
    Ranks from 1 by falling value, then item in UTF-8 order. Null text, lang and source are empty;
    rows that repeat are documents of their own; a source without terms has pairs only, the only source
    of a language has no pairs. Other columns are not looked at; an empty table gives no rows.
    """
    rows = plain_docs(docs)
    words = vocabulary(rows, least_docs)
    counts = written(recounted(rows, words), "counts")
    kept = words.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    found = rows.groupBy("lang", "source").agg(F.lit(1).alias("_one")).select("lang", "source")
    by_lang = Window.partitionBy("lang")
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        found.join(sums, ["lang", "source"], "left")
        .join(kept, "lang", "left")
        .select(
            "lang",
            "source",
            F.coalesce("total", F.lit(0)).alias("total"),
            F.coalesce("terms", F.lit(0)).alias("lang_terms"),
            (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long").alias("index"),
            F.ceil(F.count(F.lit(1)).over(by_lang) / SIDE).cast("long").alias("sides"),
        )
    )
    groups = written(groups.withColumn("zero", probability(F.lit(0).cast("long"), F.col("total"), F.col("lang_terms"))), "groups")
    figured = counts.join(groups, ["lang", "source"]).withColumn("p", probability(F.col("n"), F.col("total"), F.col("lang_terms")))
    # Blocks of ordinals, which may span languages; a language without kept terms has an empty one.
    some = words.groupBy("lang", F.floor(F.col("ordinal") / BLOCK).alias("block")).agg(F.count(F.lit(1)).alias("terms"))
    none = groups.where("lang_terms = 0").select("lang", F.lit(-1).cast("long").alias("block"), F.lit(0).cast("long").alias("terms")).distinct()
    sums = pair_sums(figured, groups, some.unionByName(none))
    named = groups.select("lang", "index", "source")
    both = (
        sums.select("lang", F.col("a").alias("index"), F.col("b").alias("other"), "value")
        .unionByName(sums.select("lang", F.col("b").alias("index"), F.col("a").alias("other"), "value"))
        .join(named, ["lang", "index"])
        .join(named.select("lang", F.col("index").alias("other"), F.col("source").alias("item")), ["lang", "other"])
    )
    by_group = Window.partitionBy("lang", "source")
    pairs = both.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_group.orderBy(F.desc("value"), "item")).alias("rank")
    )
    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n"))
    totals = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("lang_terms").alias("lang_terms"))
    expected = whole.join(totals, "lang").select("ordinal", probability(F.col("n"), F.col("total"), F.col("lang_terms")).alias("q"))
    more = figured.join(expected, "ordinal").where("p > q").select("lang", "source", "ordinal", (F.col("p") - F.col("q")).alias("value"))
    # Ordinals stand in for the terms' own order; only what is listed gets its term back.
    place = F.row_number().over(by_group.orderBy(F.desc("value"), "ordinal"))
    typical = more.withColumn("rank", place).where(F.col("rank") <= top_terms).join(words.select("ordinal", "term"), "ordinal")
    terms = typical.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(terms)
