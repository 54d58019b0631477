"""Class-based n-gram scoring: exchange clustering, then class bigrams and emissions.

Units of clustering: every word with at least ``OWN_CLASS`` of all training tokens
(so at most 1 / OWN_CLASS words) is a unit; all other words are dealt to ``TAILS``
units by their last three bytes; the end of a text is a unit with a class of its
own. All counts are over the whole training corpus. Clustering needs, per unit, how
often each class stands before and after it: a table of units by classes, whose
size is fixed by these constants, summed over all tasks in each round. Units are
then exchanged one after the other, each to the class with the best likelihood.

A word's probability is P(class | class before) * P(unit | class) * P(word | unit),
smoothed so that it sums to one with one unknown word per tail unit.

Words with ``LISTED`` of all tokens (at most 1 / LISTED) go to all tasks with their
counts. The counts of all others are joined by the hash of the word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthfold.llm.common import own, whole_text, written
from monthfold.llm.units import by_bytes, slices, text_bytes, word_spans

OWN_CLASS = 2e-5
LISTED = 2e-6
TAILS = 2048
CLASSES = 64
ROUNDS = 5
SLAB = 512
FOLDS, HELD_OUT = 7, 2
UNIT_SMOOTHING = 0.5
CLASS_SMOOTHING = 5.0
#: Bytes of text that a task looks at together.
AT_ONCE = 8_000_000


def held_out():
    """Whether a text is kept from training: by the CRC of its id. A null id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def words_of(column):
    """Distinct words of a text column (A-Z lowered), the code of every word, its row, and the row count."""


    data, bounds = text_bytes(column)
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    start, end, row = word_spans(data, bounds)
    coded = slices(data, start, end).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), row, len(bounds) - 1


def tails(words):
    """The tail unit (from 0) of every word: by its last three bytes."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    body = np.frombuffer(words.buffers()[2], np.uint8) if len(words) and words.buffers()[2] else np.zeros(1, np.uint8)
    size, last = np.diff(offsets), offsets[1:]
    mixed = np.zeros(len(words), np.int64)
    for back in (1, 2, 3):
        mixed = mixed * 257 + np.where(size >= back, body[np.maximum(last - back, 0)], 0)
    return (mixed * 2654435761 % 4294967291) % TAILS


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over the training texts; ``docs`` has doc_id and text."""
    def run(batches):
        for batch in by_bytes(batches, AT_ONCE):
            words, codes, _, _ = words_of(batch.column("text"))
            n = np.bincount(codes, minlength=len(words))
            yield pa.RecordBatch.from_arrays([words.cast(pa.binary()), pa.array(n)], ["word", "n"])

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Totals of training, the listed words with their counts, and sizes of the tail units."""
    def __init__(self, counts: DataFrame, texts: int):
        totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).head()
        self.texts = texts
        self.tokens = int(totals.n or 0) + texts
        self.distinct = int(totals.v) + (1 if texts else 0)
        least = max(1, int(np.ceil(LISTED * self.tokens)))
        self.least = least
        # At most 1 / LISTED words have so large a share.
        listed = counts.where(F.col("n") >= least).toArrow()
        word, n = listed.column("word").to_pylist(), listed.column("n").to_pylist()
        order = sorted(range(len(word)), key=lambda i: (-n[i], word[i]))
        self.listed = [word[i] for i in order]
        self.counts = np.array([n[i] for i in order], np.int64)
        self.singles = int((self.counts >= max(1, OWN_CLASS * self.tokens)).sum())
        self.units = self.singles + TAILS + 1
        singles, mine = self.singles, pa.array(self.listed[: self.singles], pa.large_binary())

        def by_tail(batches):
            total, kinds = np.zeros(TAILS, np.int64), np.zeros(TAILS, np.int64)
            for batch in batches:
                words = batch.column("word").cast(pa.large_binary())
                rest = pc.is_null(pc.index_in(words, value_set=mine)).to_numpy(zero_copy_only=False) if singles else np.ones(len(words), bool)
                tail, n = tails(words)[rest], batch.column("n").to_numpy()[rest]
                total += np.bincount(tail, n, minlength=TAILS).astype(np.int64)
                kinds += np.bincount(tail, minlength=TAILS)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(TAILS)), pa.array(total), pa.array(kinds)], ["tail", "n", "kinds"])

        sums = counts.mapInArrow(by_tail, "tail long, n long, kinds long").groupBy("tail").agg(F.sum("n").alias("n"), F.sum("kinds").alias("kinds"))
        self.unit_counts = np.zeros(self.units, np.int64)
        self.unit_kinds = np.zeros(self.units, np.int64)
        self.unit_counts[: self.singles] = self.counts[: self.singles]
        self.unit_counts[-1] = texts
        for r in sums.collect():
            self.unit_counts[self.singles + r.tail] = r.n
            self.unit_kinds[self.singles + r.tail] = r.kinds


def lookup(words, listed, singles: int):
    """Place in the list of every word (-1: not listed) and its unit."""
    if len(listed) == 0:
        place = np.full(len(words), -1)
    else:
        place = pc.fill_null(pc.index_in(words, value_set=listed), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    single = (place >= 0) & (place < singles)
    return place, np.where(single, place, singles + tails(words))


def unit_texts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The unit of every token of the training texts, as 16-bit numbers; each text ends with the end's unit."""
    listed, singles, end = pa.array(vocabulary.listed, pa.large_binary()), vocabulary.singles, vocabulary.units - 1

    def run(batches):
        for batch in by_bytes(batches, AT_ONCE):
            words, codes, row, rows = words_of(batch.column("text"))
            _, unit = lookup(words, listed, singles)
            body = np.full(len(codes) + rows, end, np.uint16)
            body[np.arange(len(codes)) + row] = unit[codes]
            sizes = (np.bincount(row, minlength=rows) + 1) * 2
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(body)])], ["units"])

    return docs.select("text").mapInArrow(run, "units binary")


def neighbours(units: DataFrame, classes, number: int):
    """Per unit, how often each class follows and precedes it, and how often the unit itself follows.

    Tasks count into slabs of units; slabs meet by number and are added up as they
    arrive. What reaches the driver is units by classes, whatever the corpus.
    """
    size = len(classes)
    end = size - 1

    def count(batches):
        after, before, twice = np.zeros(size * number, np.int64), np.zeros(size * number, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            column = batch.column("units")
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
            if len(column) == 0:
                continue
            stream = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.uint16).astype(np.int64)
            left = np.concatenate([[end], stream[:-1]])
            after += np.bincount(left * number + classes[stream], minlength=size * number)
            before += np.bincount(stream * number + classes[left], minlength=size * number)
            twice += np.bincount(stream[left == stream], minlength=size)
        table = np.concatenate([after.reshape(size, number), before.reshape(size, number), twice[:, None]], axis=1)
        for slab in range(-(-size // SLAB)):
            part = table[slab * SLAB : (slab + 1) * SLAB]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["slab", "body"])

    def add(batches):
        sums: dict = {}
        for batch in batches:
            for slab, body in zip(batch.column("slab").to_pylist(), batch.column("body"), strict=True):
                part = np.frombuffer(body.as_buffer(), np.int64)
                sums[slab] = sums[slab] + part if slab in sums else part
        for slab, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["slab", "body"])

    parts = units.mapInArrow(count, "slab int, body binary")
    table = np.zeros((size, 2 * number + 1), np.int64)
    for r in parts.repartition("slab").mapInArrow(add, "slab int, body binary").toArrow().to_pylist():
        part = np.frombuffer(r["body"], np.int64).reshape(-1, 2 * number + 1)
        table[r["slab"] * SLAB : r["slab"] * SLAB + len(part)] = part
    return table[:, :number], table[:, number : 2 * number], table[:, -1]


def class_counts(after, classes, number: int):
    """How often class j follows class i."""
    table = np.zeros((number, number), np.int64)
    np.add.at(table, classes, after)
    return table


def exchange(after, before, twice, classes, number: int):
    """One sweep: every unit but the end moves to the class that raises the likelihood most.

    Counts between classes follow every move; the classes of a unit's neighbours
    are those of the start of the sweep.
    """
    def h(x):
        return x * np.log(np.maximum(x, 1))

    classes = classes.copy()
    pairs = class_counts(after, classes, number).astype(np.float64)
    last = number - 1  # the end's class takes no other unit
    free = np.arange(last)
    weight = after.sum(1)
    for u in np.argsort(-weight, kind="stable"):
        if weight[u] == 0 or u == len(classes) - 1:
            continue
        a, own = classes[u], float(twice[u])
        out, into = after[u].astype(np.float64), before[u].astype(np.float64)
        pairs[a] -= out
        pairs[:, a] -= into
        pairs[a, a] += own
        out[a] -= own
        into[a] -= own
        rows, columns = pairs.sum(1), pairs.sum(0)
        base = h(pairs)
        gain = (h(pairs[free] + out) - base[free]).sum(1) + (h(pairs[:, free] + into[:, None]) - base[:, free]).sum(0)
        corner = pairs[free, free]
        gain += h(corner + out[free] + into[free] + own) - h(corner + out[free]) - h(corner + into[free]) + h(corner)
        size = out.sum() + own
        gain -= h(rows[free] + size) - h(rows[free]) + h(columns[free] + size) - h(columns[free])
        b = int(np.argmax(gain)) if gain.max() > gain[a] + 1e-9 else a
        classes[u] = b
        # Put in with its neighbours as they were; those that moved are met in the next round.
        pairs[b] += out
        pairs[:, b] += into
        pairs[b, b] += own
        np.maximum(pairs, 0, out=pairs)
    return classes


class Model:
    """Log10 probabilities by unit and by class pair."""
    def __init__(self, vocabulary: Vocabulary, classes, pairs):
        number = len(pairs)
        size = np.bincount(classes, vocabulary.unit_counts, minlength=number)
        members = np.bincount(classes, minlength=number)
        share = (vocabulary.unit_counts + UNIT_SMOOTHING) / (size + UNIT_SMOOTHING * members)[classes]
        overall = (size + 1) / (size.sum() + number)
        self.classes = classes
        self.step = np.log10((pairs + CLASS_SMOOTHING * overall) / (pairs.sum(1, keepdims=True) + CLASS_SMOOTHING))
        self.emit = np.log10(share)
        # P(word | tail unit) is (count + 1) / (tokens + kinds + 1); the count comes with the word.
        tail = slice(vocabulary.singles, vocabulary.units - 1)
        self.emit[tail] -= np.log10(vocabulary.unit_counts[tail] + vocabulary.unit_kinds[tail] + 1)


def train(docs: DataFrame, rounds: int = ROUNDS, number: int = CLASSES) -> tuple[Vocabulary, Model, DataFrame]:
    """Vocabulary, model and the table of word counts, from training texts (doc_id, text)."""
    counts = written(count_words(docs), "words")
    vocabulary = Vocabulary(counts, docs.count())
    units = written(unit_texts(docs, vocabulary), "units")
    number += 1
    classes = np.arange(vocabulary.units) % (number - 1)
    classes[-1] = number - 1
    for _ in range(rounds):
        classes = exchange(*neighbours(units, classes, number), classes, number)
    after, _, _ = neighbours(units, classes, number)
    return vocabulary, Model(vocabulary, classes, class_counts(after, classes, number)), counts


def score_texts(docs: DataFrame, vocabulary: Vocabulary, model: Model, counts: DataFrame) -> DataFrame:
    """Scores of every text of ``docs`` (doc_id, text)."""
    listed = pa.array(vocabulary.listed, pa.large_binary())
    singles, end = vocabulary.singles, vocabulary.units - 1
    classes, step, emit, tokens, texts = model.classes, model.step, model.emit, vocabulary.tokens, vocabulary.texts
    listed_counts = np.append(vocabulary.counts, 0)
    schema = "row long, doc_id long, tokens long, known long, base double, score double, word binary, n long"

    def run(batches):
        serial = TaskContext.get().partitionId() << 40
        for batch in by_bytes(batches, AT_ONCE):
            words, codes, row, rows = words_of(batch.column("text"))
            place, unit_of = lookup(words, listed, singles)
            count = listed_counts[place]
            gain = np.log10(count + 1.0)
            unit = unit_of[codes]
            last = np.roll(unit, 1)
            last[np.flatnonzero(np.diff(row, prepend=-1))] = end
            # A listed word in a tail unit adds its own count here, an unlisted one after the join.
            own_count = np.where(unit_of >= singles, gain, 0.0)
            value = step[classes[last], classes[unit]] + emit[unit] + own_count[codes]
            sizes = np.bincount(row, minlength=rows)
            total = np.bincount(row, value, minlength=rows).astype(np.float64)
            final = np.full(rows, end)
            ends = np.cumsum(sizes) - 1
            final[sizes > 0] = unit[ends[sizes > 0]]
            total += step[classes[final], classes[end]] + emit[end]
            base = np.bincount(row, gain[codes], minlength=rows).astype(np.float64) + np.log10(texts + 1.0)
            known = np.bincount(row, count[codes] > 0, minlength=rows).astype(np.int64) + (texts > 0)
            ids = serial + np.arange(rows)
            serial += rows
            nothing = pa.nulls(rows, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), batch.column("doc_id"), pa.array(sizes + 1), pa.array(known), pa.array(base), pa.array(total), nothing, pa.array(np.zeros(rows, np.int64))],
                schema=fields,
            )
            rare = place[codes] < 0
            pair, n = np.unique(row[rare] * max(len(words), 1) + codes[rare], return_counts=True)
            whose, which = np.divmod(pair, max(len(words), 1))
            for at in range(0, len(pair), 500_000):
                some = slice(at, at + 500_000)
                zeros, m = np.zeros(len(pair[some]), np.int64), len(pair[some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[whose[some]]), pa.nulls(m, pa.int64()), pa.array(zeros), pa.array(zeros), pa.array(zeros * 0.0), pa.array(zeros * 0.0),
                     words.take(pa.array(which[some])).cast(pa.binary()), pa.array(n[some])],
                    schema=fields,
                )

    kinds = {"long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    fields = pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])
    rows = docs.select("doc_id", "text").mapInArrow(run, schema)
    # Rows of whole texts have no word; they are dealt by number and meet nothing.
    is_word = F.col("word").isNotNull()
    key = F.when(is_word, F.xxhash64("word")).otherwise(F.xxhash64("row"))
    parts = rows.withColumns({"key": key, "is_word": is_word}).drop("word")
    rest = counts.where(F.col("n") < vocabulary.least).select(F.xxhash64("word").alias("word_key"), F.col("n").alias("c"))
    met = parts.join(rest.hint("merge"), (F.col("key") == F.col("word_key")) & F.col("is_word"), "left")
    c = F.coalesce(F.col("c"), F.lit(0))
    log = F.col("n") * F.log10(c + 1.0)
    sums = met.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(c > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + log).alias("base"),
        F.sum(F.col("score") + log).alias("score"),
    )
    unit = float(np.log10(tokens + vocabulary.distinct + 1.0))
    return sums.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * unit).alias("base_score"),
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def score_documents(docs: DataFrame, rounds: int = ROUNDS, number: int = CLASSES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): log10 probability of its text and of its words alone.

    Learns from the rows that are not held out, scores all. A null text is the empty
    text: one token, the end. Rows that repeat are scored each; a null doc_id is no
    held-out row. Without training texts every word is unknown and classes have no
    counts. An empty table gives no rows. Other columns are not looked at.
    """
    rows = own(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    vocabulary, model, counts = train(rows.where(~held_out()), rounds, number)
    return score_texts(rows, vocabulary, model, counts)
