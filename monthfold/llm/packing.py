"""Best-fit packing of tokenised documents into sequences of fixed length.

Planned over the histogram of piece lengths, not over pieces: at most ``most``
lengths, whatever the corpus. Best fit, longest first, is done on counts: all
pieces of a length go into the open sequences with the least room that holds
them, many sequences at a time. The plan says for every stretch of ranks of a
length which sequences and which offset they get. Pieces then find their place
by joining on their rank within their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthfold.llm.common import numbered, own, whole_text, written
from monthfold.llm.units import WIDE_SPACES, is_space, row_groups, spread, text_bytes, trimmed

MOST = 2048
END = 0
PIECES = "doc_id long, piece int, start long, length long, ids binary"
PLAN = "plan_length long, first_rank long, last_rank long, first_sequence long, offset long"
#: Bytes of text that a task tokenises at a time.
AT_ONCE = 4_000_000
#: Different units whose ids a Python worker remembers.
REMEMBERED = 1_000_000
#: Units that are encoded as one text.
JOINED = 256


def tokenise(docs: DataFrame, tokenizer_path: str, most: int = MOST, end: int = END) -> DataFrame:
    """Pieces of every document of ``docs`` (doc_id, text): doc_id, piece, start, length, ids.

    ``ids``: the piece's token ids as little-endian unsigned 32-bit numbers; the
    document's last id is ``end``. A document of more than ``most`` ids is cut
    into pieces of ``most``, of which the first may be shorter. A null or empty
    text is the end id alone. Rows that repeat are separate documents.

    A text is cut before each white space that follows another character: no
    token spans such a cut, so equal units have equal ids and are encoded once.
    Encoding is the tokenizer's plain one, in which the text of a special token is that token.
    """

    def run(batches: Iterator) -> Iterator:
        tokenizer, known = remembered(tokenizer_path)
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            ids = batch.column("doc_id")
            for low, high in row_groups(np.diff(bounds), AT_ONCE):
                part = data[bounds[low] : bounds[high]]
                tokens, ends = encode(part, bounds[low : high + 1] - bounds[low], tokenizer, known, end)
                row, piece, start, size = cut(np.diff(ends), most)
                at = ends[row] + start
                offsets = np.zeros(len(row) + 1, np.int32)
                np.cumsum(size * 4, out=offsets[1:])
                body = pa.Array.from_buffers(
                    pa.binary(), len(row), [None, pa.py_buffer(offsets), pa.py_buffer(tokens[at[0] :] if len(row) else tokens)]
                )
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(low, high - low).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(size), body],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    rows = own(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(trimmed(run), PIECES)


def remembered(path: str):
    """The tokenizer of a file and the units that this Python worker has met with it, over all its tasks."""
    if path not in WORKER:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        WORKER.clear()
        tokenizer = Tokenizer.from_file(path)
        WORKER[path] = tokenizer, Known(tokenizer)
    return WORKER[path]


WORKER: dict = {}


class Known:
    """Units met so far, at most ``REMEMBERED`` and those of one call, with their token ids end to end."""

    def __init__(self, tokenizer):
        self.forget()
        # How many bytes of text a token stands for: byte-level tokens have a character for each.
        added = {i: len(t.content.encode()) for i, t in tokenizer.get_added_tokens_decoder().items()}
        vocabulary = tokenizer.get_vocab()
        self.token_bytes = np.zeros(max([*vocabulary.values(), *added], default=0) + 1, np.int64)
        self.token_bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        for i, size in added.items():
            self.token_bytes[i] = size

    def forget(self) -> None:
        self.units = pa.array([], pa.large_binary())
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def places(self, units: pa.Array, tokenizer) -> np.ndarray:
        """The place of each of the different units; those not met before are encoded."""
        if len(self.units) + len(units) > REMEMBERED:
            self.forget()
        place = pc.index_in(units, value_set=self.units)
        fresh = units.filter(pc.is_null(place))
        first = len(self.units)
        if len(fresh):
            ids, widths = encode_units(fresh, tokenizer, self.token_bytes)
            self.units = pa.concat_arrays([self.units, fresh])
            self.ids = np.concatenate([self.ids, ids])
            self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(widths))
        out = place.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        out[out < 0] = np.arange(first, first + len(fresh))
        return out


def encode_units(units: pa.Array, tokenizer, token_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the units end to end, and how many each has.

    Units are encoded many at a time, as texts in which every unit starts at a cut, so that no
    token spans two. Tokens are told apart by the bytes they stand for; where a tokenizer's
    do not add up to the text, units are encoded one by one.
    """
    batch = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)

    def ids_of(texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in batch([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]

    data, bounds = text_bytes(units)
    starts, _ = unit_starts(data, np.array([0, len(data)], np.int64))
    joins = np.isin(bounds[:-1], starts)
    alone = np.flatnonzero(~joins)
    cuts = np.unique(np.concatenate([[0, len(units)], alone, np.arange(0, len(units), JOINED)]))
    raw = data.tobytes()
    found = ids_of([raw[bounds[a] : bounds[b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    ids = np.fromiter(chain.from_iterable(found), np.uint32)
    ends = np.cumsum(token_bytes[ids])
    last = np.searchsorted(ends, bounds[1:])
    if len(ids) and ends[-1] == len(data) and (ends[last] == bounds[1:]).all():
        return ids, np.diff(np.concatenate([[-1], last]))
    found = ids_of([raw[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
    return np.fromiter(chain.from_iterable(found), np.uint32), np.array([len(f) for f in found], np.int64)


def encode(data, bounds, tokenizer, known: Known, end: int):
    """Ids of all rows end to end (unsigned 32-bit), each row followed by ``end``; bounds by row."""
    start, row = unit_starts(data, bounds)
    if len(start) == 0:
        return np.full(len(bounds) - 1, end, np.uint32), np.arange(len(bounds), dtype=np.int64)
    offsets = np.append(start, len(data)).astype(np.int64)
    array = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    coded = array.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    place = known.places(coded.dictionary, tokenizer)
    at, width = known.ends[place], known.ends[place + 1] - known.ends[place]
    pool = known.ids
    # Every row's units, then its end: the end is one more unit with one id.
    pool = np.append(pool, np.uint32(end))
    rows = len(bounds) - 1
    per_row = np.bincount(row, minlength=rows)
    place = np.arange(len(codes)) + row
    all_at = np.full(len(codes) + rows, len(pool) - 1, np.int64)
    all_width = np.ones(len(codes) + rows, np.int64)
    all_at[place] = at[codes]
    all_width[place] = width[codes]
    tokens = pool[spread(all_at, all_width)]
    lengths = np.add.reduceat(all_width, np.cumsum(per_row + 1) - (per_row + 1))
    ends = np.zeros(rows + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    return tokens, ends


def unit_starts(data, bounds):
    """Where units start, and their rows: at rows, and before white space that
    follows a character which is certainly none."""


    cuts = np.zeros(len(data), bool)
    space = is_space(data)
    cuts[1:] = space[1:] & (data[:-1] > 0x20)
    wide = np.flatnonzero(cuts[1:] & (data[:-1] >= 0x80)) + 1
    if len(wide):
        last = data[wide - 1].astype(np.int32)
        second = data[np.maximum(wide - 2, 0)].astype(np.int32)
        third = data[np.maximum(wide - 3, 0)].astype(np.int32)
        doubt = (third == 0xE2) & (second == 0x80) & (last <= 0x8A)
        for mark in WIDE_SPACES:
            hit = (last == mark[-1]) & (second == mark[-2])
            doubt |= hit if len(mark) == 2 else hit & (third == mark[0])
        cuts[wide[doubt]] = False
    full = bounds[:-1][np.diff(bounds) > 0]
    cuts[full] = True
    start = np.flatnonzero(cuts)
    return start, np.searchsorted(bounds, start, "right") - 1


def cut(lengths, most: int):
    """Row, number, start and length of the pieces of rows of these lengths."""
    count = -(-lengths // most)
    row = np.repeat(np.arange(len(lengths)), count)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = lengths - (count - 1) * most
    start = np.where(piece == 0, 0, first[row] + (piece - 1) * most)
    size = np.where(piece == 0, first[row], most)
    return row, piece, start.astype(np.int64), size.astype(np.int64)


def best_fit(counts: dict[int, int], most: int = MOST) -> list[tuple[int, int, int, int, int]]:
    """Plan for so many pieces of each length: (length, first rank, last rank, first sequence, offset).

    Ranks first..last of the length go to sequences first_sequence.. in turn, all
    at the same offset. Longest first, each into the least room that holds it.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> runs of sequences (first, number)
    opened, plan = 0, []

    def place(length, rank, first, number, left):
        plan.append((length, rank, rank + number - 1, first, most - left))
        if left > length:
            room.setdefault(left - length, []).append((first, number))

    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            # Least room first, looked up anew: a run just filled may be the next best.
            left = min((r for r, runs in room.items() if r >= length and runs), default=None)
            if left is None:
                # As many new sequences as these pieces fill when put in one after the other.
                deep = most // length
                number = max(1, todo // deep)
                room.setdefault(most, []).append((opened, number))
                opened += number
                left = most
            first, number = room[left].pop()
            used = min(number, todo)
            if used < number:
                room[left].append((first + used, number - used))
            place(length, rank, first, used, left)
            rank += used
            todo -= used
    return plan


def pack(pieces: DataFrame, most: int = MOST) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset.

    Lengths must be 1 to ``most``. The histogram has at most ``most`` rows and is
    the only thing the driver sees; ranks within a length are counted in slices,
    so a length that a third of all pieces have is not one task. Equal rows are
    separate pieces. No pieces: no rows.
    """
    spark = pieces.sparkSession
    # A number of its own lets equal rows, and rows without doc_id, fall into different slices.
    pieces = written(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(best_fit(counts, most), PLAN)
    placed = numbered(pieces, ["length"], [F.col("doc_id"), F.col("piece"), F.col("_row")])
    fits = (F.col("length") == F.col("plan_length")) & F.col("rank").between(F.col("first_rank"), F.col("last_rank"))
    # At most a few plan rows for each of the ``most`` lengths, so small enough for all tasks.
    return (
        placed.join(F.broadcast(plan), fits)
        .withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("first_rank"))
        .drop("rank", "_row", *plan.columns[:4])
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, most: int = MOST, end: int = END) -> DataFrame:
    """Per piece of ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = tokenise(docs, tokenizer_path, most, end).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces, most)
