"""Periodic runs of words, proposed by string synchronising sets.

A run is a maximal stretch of words with smallest period q, at least
``max(24, 3 * q)`` words long. How runs are found, per document and over several
documents of a batch at a time:

- Words become hashes; at each dyadic scale t, every stretch of t words has a hash
  of its content, made from two of the scale below.
- Runs of the smallest periods (up to 5) are the *highly periodic regions* that are
  detected directly, by comparing every word with the one q words on.
- From t = 4 on, a place is in the synchronising set of its scale if the least hash
  among the stretches that start at it and at the t places after it is that of the
  first or of the last. Stretches with a period of t / 3 or less, which are known
  from the runs found so far, take no part. So whether a place is in the set depends
  on the 2 * t words from it on only, and every t places hold one, save in the
  periodic regions.
- For a run with period q, scale t is the largest with 3 * t <= 2 * q + 1. One of its
  places i with i + q also has its context of 2 * t words inside the run, so i and
  i + q are in the set with equal contexts. Every pair of such places at a distance of
  that scale proposes a period; there are at most nine for a place, because equal
  contexts within t / 3 of each other are periodic and take no part.
- A proposal is extended to both sides by comparing hashes of halving sizes. What is
  long enough is compared word by word before it counts, and of equal stretches the
  smallest period stays.

No step compares all pairs of places, and there is no cap on places, periods or
lengths. Nothing is shuffled: a document is a row, read and answered by one task,
in batches of about ``BATCH_BYTES`` of text (a longer text is a batch of its own).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from monthfold.llm.common import own
from monthfold.llm.units import by_bytes, slices, text_bytes, word_spans

LEAST_WORDS = 24
LEAST_PERIODS = 3
SMALL = 5  # periods up to this are detected directly; the scales from FIRST_SCALE on hold the others
FIRST_SCALE = 4
BATCH_BYTES = 2_000_000

RESULT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(values: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers, one to one."""
    with np.errstate(over="ignore"):
        values = values + _MIX[0]
        values = (values ^ (values >> np.uint64(30))) * _MIX[1]
        values = (values ^ (values >> np.uint64(27))) * _MIX[2]
    return values ^ (values >> np.uint64(31))


class Contents:
    """Hashes of all stretches of 2^k words of several documents, end to end.

    A stretch that reaches beyond the end of all words has no place; one that
    crosses from a document to the next is kept out by its users.
    """

    def __init__(self, words: np.ndarray):
        self.levels = [mixed(words.astype(np.uint64))]

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            half = 1 << (len(self.levels) - 1)
            below = self.levels[-1]
            size = max(len(below) - half, 0)
            with np.errstate(over="ignore"):
                self.levels.append(mixed(below[:size] * _MIX[1] + (below[half:] ^ _MIX[0])))
        return self.levels[k]

    def equal(self, k: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        hashes = self.level(k)
        return hashes[left] == hashes[right]


def stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of true."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    return edges[0::2], edges[1::2]


def small_periods(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """(start, length, period) of all maximal stretches of three periods or more, periods up to ``SMALL``."""
    found = [np.zeros((0, 3), np.int64)]
    for q in range(1, SMALL + 1):
        if len(ids) <= q:
            break
        start, end = stretches((ids[q:] == ids[:-q]) & (doc[q:] == doc[:-q]))
        length = end - start + q
        long_enough = length >= LEAST_PERIODS * q
        found.append(np.stack([start, length, np.full(len(start), q)], axis=1)[long_enough])
    return smallest(np.concatenate(found))


def smallest(runs: np.ndarray) -> np.ndarray:
    """Of equal stretches the one with the smallest period, by start and length.

    A stretch of three of its periods that has a smaller one too is found with it:
    the smaller divides the larger, so their maximal stretches are the same.
    """
    if not len(runs):
        return runs
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def synchronising(hashes: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """Places of the synchronising set of scale t; ``periodic``: the stretches that take no part."""
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    open_ = np.where(periodic, top, hashes >> np.uint64(1))  # no hash is as large as what takes no part
    least, width = open_, 1
    while width * 2 <= t + 1:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    size = len(open_) - t
    if size <= 0:
        return np.zeros(0, np.int64)
    rest = t + 1 - width
    least = np.minimum(least[:size], least[rest : rest + size])
    return np.flatnonzero((least != top) & ((least == open_[:size]) | (least == open_[t : t + size])))


def periodic_places(runs: np.ndarray, t: int, size: int) -> np.ndarray:
    """Where stretches of t words with a period of t / 3 or less start, by the runs that hold them."""
    inside = runs[(runs[:, 2] * 3 <= t) & (runs[:, 1] >= t)]
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, np.minimum(inside[:, 0], size), 1)
    np.add.at(change, np.minimum(inside[:, 0] + inside[:, 1] - t + 1, size), -1)
    return np.cumsum(change[:-1]) > 0


def proposals(places: np.ndarray, contexts: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places with equal contexts whose distance belongs to scale t: 3t - 1 <= 2q < 6t - 1."""
    order = np.lexsort((places, contexts))
    places, contexts = places[order], contexts[order]
    left, right, step = [], [], 1
    near = np.arange(len(places))
    while len(near):
        near = near[near + step < len(places)]
        gap = places[near + step] - places[near]
        near, gap = (x[(contexts[near + step] == contexts[near]) & (2 * gap < 6 * t - 1)] for x in (near, gap))
        hit = near[2 * gap >= 3 * t - 1]
        left.append(places[hit])
        right.append(places[hit + step])
        step += 1
    return (np.concatenate(left), np.concatenate(right)) if left else (places[:0], places[:0])


def extended(contents: Contents, left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray, top: int) -> np.ndarray:
    """(start, length, period) of the maximal stretch around each pair of places of one document."""
    ahead, back = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
    for k in [top, *range(top, -1, -1)]:
        size = 1 << k
        fits = np.flatnonzero(right + ahead + size <= high)
        fits = fits[contents.equal(k, left[fits] + ahead[fits], right[fits] + ahead[fits])]
        ahead[fits] += size
        fits = np.flatnonzero(left - back - size >= low)
        fits = fits[contents.equal(k, left[fits] - back[fits] - size, right[fits] - back[fits] - size)]
        back[fits] += size
    return np.stack([left - back, right - left + ahead + back, right - left], axis=1)


def verified(ids: np.ndarray, doc: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """The runs that hold when compared word by word, and cannot be extended."""
    sound = np.ones(len(runs), bool)
    for i, (start, length, q) in enumerate(runs.tolist()):
        end = start + length
        before = start > 0 and doc[start - 1] == doc[start] and ids[start - 1] == ids[start - 1 + q]
        after = end < len(ids) and doc[end] == doc[start] and ids[end] == ids[end - q]
        sound[i] = not before and not after and np.array_equal(ids[start : end - q], ids[start + q : end])
    return runs[sound]


def find_runs(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """All runs (start, length, period) of the documents, places counted from the first word of all."""
    sizes = np.diff(bounds)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    runs = small_periods(ids, doc)
    wanted = runs[runs[:, 1] >= LEAST_WORDS]
    longest = int(sizes.max(initial=0))
    contents = Contents(ids)
    t = FIRST_SCALE
    # The shortest run of a scale's smallest period must fit into a document.
    while max(LEAST_WORDS, LEAST_PERIODS * (3 * t - 1) // 2) <= longest:
        k = t.bit_length() - 1
        contexts = contents.level(k + 1)
        hashes = contents.level(k)
        places = synchronising(hashes, t, periodic_places(runs, t, len(hashes)))
        places = places[places < len(contexts)]
        places = places[places + 2 * t <= bounds[1:][doc[places]]]
        left, right = proposals(places, mixed(contexts[places] ^ mixed(doc[places].astype(np.uint64))), t)
        same = doc[left] == doc[right]
        left, right = left[same], right[same]
        if len(left):
            found = extended(contents, left, right, bounds[doc[left]], bounds[doc[left] + 1], longest.bit_length() - 1)
            found = np.unique(found, axis=0)
            found = found[(found[:, 1] >= LEAST_PERIODS * found[:, 2]) & (found[:, 1] >= LEAST_WORDS)]
            found = verified(ids, doc, smallest(found))
            runs = smallest(np.concatenate([runs, found]))
            wanted = smallest(np.concatenate([wanted, found]))
        t *= 2
    return wanted


def may_repeat(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which documents hold any stretch of 16 words twice; in others no run of 24 words can be.

    A run is at least 24 words and three periods long, so its first 16 words, or
    more, stand in it again one period later.
    """
    sizes = np.diff(bounds)
    contents = Contents(ids)
    hashes = contents.level(4)
    doc = np.repeat(np.arange(len(sizes)), sizes)[: len(hashes)]
    inside = np.arange(len(hashes)) + 16 <= bounds[1:][doc]
    keys = mixed(hashes[inside] ^ mixed(doc[inside].astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    twice = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    out = np.zeros(len(sizes), bool)
    out[doc[inside][order[twice]]] = True
    return out


def coded_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Word ids, bounds of rows, and the words that the ids stand for."""
    data, edges = text_bytes(column)
    start, end, row = word_spans(data, edges)
    coded = slices(data, start, end).dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return ids, np.searchsorted(row, np.arange(len(edges))), coded.dictionary


def runs_of(ids: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Per document its runs, by start and period, places counted from its first word."""
    empty = np.zeros((0, 3), np.int64)
    out = [empty] * (len(bounds) - 1)
    docs = np.flatnonzero(may_repeat(ids, bounds))
    if not len(docs):
        return out
    sizes = np.diff(bounds)[docs]
    part = np.concatenate(([0], np.cumsum(sizes)))
    taken = np.concatenate([ids[bounds[d] : bounds[d + 1]] for d in docs])
    runs = find_runs(taken, part)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    at = np.searchsorted(part, runs[:, 0], "right") - 1
    for i in np.unique(at):
        own_runs = runs[at == i].copy()
        own_runs[:, 0] -= part[i]
        out[docs[i]] = own_runs
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay: all but those that a run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def find_in_batches(batches):
    """The rows of ``word_runs`` for Arrow batches of (doc_id, text)."""
    for batch in by_bytes(batches, BATCH_BYTES):
        ids, bounds, words = coded_words(batch.column("text"))
        found = runs_of(ids, bounds)
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        collapsed = []
        for i, runs in enumerate(found):
            if len(runs):
                own_ids = ids[bounds[i] : bounds[i + 1]]
                collapsed.append(b" ".join(words.take(pa.array(own_ids[kept_words(len(own_ids), runs)])).to_pylist()))
            else:
                collapsed.append(b" ".join((texts[i] or b"").split()))
        flat = np.concatenate(found)
        parts = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["start", "length", "period"])
        offsets = np.concatenate(([0], np.cumsum([len(runs) for runs in found]))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(np.diff(bounds), pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), parts),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "runs", "collapsed"],
        )


def word_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, its runs, and the text without their repeats.

    ``runs`` holds every run as (start, length, period) in words, by start and then
    period. ``collapsed`` is the words, joined by one space, without those that any
    run holds after its first period. Words are runs of anything but
    ``[\\x20\\x09-\\x0D]``. A null text is an empty one: no words, no runs. Rows with
    equal or null doc_ids are rows of their own; other columns are not looked at; an
    empty table gives no rows.
    """
    return own(docs, "doc_id", "text").mapInArrow(find_in_batches, RESULT)
