"""Repeated passages by a sparse suffix array.

A byte is removed if a ``LENGTH``-byte string covers it that also starts earlier. Any
two equal strings of that length hold the same least ``GRAM``-byte gram (by hash) at
the same place, so it is enough to sort the suffixes that start at such grams:

1. Tasks find these anchors and count the grams. Grams seen once are dropped.
2. The remaining anchors meet their texts. An anchor stands for the strings whose
   least gram it is: a run of starts, one stretch of bytes. Equal stretches of a
   task are one; all but its first are repeats already.
3. Stretches are dealt to ranges of their leading bytes, with splitters taken from a
   sample of texts. In a range the strings are sorted by multikey quicksort (eight
   bytes at a time, only within runs still equal), and all but the first of a run
   are repeats. A gram never straddles two ranges. Grams that occur ``HOT`` times or
   more would, so their strings are dealt by the hash of the whole string and
   compared there.
4. Repeats are joined to the texts, and what is left of each is given.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthfold.llm.common import own, whole_text
from monthfold.llm.units import by_bytes, row_groups, slices, spread, text_bytes, trimmed

LENGTH = 100
GRAM = 20
HOT = 1000
RANGES = 4096
SAMPLE = 500
LAST = 2**63 - 1
#: Bytes of text that a task looks at together, and among which equal stretches are found at once.
AT_ONCE = 1_000_000
TOGETHER = 16_000_000
#: Strings of hot grams that are hashed and sorted at a time.
STRINGS = 500_000
#: Counts share a number with positions, below this bound; the bound itself means hot.
COUNTS = 1024
KNOWN = COUNTS - 1


def mixed(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_at(data):
    """Eight bytes from every position, as little-endian numbers; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", padded, 0, (1,))


def hash_of(words, at, size: int, seed: int):
    """64-bit hashes of the ``size`` bytes from each position of ``at`` (an index into ``words``)."""
    total = np.full(len(at), seed, np.uint64)
    for offset in [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]:
        total = (total ^ (total >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + words[at + offset]
    return mixed(total)


def sliding(x, width: int, least):
    """least(x[i : i + width]) for every i."""
    step, y = 1, x
    while step * 2 <= width:
        y = least(y[:-step], y[step:])
        step *= 2
    rest = width - step
    return least(y[:-rest], y[rest:]) if rest else y


def anchors(data, bounds, length: int, gram: int):
    """Positions and gram hashes of all grams that are the least of some string of the length."""
    n = len(data) - gram + 1
    width = length - gram + 1
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = words_at(data)
    hashed = hash_of(words, np.arange(n), gram, 1)
    # Strings of the length that lie within one text; the others rule nothing.
    least = sliding(hashed, width, np.minimum)
    row = np.searchsorted(bounds, np.arange(len(least)), "right") - 1
    within = np.arange(len(least)) + length <= bounds[row + 1]
    least = np.where(within, least, np.uint64(0))
    # A gram is an anchor if it is the least of some string: the largest minimum around it.
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    found = np.flatnonzero((sliding(around, width, np.maximum) == hashed) & (hashed > 0))
    return found, hashed[found]


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, doc, info) per anchor: key its gram, info its position * COUNTS and how often the gram is met here.

    Of a gram that one task's rows hold ``HOT`` times or more, one row goes under
    the gram with that count; the others are known to be hot and go under
    keys of their own.
    """

    def run(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            doc = batch.column("doc").to_numpy()
            places, grams, owners = [], [], []
            for low, high in row_groups(np.diff(bounds), AT_ONCE):
                inner = bounds[low : high + 1] - bounds[low]
                found, hashed = anchors(data[bounds[low] : bounds[high]], inner, length, gram)
                row = np.searchsorted(inner, found, "right") - 1
                places.append(found - inner[row])
                grams.append(hashed)
                owners.append(row + low)
            if not places:
                continue
            place, key, row = np.concatenate(places), np.concatenate(grams).view(np.int64), np.concatenate(owners)
            order = np.argsort(key, kind="stable")
            place, key, row = place[order], key[order], row[order]
            head = np.flatnonzero(np.diff(key, prepend=key[:1] - 1 if len(key) else 0) != 0) if len(key) else np.zeros(0, np.int64)
            size = np.diff(np.append(head, len(key)))
            many = np.repeat(size >= HOT, size)
            count = np.where(many, KNOWN, 1)
            count[head[size >= HOT]] = HOT
            free = count == KNOWN
            key = np.where(free, mixed((doc[row] * 1_000_003 + place).astype(np.uint64)).view(np.int64), key)
            # In the order of the texts: neighbouring rows differ in few bytes, which the shuffle packs well.
            order = np.lexsort((place, row))
            key, row, place, count = key[order], row[order], place[order], count[order]
            for at in range(0, len(key), 1_000_000):
                part = slice(at, at + 1_000_000)
                yield pa.RecordBatch.from_arrays([pa.array(key[part]), pa.array(doc[row[part]]), pa.array(place[part] * COUNTS + count[part])], ["key", "doc", "info"])

    return docs.mapInArrow(trimmed(run), "key long, doc long, info long")


def owned(place, row, hashed, sizes, length: int, gram: int):
    """First and last start of the strings whose least gram (leftmost of equals) each anchor is."""
    reach = length - gram
    low = np.maximum(place - reach, 0)
    high = np.minimum(place, sizes[row] - length)
    for way in (1, -1):
        open_rows = np.arange(len(place))
        for k in range(1, reach + 1):
            other = open_rows - way * k
            fits = (other >= 0) & (other < len(place))
            open_rows, other = open_rows[fits], other[fits]
            gap = (place[open_rows] - place[other]) * way
            fits = (row[open_rows] == row[other]) & (gap <= reach)
            open_rows, other = open_rows[fits], other[fits]
            if len(open_rows) == 0:
                break
            beats = hashed[other] <= hashed[open_rows] if way == 1 else hashed[other] < hashed[open_rows]
            hit, by = open_rows[beats], other[beats]
            if way == 1:
                low[hit] = np.maximum(low[hit], place[by] + 1)
            else:
                high[hit] = np.minimum(high[hit], place[by] - reach - 1)
            open_rows = open_rows[~beats]
    return low, high


def merged(row, begin, end):
    """Joined runs of overlapping or touching spans, by row."""
    order = np.lexsort((begin, row))
    row, begin, end = row[order], begin[order], end[order]
    if len(row) == 0:
        return row, begin, end
    # Running ends by row: rows are set apart far enough for one running maximum.
    apart = row.astype(np.int64) * (int(end.max()) + 1)
    far = np.maximum.accumulate(end + apart)
    fresh = np.append(True, (begin + apart)[1:] > far[:-1])
    head = np.flatnonzero(fresh)
    return row[head], begin[head], (np.append(far[head[1:] - 1], far[-1]) - apart[head])


PARTS = "range int, key long, doc long, begin long, anchor int, last int, body binary"
FIELDS = pa.schema(
    [("range", pa.int32()), ("key", pa.int64()), ("doc", pa.int64()), ("begin", pa.int64()),
     ("anchor", pa.int32()), ("last", pa.int32()), ("body", pa.binary())]
)
#: What ``anchor`` says of rows that are no stretch: a repeat already, a single string by its hash.
REPEAT, STRING = -1, -2


def stretches(met: DataFrame, splitters, length: int, gram: int) -> DataFrame:
    """Stretches, strings of hot grams and repeats known at once, from (doc, text, places).

    ``places``: position * 2, plus 1 if the gram is hot.
    """

    def part(kind, range_, key, doc, begin, anchor, last, body):
        n = len(doc)
        arrays = [range_, key, doc, begin, np.full(n, kind) if anchor is None else anchor, last]
        types = [f.type for f in FIELDS][:6]
        return pa.RecordBatch.from_arrays([*[pa.array(a).cast(t) for a, t in zip(arrays, types, strict=True)], pa.nulls(n, pa.binary()) if body is None else body], schema=FIELDS)

    def first_strings(one, two, r, b, names):
        """Of strings in the order of their places, the first of each run of equal ones, and the places of the others."""
        order = np.argsort(one, kind="stable")
        fresh = np.append(True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1]))
        head = np.flatnonzero(fresh)
        by = order[np.repeat(head, np.diff(np.append(head, len(order))))]
        again = ~fresh & ((names[r[order]] != names[r[by]]) | (b[order] != b[by]))
        kept, gone = np.sort(order[head]), order[again]
        return [x[kept] for x in (one, two, r, b)], (r[gone], b[gone])

    def repeated(names, r, b):
        r, b, e = merged(r, b, b + length)
        return part(REPEAT, names[r] % RANGES, names[r], names[r], b, None, e - b, None)

    def run(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            doc = batch.column("doc").to_numpy()
            lists = batch.column("places")
            ends = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy()
            for low, high in row_groups(np.diff(bounds), TOGETHER):
                inner = bounds[low : high + 1] - bounds[low]
                text = data[bounds[low] : bounds[high]]
                own_values = values[ends[low] : ends[high]]
                row = np.repeat(np.arange(high - low), np.diff(ends[low : high + 1]))
                place, hot = own_values >> 1, (own_values & 1).astype(bool)
                order = np.lexsort((place, row))
                place, hot, row = place[order], hot[order], row[order]
                sizes = np.diff(inner)
                # Rows that share a doc_id share positions, which a shorter text may not have.
                sound = place + gram <= sizes[row]
                sound[1:] &= (place[1:] != place[:-1]) | (row[1:] != row[:-1])
                place, hot, row = place[sound], hot[sound], row[sound]
                words = words_at(text)
                hashed = hash_of(words, inner[row] + place, gram, 1)
                first, last = owned(place, row, hashed, sizes, length, gram)
                used = first <= last
                place, hot, row, hashed, first, last = (a[used] for a in (place, hot, row, hashed, first, last))
                if len(place) == 0:
                    continue
                names = doc[low:high]
                order = np.lexsort((first, names[row]))
                place, hot, row, hashed, first, last = (a[order] for a in (place, hot, row, hashed, first, last))
                start, end = inner[row] + first, inner[row] + last + length
                bodies = slices(text, start, end)
                same = bodies.dictionary_encode().indices.to_numpy().astype(np.int64) * (length + 1) + (place - first)
                _, lead, code = np.unique(same, return_index=True, return_inverse=True)
                head = lead[code]
                fresh = head == np.arange(len(same))
                again = ~fresh & ((names[row] != names[row[head]]) | (first != first[head]))
                r, b, e = merged(row[again], first[again], last[again] + length)
                if len(r):
                    yield part(REPEAT, names[r] % RANGES, names[r], names[r], b, None, e - b, None)
                whole = np.flatnonzero(fresh & ~hot)
                if len(whole):
                    leading = words[start[whole] + place[whole] - first[whole]].byteswap()
                    yield part(
                        0, np.searchsorted(splitters, leading, "right"), hashed[whole].view(np.int64), names[row[whole]],
                        first[whole], place[whole] - first[whole], last[whole] - first[whole], bodies.take(pa.array(whole)).cast(pa.binary()),
                    )
                single = np.flatnonzero(fresh & hot)
                if len(single):
                    # Of equal strings only the first goes on: among a part of them, then among what the parts leave.
                    firsts = [np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64)]
                    for low_row, high_row in row_groups(last[single] - first[single] + 1, STRINGS):
                        some = single[low_row:high_row]
                        count = last[some] - first[some] + 1
                        at = spread(start[some], count)
                        r = row[np.repeat(some, count)]
                        b = at - inner[r]
                        one, two = hash_of(words, at, length, 2), hash_of(words, at, length, 3)
                        (one, two, r, b), again = first_strings(one, two, r, b, names)
                        if len(again[0]):
                            yield repeated(names, *again)
                        firsts = [np.append(x, y) for x, y in zip(firsts, (one, two, r, b), strict=True)]
                    (one, two, r, b), again = first_strings(*firsts, names)
                    if len(again[0]):
                        yield repeated(names, *again)
                    # Told apart by 95 bits: the key and what else fits into the column of sizes.
                    yield part(
                        STRING, (one % np.uint64(RANGES)).astype(np.int64), one.view(np.int64),
                        names[r], b, None, (two >> np.uint64(33)).astype(np.int64), None,
                    )

    return met.mapInArrow(trimmed(run), PARTS)


def equal_runs(body, start, group, length: int):
    """Multikey quicksort of the strings from ``start``: which are equal to another of their group.

    Gives the strings (indexes) in order and a number for each run of equal ones.
    Strings alone in their group or run are sorted for good; of the others only runs
    whose next eight bytes differ are sorted by them.
    """
    words = words_at(body)
    index = np.flatnonzero(np.bincount(group, minlength=1)[group] > 1)
    index = index[np.argsort(group[index], kind="stable")]
    group = group[index]
    for offset in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        if len(index) == 0:
            break
        fresh = np.append(True, group[1:] != group[:-1])
        run = np.cumsum(fresh) - 1
        key = words[start[index] + offset]
        differs = np.zeros(run[-1] + 1, bool)
        differs[run[key != key[fresh][run]]] = True
        some = np.flatnonzero(differs[run])
        if len(some):
            order = some[np.lexsort((key[some].byteswap(), run[some]))]
            index[some], key[some] = index[order], key[order]
            fresh[1:] |= key[1:] != key[:-1]
            run = np.cumsum(fresh) - 1
            shared = np.bincount(run)[run] > 1
            index, run = index[shared], run[shared]
        group = run
    return index, group


def repeats(parts: DataFrame, length: int) -> DataFrame:
    """(doc, begin, size) of all repeats, from the rows of a range in order of their keys."""

    def later(run, doc, begin):
        """Which members of runs are not the first of their run."""
        order = np.lexsort((begin, doc, run))
        same = np.append(False, run[order][1:] == run[order][:-1])[: len(run)]
        # Rows that share doc_id and start are one place; none of them comes earlier.
        head = np.flatnonzero(~same)
        first = np.repeat(head, np.diff(np.append(head, len(run))))
        moved = (doc[order] != doc[order][first]) | (begin[order] != begin[order][first])
        return order[same & moved]

    def solve(table):
        kind = table.column("anchor").to_numpy()
        doc, begin, last = (table.column(c).to_numpy() for c in ("doc", "begin", "last"))
        known = kind == REPEAT
        found = [(doc[known], begin[known], last[known].astype(np.int64))]
        single = np.flatnonzero(kind == STRING)
        if len(single):
            key, second = table.column("key").to_numpy()[single], last[single]
            order = np.lexsort((second, key))
            change = np.append(True, (np.diff(key[order]) != 0) | (np.diff(second[order]) != 0))
            hit = single[order][later(np.cumsum(change), doc[single][order], begin[single][order])]
            found.append((doc[hit], begin[hit], np.full(len(hit), length)))
        whole = np.flatnonzero(kind >= 0)
        if len(whole):
            body, bounds = text_bytes(table.column("body").take(pa.array(whole)))
            count = last[whole].astype(np.int64) + 1
            row = np.repeat(np.arange(len(whole)), count)
            shift = spread(np.zeros(len(whole), np.int64), count)
            key = table.column("key").to_numpy()[whole]
            rank = np.unique(key, return_inverse=True)[1]
            group = rank[row] * (length + 1) + (kind[whole][row] - shift)
            index, run = equal_runs(body, bounds[:-1][row] + shift, group, length)
            starts = begin[whole][row[index]] + shift[index]
            hit = later(run, doc[whole][row[index]], starts)
            row, starts = row[index[hit]], starts[hit]
            row, starts, ends = merged(row, starts, starts + length)
            found.append((doc[whole][row], starts, ends - starts))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found, strict=True)], ["doc", "begin", "size"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            key = table.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1], "left")) if len(key) else 0
            # Rows of the last key may go on in the next batch.
            if cut:
                yield solve(table.slice(0, cut).combine_chunks())
            held = table.slice(cut)
        if held is not None and held.num_rows:
            yield solve(held.combine_chunks())

    dealt = parts.repartition("range").sortWithinPartitions("key")
    return dealt.mapInArrow(trimmed(run), "doc long, begin long, size long")


def leading_splitters(docs: DataFrame, length: int, gram: int):
    """Bounds of the ranges: even steps through the sorted leading bytes of a sample's anchors.

    The sample is of the rows whose hash is least, wherever they stand. Of every
    ``AT_ONCE`` bytes of it at most ``RANGES`` numbers reach the driver, and no text.
    """
    hashed = docs.select("text", F.xxhash64("doc", "text").alias("hash"))
    bound = hashed.select("hash").orderBy("hash").limit(SAMPLE).agg(F.max("hash")).head()[0]
    if bound is None:
        return np.zeros(0, np.uint64)

    def run(batches):
        for batch in by_bytes(batches, AT_ONCE):
            data, bounds = text_bytes(batch.column("text"))
            found, _ = anchors(data, bounds, length, gram)
            if len(found) > RANGES:
                found = found[np.linspace(0, len(found) - 1, RANGES).astype(np.int64)]
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(words_at(data)[found].byteswap().view(np.int64))], ["leading"])

    sample = hashed.where(F.col("hash") <= bound).select("text").mapInArrow(trimmed(run), "leading long").toArrow()
    leading = np.sort(sample.column("leading").to_numpy().view(np.uint64))
    if len(leading) == 0:
        return leading
    return leading[np.linspace(0, len(leading) - 1, RANGES + 1)[1:-1].astype(np.int64)]


def remaining(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept (bytes).

    Texts are UTF-8 bytes, null ones empty. Strings are judged on the input; the
    smaller doc_id comes first, null ids last. Rows that share a doc_id have one
    place in that order: only different starts tell their strings apart. Texts
    shorter than ``length`` keep all. No rows: no rows. Other columns are not looked at.
    """
    if not 8 <= gram <= length:
        raise ValueError("the gram must have 8 bytes or more and fit into the length")
    rows = own(docs, "doc_id", "text").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), whole_text().alias("text")
    )
    splitters = leading_splitters(rows, length, gram)
    found = anchor_rows(rows, length, gram)
    found = found.selectExpr("doc", "info", f"sum(info % {COUNTS}) over (partition by key) as total").where("total > 1")
    places = found.selectExpr("doc", f"(info div {COUNTS}) * 2 + if(total >= {HOT}, 1, 0) as place")
    listed = places.groupBy("doc").agg(F.collect_list("place").alias("places"))
    # Both joins with the texts use one shuffle of them.
    met = rows.join(listed.hint("merge"), "doc").select("doc", "text", "places")
    cut = repeats(stretches(met, splitters, length, gram), length)
    spans = cut.groupBy("doc").agg(F.collect_list(F.struct("begin", "size")).alias("spans"))
    spans = spans.select("doc", F.col("spans.begin").alias("begins"), F.col("spans.size").alias("sizes"))

    def run(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            doc = batch.column("doc")
            names = ["doc", "n_bytes", "n_removed", "n_spans", "kept"]
            begins, sizes = batch.column("begins"), batch.column("sizes")
            for low, high in row_groups(np.diff(bounds), AT_ONCE):
                inner = bounds[low : high + 1] - bounds[low]
                text = data[bounds[low] : bounds[high]]
                b, s = begins.slice(low, high - low), sizes.slice(low, high - low)
                counts = np.array([0 if n is None else n for n in pc.list_value_length(b).to_pylist()], np.int64)
                row = np.repeat(np.arange(high - low), counts)
                first = b.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                end = np.minimum(first + s.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(inner)[row])
                sound = first < end
                row, first, end = merged(row[sound], first[sound], end[sound])
                gone = np.zeros(len(text) + 1, np.int32)
                np.add.at(gone, inner[row] + first, 1)
                np.add.at(gone, inner[row] + end, -1)
                keep = np.cumsum(gone[:-1]) == 0
                removed = np.bincount(row, end - first, minlength=high - low).astype(np.int64)
                n_bytes = np.diff(inner)
                offsets = np.concatenate([[0], np.cumsum(n_bytes - removed)]).astype(np.int32)
                kept = pa.Array.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(text[keep]))])
                spans_n = np.bincount(row, minlength=high - low)
                yield pa.RecordBatch.from_arrays([doc.slice(low, high - low), pa.array(n_bytes), pa.array(removed), pa.array(spans_n), kept], names)

    whole = rows.join(spans.hint("merge"), "doc", "left").select("doc", "text", "begins", "sizes")
    left = whole.mapInArrow(trimmed(run), "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    return left.select(F.nullif("doc", F.lit(LAST)).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")
