"""Similarity join on word shingles by a MinHash LSH forest and exact verification.

Texts with the same words are one node. Every node gets ``TREES`` labels of
``DEPTH`` minimum hashes each. The labels of a tree are its trie: they are sorted, so
that every prefix is a stretch of neighbours. One sort by (tree, label), cut into
ranges, holds all tries; no prefix, however many nodes share it, is one task's alone.

Within a range a task walks down the sorted labels. An entry starts with its whole
label and is shortened until it meets its neighbour before it, and is tied there
once, at its longest match, to the head of that stretch; heads are shortened further. No entry
is shortened below ``prefix_for``, the longest prefix at which all trees together
meet a link at the threshold with the target recall. What is cut apart
by a range's border is tied by the first and last entries of all ranges.

Nodes connected by ties form a family; all pairs of a family are compared exactly,
within tasks: a family is cut into parts of ``PART`` nodes, and each pair of parts
is a group of its own. What leaves a group is one row per node and part: its number
of links and the node it is connected to.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthfold.llm.common import SPACE_CLASS, carried, own, restored, whole_text, written
from monthfold.llm.groups import components
from monthfold.llm.units import row_groups, slices, spread, text_bytes, word_spans

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
TREES, DEPTH = 32, 8
PART = 256
NODE_BYTES = 16
#: Bytes of text whose shingles a task holds at a time.
AT_ONCE = 2_000_000


def prefix_for(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold matches in some tree as often as asked."""
    for length in range(depth, 0, -1):
        if 1 - (1 - threshold**length) ** trees >= recall:
            return length
    raise ValueError("more trees are needed for this recall")


def mixed(x):
    """64-bit finaliser: spreads all bits of unsigned numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words):
    """64-bit hashes of an Arrow array of different words."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    size = np.diff(offsets)
    if len(size) == 0:
        return np.zeros(0, np.uint64)
    body = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    powers = np.ones(int(size.max()), np.uint64)
    powers[1:] = np.uint64(0x9E3779B97F4A7C15)
    powers = np.multiply.accumulate(powers)
    place = spread(np.zeros(len(size), np.int64), size)
    return mixed(np.add.reduceat((body + np.uint64(1)) * powers[place], offsets[:-1] - offsets[0]) + size.astype(np.uint64))


def shingles(data, bounds, width: int = WORDS):
    """64-bit hashes of the shingles of some texts, end to end, and their number by text.

    A text of fewer words than ``width`` but at least one has one shingle of all of them.
    """
    rows = len(bounds) - 1
    start, end, row = word_spans(data, bounds)
    coded = slices(data, start, end).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    hashed = np.append(word_hashes(coded.dictionary)[codes], np.zeros(width, np.uint64))
    words = np.bincount(row, minlength=rows)
    count = np.where(words > 0, np.maximum(words - width + 1, 1), 0)
    first = np.cumsum(words) - words
    at = spread(first, count)
    size = np.repeat(words, count)
    total = np.zeros(len(at), np.uint64)
    for k in range(width):
        inside = np.minimum(at + k, len(hashed) - 1)
        total += np.where(k < size, hashed[inside], np.uint64(0)) * np.uint64(2 * k * 0x9E3779B97F4A7C15 + 0xD1B54A32D192ED03 & (2**64 - 1) | 1)
    return mixed(total), count


def labels_of(hashes, count, trees: int = TREES, depth: int = DEPTH):
    """Minimum hashes as 16-bit numbers: texts by trees * depth. Texts without shingles: zeros."""
    rng = np.random.default_rng(20240229)
    factor = rng.integers(0, 2**31, trees * depth, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 2**32, trees * depth, dtype=np.uint32)
    out = np.zeros((len(count), trees * depth), np.uint16)
    full = np.flatnonzero(count)
    if len(full) == 0:
        return out
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    lead = (np.cumsum(count) - count)[full]
    for k in range(trees * depth):
        least = np.minimum.reduceat(short * factor[k] + shift[k], lead)
        out[full, k] = (least * np.uint32(2654435769)) >> np.uint32(16)
    return out


def signatures(docs: DataFrame, trees: int = TREES, depth: int = DEPTH, width: int = WORDS) -> DataFrame:
    """Per document: doc_id, node (MD5 of its words), shingles (whether any), labels."""

    def run(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            for low, high in row_groups(np.diff(bounds), AT_ONCE):
                part = data[bounds[low] : bounds[high]]
                hashes, count = shingles(part, bounds[low : high + 1] - bounds[low], width)
                found = labels_of(hashes, count, trees, depth)
                step = found.shape[1] * 2
                offsets = np.arange(high - low + 1, dtype=np.int32) * step
                body = pa.Array.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(found))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), batch.column("node").slice(low, high - low), pa.array(count > 0), body],
                    ["doc_id", "node", "any", "labels"],
                )

    words = F.trim(F.regexp_replace(whole_text(), SPACE_CLASS, " "))
    rows = own(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(words.cast("binary"))).alias("node"), whole_text().alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, node binary, any boolean, labels binary")


def entries(nodes: DataFrame, trees: int, depth: int) -> DataFrame:
    """(tree, label, node): every node's entry in every trie."""
    step = depth * 2
    cut = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.substring("labels", t * step + 1, F.lit(step)))
    return nodes.select("node", F.posexplode(cut).alias("tree", "label")).select("tree", "label", "node")


class Walk:
    """Ties between the sorted entries of one range, batch by batch."""

    def __init__(self, depth: int, shortest: int):
        self.depth, self.shortest = depth, shortest
        self.last = None
        self.heads = np.zeros((depth + 1, NODE_BYTES), np.uint8)

    def step(self, tree, label, node):
        """(met, head): the length of each entry's longest match before it, and the head of the stretch of that length."""
        rows = len(tree)
        hashes = np.ascontiguousarray(label).view(np.uint16).reshape(rows, self.depth)
        before_tree, before = (np.array([-1]), hashes[:1]) if self.last is None else self.last
        same = hashes == np.concatenate([before, hashes[:-1]])
        met = np.logical_and.accumulate(same, axis=1).sum(axis=1)
        met[tree != np.concatenate([before_tree, tree[:-1]])] = 0
        head = np.zeros((rows, NODE_BYTES), np.uint8)
        for length in range(self.shortest, self.depth + 1):
            lead = np.maximum.accumulate(np.where(met < length, np.arange(rows), -1))
            leads = np.where((lead >= 0)[:, None], node[np.maximum(lead, 0)], self.heads[length])
            head[met == length] = leads[met == length]
            self.heads[length] = leads[-1]
        self.last = tree[-1:].copy(), hashes[-1:].copy()
        return met, head


def fixed(column, width: int):
    """A binary column of values of one width as a table of bytes."""
    return np.frombuffer(column.cast(pa.binary(width)).buffers()[1], np.uint8).reshape(-1, width)[column.offset : column.offset + len(column)]


def walked(sorted_entries: DataFrame, depth: int, shortest: int) -> DataFrame:
    """Ties (a, b) of each range, and its first and last entry (tree, label, b; a is null)."""

    def run(batches):
        walk, final = Walk(depth, shortest), None
        for batch in batches:
            rows = batch.num_rows
            if rows == 0:
                continue
            tree, node = batch.column("tree").to_numpy(), fixed(batch.column("node"), NODE_BYTES)
            met, head = walk.step(tree, fixed(batch.column("label"), depth * 2), node)
            tied = np.flatnonzero((met >= shortest) & (head != node).any(axis=1))
            a = pa.Array.from_buffers(pa.binary(NODE_BYTES), len(tied), [None, pa.py_buffer(np.ascontiguousarray(head[tied]))]).cast(pa.binary())
            nothing = pa.nulls(len(tied))
            yield pa.RecordBatch.from_arrays(
                [nothing.cast(pa.int32()), nothing.cast(pa.binary()), a, batch.column("node").take(pa.array(tied)).cast(pa.binary())], ["tree", "label", "a", "b"]
            )
            for border in ([batch.slice(0, 1)] if final is None else []):
                yield pa.RecordBatch.from_arrays([border.column("tree"), border.column("label"), pa.nulls(1, pa.binary()), border.column("node")], ["tree", "label", "a", "b"])
            final = batch.slice(rows - 1, 1)
        if final is not None:
            yield pa.RecordBatch.from_arrays([final.column("tree"), final.column("label"), pa.nulls(1, pa.binary()), final.column("node")], ["tree", "label", "a", "b"])

    return sorted_entries.mapInArrow(run, "tree int, label binary, a binary, b binary")


def ties(nodes: DataFrame, trees: int, depth: int, shortest: int) -> DataFrame:
    """Edges (a, b) that connect all nodes with a common prefix of ``shortest`` in some trie."""
    order = ["tree", "label", "node"]
    sorted_entries = entries(nodes, trees, depth).repartitionByRange(*order).sortWithinPartitions(*order)
    found = written(walked(sorted_entries, depth, shortest), "ties")
    # Two entries a range: a stretch that goes on in the next range has one in each.
    border = found.where("a is null").select("tree", F.substring("label", 1, shortest * 2).alias("prefix"), "b")
    first = border.groupBy("tree", "prefix").agg(F.min("b").alias("a"))
    across = border.join(first, ["tree", "prefix"]).where("a <> b").select("a", "b")
    return found.where("a is not null").select("a", "b").unionAll(across)


def compare(sets: list, sizes, first: int, threshold: float):
    """Links between the sets of a group; with ``first`` > 0 only between those before it and the rest.

    Gives each set's sum of the sizes it is linked to, and the least set it is connected to.
    """
    count = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), count)
    _, code, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often[code] > 1
    owner, code = owner[shared], code[shared]
    codes, code = np.unique(code, return_inverse=True)
    common = np.zeros((len(sets), len(sets)), np.float32)
    wide = max(256, 8_000_000 // max(len(sets), 1))
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for at in range(0, len(codes), wide):
        low, high = np.searchsorted(code, [at, at + wide])
        block = np.zeros((len(sets), min(wide, len(codes) - at)), np.float32)
        block[owner[low:high], code[low:high] - at] = 1
        common += block @ block.T
    linked = common >= threshold * (count[:, None] + count[None, :] - common) - 1e-6
    np.fill_diagonal(linked, False)
    if first:
        linked[:first, :first] = False
        linked[first:, first:] = False
    root = np.arange(len(sets))
    while True:
        near = np.where(linked, root[None, :], len(sets)).min(axis=1, initial=len(sets))
        better = np.minimum(root, near)
        better = better[better]
        if (better == root).all():
            return linked @ np.asarray(sizes, np.int64), root
        root = better


def link_groups(members: DataFrame, threshold: float) -> DataFrame:
    """(node, root, links) for each node and group of ``members`` (family, left, right, side, node, size, body)."""

    def run(key, table):
        table = table.sort_by([("side", "ascending"), ("node", "ascending")])
        nodes = table.column("node").to_pylist()
        table = table.take(pa.array([i for i, n in enumerate(nodes) if i == 0 or n != nodes[i - 1]], pa.int64()))
        sets = [np.frombuffer(b.as_buffer(), np.uint64) for b in table.column("body")]
        side = table.column("side").to_numpy()
        first = int((side == 0).sum()) if key[1].as_py() != key[2].as_py() else 0
        nodes = table.column("node").to_pylist()
        if len(sets) < 2 or (key[1].as_py() != key[2].as_py() and first in (0, len(sets))):
            links, root = np.zeros(len(sets), np.int64), np.arange(len(sets))
        else:
            links, root = compare(sets, table.column("size").to_numpy(), first, threshold)
        return pa.table({"node": pa.array(nodes, pa.binary()), "root": pa.array([nodes[r] for r in root], pa.binary()), "links": pa.array(links)})

    return members.groupBy("family", "left", "right").applyInArrow(run, "node binary, root binary, links long")


def shingle_sets(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` (node, family, size, parts, part, text) with the text's different shingles as ``body``."""
    keep = ["node", "family", "size", "parts", "part"]

    def run(batches):
        before: set = set()
        for batch in batches:
            # Repeated rows follow one another: here one of each batch goes on, below one of each group.
            first = {n: i for i, n in reversed(list(enumerate(batch.column("node").to_pylist()))) if n not in before}
            before = set(first) | before & set(batch.column("node").to_pylist())
            batch = batch.take(pa.array(sorted(first.values()), pa.int64()))
            data, bounds = text_bytes(batch.column("text"))
            for low, high in row_groups(np.diff(bounds), AT_ONCE):
                hashes, count = shingles(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low], width)
                ends = np.cumsum(count)
                bodies = [np.unique(hashes[e - c : e]).tobytes() for e, c in zip(ends, count, strict=True)]
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(bodies, pa.binary())], [*keep, "body"])

    return rows.mapInArrow(run, "node binary, family binary, size long, parts int, part int, body binary")


def similar(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, width: int = WORDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, class_id, n_links, class_size.

    Two documents are linked if the Jaccard similarity of their word shingles is at
    least ``threshold``; words are runs of ``[^\\x20\\x09-\\x0D]``, as they are. A class
    is what links connect; its id is its smallest doc_id (null ids aside). n_links
    counts linked documents, copies included. Texts without words, null ones too,
    have no links and are classes of their own. Rows that repeat are copies. No rows: none.
    """
    shortest = prefix_for(threshold, recall)
    rows = written(signatures(docs, width=width), "signatures")
    members = rows.select("doc_id", "node", "any")
    worded = rows.where("any").groupBy("node").agg(F.count("*").alias("size"), F.min("doc_id").alias("first_id"), F.first("labels").alias("labels"))
    nodes = written(worded, "nodes")
    families = written(components(ties(nodes, TREES, DEPTH, shortest), "families").select("node", F.col("root").alias("family")), "families")

    # One text per node of a family: of its copies, the one with the smallest id.
    sizes = families.groupBy("family").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / PART).cast("int")
    wanted = families.join(sizes, "family").join(nodes.select("node", "size", "first_id"), "node")
    wanted = wanted.select("node", "family", "size", "first_id", parts.alias("parts"), F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"))
    texts = own(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("first_id"), whole_text().alias("text"))
    # Several rows may have that id: the node is checked too.
    texts = texts.withColumn("text_node", F.unhex(F.md5(F.trim(F.regexp_replace("text", SPACE_CLASS, " ")).cast("binary"))))
    same = texts["first_id"].eqNullSafe(wanted["first_id"]) & (F.col("text_node") == F.col("node"))
    met = texts.join(wanted.hint("merge"), same).select("node", "family", "size", "parts", "part", "text")
    bodies = shingle_sets(met, width)
    # A pair of parts is a group; a node joins every group that its part is in.
    other = bodies.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = other.select(
        "family", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right"),
        (F.col("part") > F.col("other")).cast("int").alias("side"), "node", "size", "body",
    )
    found = written(link_groups(placed, threshold), "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("root").alias("a"), F.col("node").alias("b")), "classes")
    facts = nodes.select("node", "size", "first_id").join(links, "node", "left").join(roots, "node", "left")
    facts = facts.select("node", "size", "first_id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    facts = written(facts, "facts")
    classes = facts.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("size").alias("class_size"))
    named = facts.join(classes, "root").select("node", "class_id", "class_size", (F.col("links") + F.col("size") - 1).alias("n_links"))
    told = members.where("any").join(named.hint("merge"), "node").select("doc_id", "class_id", "n_links", "class_size")
    alone = members.where("not any").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("class_size"))
    return told.unionAll(alone)


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose id is that of their class, with all their columns.

    Of rows that share the id of their class, those of that class's text all stay.
    """
    told = similar(docs, threshold).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    kept = told.select(F.struct("doc_id").alias("id")).distinct()
    rows = carried(docs, "doc_id").select("doc", F.struct(F.col("doc_id").cast("long").alias("doc_id")).alias("id"))
    return restored(rows.join(kept, "id", "left_semi"), docs)
