"""Exact top-k by inner product: sorted lists read without random access.

Rows are cut into blocks. In a block every component is a sorted list; a query
reads the lists of its positive components from the top and those of its negative
ones from the bottom. After each stretch of reading, every row has a lower score
bound (what was read of it, else the list's worst value) and an upper one (else
the value the list has come to). Reading stops when few rows outside the k best
lower bounds can still qualify; these few are then scored in full. Bounds of many
queries are computed together, as matrix products over the lists.

Every query meets every block of rows; each such cell gives at most k rows, and
the best k of a query are taken from those.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthfold.llm.common import own, written

SCALE = 64
TOP = 20
BLOCK_ROWS = 8192
GROUP_QUERIES = 1024
#: Parts of the lists that have been read when bounds are compared.
DEPTHS = (0.25, 0.6)
#: Every query group is copied to so many cells, among which the blocks are dealt.
SPREAD = 64
PACKED = "ids binary, kind string, width int, body binary"
FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_name: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, ints): floor(scale * x) of every component, as double arithmetic.

    Left out: null ids, null vectors, vectors with null or non-finite components, and vectors of a squared
    length (in these integers) of 2**61 or more, whose inner products need not fit into 64 bits.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = own(vectors, id_name, vector).toDF("vec_id", "v").select(F.col("vec_id").cast("long"), F.col("v").cast("array<double>"))
    sound = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite))
    length = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    sound = sound.where(length < F.lit(2.0**61 / scale**2))
    return sound.select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).alias("ints"))


def pack(ids, lists) -> dict:
    """Rows as one record: ids in ascending order and the components as one matrix.

    A shorter vector is filled with zeros, which add nothing to a product.
    """
    ids = ids.to_numpy(zero_copy_only=False).astype(np.int64)
    if hasattr(lists, "combine_chunks"):
        lists = lists.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max()) if len(sizes) else 0
    matrix = np.zeros((len(ids), width), np.int64)
    matrix[np.repeat(np.arange(len(ids)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    order = np.argsort(ids, kind="stable")
    top = int(np.abs(values).max()) if len(values) else 0
    kind = "int16" if top < 2**15 else "int64"
    return {"ids": ids[order].tobytes(), "kind": kind, "width": width, "body": matrix[order].astype(kind).tobytes()}


def unpack(ids: bytes, kind: str, width: int, body: bytes):

    own = np.frombuffer(ids, np.int64)
    return own, np.frombuffer(body, kind).reshape(len(own), width)


def search(query_ids, queries, ids, rows, top: int):
    """The ``top`` best rows of a block for each of some queries: query index, row index, score."""
    width = max(queries.shape[1], rows.shape[1])
    queries, rows = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (queries, rows))
    n = len(ids)
    bound = int(np.abs(queries).max(initial=0)) * int(np.abs(rows).max(initial=0)) * width
    if n == 0 or len(query_ids) == 0:
        return (np.zeros(0, np.int64),) * 3
    if bound >= 2**53:
        real = object  # whole numbers of any size
    else:
        real = np.float32 if bound < 2**24 else np.float64
    q, x = queries.astype(real), rows.astype(real)
    low, high = np.searchsorted(ids, query_ids, "left"), np.searchsorted(ids, query_ids, "right")
    own_query = np.repeat(np.arange(len(query_ids)), high - low)
    own_row = np.arange(len(own_query)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + np.repeat(low, high - low)

    waiting = np.arange(len(query_ids))
    hits: list[tuple] = []
    if real is not object and n > 8 * top:
        lists = np.sort(x, axis=0)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        for depth in DEPTHS:
            read = int(n * depth)
            above, below = lists[n - read], lists[read - 1]
            from_top, from_bottom = x >= above, x <= below
            a, b = up[waiting], down[waiting]
            most = a @ np.where(from_top, x, above).T + b @ np.where(from_bottom, x, below).T
            least = a @ np.where(from_top, x, lists[0]).T + b @ np.where(from_bottom, x, lists[-1]).T
            place = np.full(len(query_ids), -1)
            place[waiting] = np.arange(len(waiting))
            mine = place[own_query] >= 0
            most[place[own_query[mine]], own_row[mine]] = -np.inf
            least[place[own_query[mine]], own_row[mine]] = -np.inf
            line = np.partition(least, n - top, axis=1)[:, n - top]
            open_rows = most >= line[:, None]
            few = open_rows.sum(axis=1) <= max(4 * top, n // 32)
            for k in np.flatnonzero(few):
                rows_left = np.flatnonzero(open_rows[k])
                hits.append((waiting[k], rows_left, x[rows_left] @ q[waiting[k]]))
            waiting = waiting[~few]
            if len(waiting) == 0:
                break
    # The lists of the others are read to their ends: all their scores are known.
    some = max(1, 4_000_000 // n)
    for at in range(0, len(waiting), some):
        part = waiting[at : at + some]
        full = q[part] @ x.T
        if real is not object:
            place = np.full(len(query_ids), -1)
            place[part] = np.arange(len(part))
            mine = place[own_query] >= 0
            full[place[own_query[mine]], own_row[mine]] = -np.inf
            if n > top:
                line = np.partition(full, n - top, axis=1)[:, n - top]
                hits += [(i, found, full[k, found]) for k, i in enumerate(part) for found in (np.flatnonzero(full[k] >= line[k]),)]
                continue
        hits += [(i, np.arange(n), full[k]) for k, i in enumerate(part)]
    out_query, out_row, out_score = [], [], []
    for i, found, score in hits:
        other = (found < low[i]) | (found >= high[i])
        found, score = found[other], score[other]
        # Rows are in order of their ids, so a stable sort leaves ties to the smaller id.
        best = np.argsort(-score, kind="stable")[:top]
        out_query.append(np.full(len(best), i))
        out_row.append(found[best])
        out_score.append(np.array([int(s) for s in score[best]], np.int64))
    return tuple(np.concatenate(part).astype(np.int64) for part in (out_query, out_row, out_score))


def top_k(vectors: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """``vectors`` and ``queries`` as (vec_id, ints) to query_id, rank, vec_id, score.

    Rows with the query's id are its own and no candidates. Ties go to the smaller
    vec_id. Fewer candidates than ``top``: all of them. A repeated id is a row of its
    own; a repeated query is one query. No queries or no vectors: no rows.
    """
    groups = max(1, -(-queries.count() // GROUP_QUERIES))

    def blocks(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                fields = [("ids", pa.binary()), ("kind", pa.string()), ("width", pa.int32()), ("body", pa.binary())]
                yield pa.RecordBatch.from_pylist([pack(part.column("vec_id"), part.column("ints"))], pa.schema(fields))

    def gather(key, found):
        packed = pack(found.column("vec_id").combine_chunks(), found.column("ints"))
        fields = [("group", pa.int32()), ("ids", pa.binary()), ("kind", pa.string()), ("width", pa.int32()), ("body", pa.binary())]
        return pa.Table.from_pylist([{"group": key[0].as_py(), **packed}], pa.schema(fields))

    def cells(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(name)[r].as_py() for name in batch.schema.names}
                asked, wanted = unpack(row["q_ids"], row["q_kind"], row["q_width"], row["q_body"])
                ids, matrix = unpack(row["ids"], row["kind"], row["width"], row["body"])
                i, k, score = search(asked, wanted, ids, matrix, top)
                yield pa.RecordBatch.from_arrays([pa.array(asked[i]), pa.array(ids[k]), pa.array(score)], ["query_id", "vec_id", "score"])

    asked = queries.dropDuplicates(["vec_id"]).withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
    packed = asked.groupBy("group").applyInArrow(gather, f"group int, {PACKED}").withColumnsRenamed({c: f"q_{c}" for c in ("ids", "kind", "width", "body")})
    # Each group's queries go to every cell, each block to one cell of every group.
    spread = packed.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    dealt = vectors.mapInArrow(blocks, PACKED).withColumn("cell", F.pmod(F.xxhash64("ids"), F.lit(SPREAD)).cast("int"))
    dealt = dealt.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    met = dealt.join(spread.hint("merge"), ["group", "cell"]).drop("group", "cell")
    found = met.mapInArrow(cells, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search_vectors(vectors: DataFrame, every: int = 20, top: int = TOP) -> DataFrame:
    """Top rows of ``vectors`` (vec_id, embedding) for those whose id ``every`` divides."""
    ints = written(quantised(vectors), "vectors")
    return top_k(ints, ints.where(F.col("vec_id") % every == 0), top)
