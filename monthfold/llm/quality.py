"""Document quality by a byte-level convolutional network in numpy.

A text is its UTF-8 bytes. It is covered by overlapping chunks; in each, learned
filters slide over embedded bytes. Every filter keeps its highest response in the
whole document, and these maxima are combined into one probability. Scoring
needs a chunk at a time, so memory does not grow with the length of a text.

The network is fitted on the driver to a bounded sample of labelled documents
(``fit_rows`` documents of at most ``fit_chars`` code points, whole texts).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthfold.llm.common import carried, own, restored, whole_text
from monthfold.llm.units import row_groups, text_bytes

FIT_ROWS = 4000
FIT_CHARS = 200_000
STEPS = 625
BATCH = 32
WIDTH, STRIDE, DEPTH, FILTERS = 16, 3, 8, 32
CHUNK = 8192
#: Bytes of chunks that are convolved at a time.
AT_ONCE = 200_000
RATE = 0.01
#: Rows of label 0 count so many times: they are few.
RARE_WEIGHT = 3.0
ACCEPTED = 0.7
FOLDS, HELD_OUT = 4, 2


def held_out(folds: int = FOLDS, fold: int = HELD_OUT):
    """Whether a row's labels are kept from the fit: by the CRC of its id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def chunks(texts: list) -> tuple:
    """Chunks of byte arrays with the text each is of. A chunk starts where the last
    one's next filter position would be, wherever that one ended before the text, so
    no position and no byte is lost; short ones are padded."""
    step = (CHUNK - WIDTH) // STRIDE * STRIDE + STRIDE
    parts, owner = [], []
    for i, body in enumerate(texts):
        for at in range(0, max(len(body) - (step + WIDTH - STRIDE), 0) + step, step):
            part = body[at : at + step + WIDTH - STRIDE]
            count = max(-(-(len(part) - WIDTH) // STRIDE), 0) + 1
            padded = np.zeros((count - 1) * STRIDE + WIDTH, np.uint8)
            padded[: len(part)] = part
            parts.append(padded)
            owner.append(i)
    return parts, np.array(owner, np.int64)


def convolve(model: dict, parts: list) -> tuple:
    """Responses of all filters at all positions of some chunks."""
    data = np.concatenate(parts)
    sizes = np.array([(len(p) - WIDTH) // STRIDE + 1 for p in parts])
    first = np.cumsum([0, *map(len, parts)])[:-1]
    lead = np.cumsum(sizes) - sizes
    start = np.repeat(first, sizes) + (np.arange(sizes.sum()) - np.repeat(lead, sizes)) * STRIDE
    windows = np.lib.stride_tricks.sliding_window_view(model["bytes"][data], (WIDTH, DEPTH))[:, 0][start]
    patches = windows.reshape(len(start), WIDTH * DEPTH)
    return data, start, lead, patches, patches @ model["filters"] + model["shift"]


def pooled(model: dict, texts: list):
    """The highest response of every filter in every text."""
    best = np.full((len(texts), FILTERS), -np.inf, np.float32)
    parts, owner = chunks(texts)
    low = size = 0
    for high in range(1, len(parts) + 1):
        size += len(parts[high - 1])
        if high == len(parts) or size + len(parts[high]) > AT_ONCE:
            _, _, lead, _, found = convolve(model, parts[low:high])
            np.maximum.at(best, owner[low:high], np.maximum.reduceat(found, lead, axis=0))
            low, size = high, 0
    return best


def probability(model: dict, texts: list):

    if "bytes" not in model:
        return np.full(len(texts), model["prior"])
    logit = np.tanh(pooled(model, texts)).astype(np.float64) @ model["weights"].astype(np.float64) + float(model["offset"])
    return 1 / (1 + np.exp(-logit))


def fit(texts: list, labels, steps: int = STEPS, seed: int = 5) -> dict:
    """Weights of the network after ``steps`` batches (Adam on the log loss).

    Without both labels there is nothing to learn: every score is then the share
    of label 1, or a half if there are no labels.
    """
    labels = np.asarray(labels, np.float32)
    if len(labels) == 0 or labels.min() == labels.max():
        return {"prior": float(labels.mean()) if len(labels) else 0.5}
    rng = np.random.default_rng(seed)
    model = {
        "bytes": rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
        "filters": rng.normal(0, (WIDTH * DEPTH) ** -0.5, (WIDTH * DEPTH, FILTERS)).astype(np.float32),
        "shift": np.zeros(FILTERS, np.float32),
        "weights": rng.normal(0, 0.3, FILTERS).astype(np.float32),
        "offset": np.float32(1),
    }
    mean = {k: np.zeros_like(v) for k, v in model.items()}
    square = {k: np.zeros_like(v) for k, v in model.items()}
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < BATCH:
            order = np.append(order, rng.permutation(len(labels)))
        some, order = order[:BATCH], order[BATCH:]
        slope = gradient(model, [texts[i] for i in some], labels[some])
        for k in model:
            mean[k] = 0.9 * mean[k] + 0.1 * slope[k]
            square[k] = 0.98 * square[k] + 0.02 * slope[k] ** 2
            move = RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.98**step)) + 1e-8)
            model[k] = (model[k] - move).astype(np.float32)
    return model


def gradient(model: dict, texts: list, labels) -> dict:
    """Slope of the loss: only the position of each maximum takes part."""
    best = np.full((len(texts), FILTERS), -np.inf, np.float32)
    patch = np.zeros((len(texts), FILTERS, WIDTH * DEPTH), np.float32)
    origin = np.zeros((len(texts), FILTERS, WIDTH), np.uint8)
    every = np.arange(FILTERS)
    parts, owner = chunks(texts)
    for part, text in zip(parts, owner, strict=True):
        data, start, _, patches, found = convolve(model, [part])
        at = found.argmax(0)
        top = found[at, every]
        better = np.flatnonzero(top > best[text])
        best[text, better] = top[better]
        patch[text, better] = patches[at[better]]
        origin[text, better] = data[start[at[better]][:, None] + np.arange(WIDTH)]
    bent = np.tanh(best)
    chance = 1 / (1 + np.exp(-(bent @ model["weights"] + model["offset"])))
    error = (chance - labels) * np.where(labels > 0, 1, RARE_WEIGHT) / len(labels)
    pull = error[:, None] * model["weights"] * (1 - bent**2)
    bytes_slope = np.zeros_like(model["bytes"])
    spread = (pull[:, :, None] * model["filters"].T[None]).reshape(-1, DEPTH)
    np.add.at(bytes_slope, origin.reshape(-1), spread)
    return {
        "bytes": bytes_slope,
        "filters": np.einsum("tf,tfk->kf", pull, patch),
        "shift": pull.sum(0),
        "weights": bent.T @ error,
        "offset": error.sum(),
    }


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_chars: int = FIT_CHARS) -> dict:
    """The network fitted to labelled rows of ``docs`` that are not held out.

    The sample is the ``fit_rows`` labels with the lowest hash of their id; their
    documents are found by a broadcast of those ids. Texts of over ``fit_chars``
    code points are left out of the sample. Null labels teach nothing.
    """
    known = own(labels, "doc_id", "quality").where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(fit_rows)
    texts = own(docs, "doc_id", "text").select("doc_id", whole_text().alias("text"))
    rows = texts.where(F.char_length("text") <= fit_chars).join(F.broadcast(sample), "doc_id").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["doc_id"], r["text"], r["quality"]))
    bodies = [np.frombuffer(r["text"].encode("utf-8", "replace"), np.uint8) for r in rows]
    return fit(bodies, [float(r["quality"] > 0) for r in rows])


def scorer(model: dict):
    """The probability of label 1 as a function of a text column."""
    def score(column):

        data, bounds = text_bytes(column)
        out = np.zeros(len(bounds) - 1)
        for low, high in row_groups(np.diff(bounds), 20 * AT_ONCE):
            out[low:high] = probability(model, [data[bounds[i] : bounds[i + 1]] for i in range(low, high)])
        return pa.array(out)

    # Annotated here: annotations in this module are strings, which the decorator does not read.
    score.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(score, T.DoubleType())


def score_documents(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= 0.7).

    A null text is scored as the empty text, which has a score like any other; a
    null doc_id is not held out. Rows that repeat are scored each; no rows: none.
    Only the text is an input of the score.
    """
    score = scorer(learn(docs, labels, fit_rows))
    rows = own(docs, "doc_id", "text").select("doc_id", held_out().alias("held_out"), score(whole_text()).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= ACCEPTED).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents with a score of 0.7 or more, with all their columns."""
    score = scorer(learn(docs, labels, fit_rows))
    rows = carried(docs, "text").select("doc", score(whole_text()).alias("score"))
    return restored(rows.where(F.col("score") >= ACCEPTED), docs)
