"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are embedded, and filters over KERNEL bytes are applied
every STRIDE bytes.  Positions are pooled by maximum inside overlapping chunks
(CHUNK positions, a new one every STEP) that together cover the whole text.  The
mean and the maximum over the chunks of every filter go into one logistic unit,
which gives the probability of label 1.

The network is learned by Adam from a bounded sample of the labelled rows: the
``TRAIN_ROWS`` rows least by a hash of the id.  Texts of any length are learned from:
one of more than ``TRAIN_CHARS`` characters is cut into pieces of that length, a new one
every seven eighths of it, each with the text's label; if pieces make more than ``TRAIN_ROWS``
examples, those least by a hash of row and piece are taken.  One task learns from them, in a
fixed order.  Every row is scored on its whole text; long texts run through in pieces.

Defined results: NULL or empty text is one chunk of padding; NULL ids are never
learned from and not held out; NULL labels are no labels; without labels of both
kinds every score is the share of label 1 (0.5 without labels); repeated rows
are scored alike; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlake.llm.common import python_workers
from freightlake.llm.toxicity import fold, labelled_sample

WIDTH, FILTERS, STRIDE, KERNEL = 8, 24, 1, 8
BLOCK = 128  # positions; a chunk is four blocks, and a new one begins every three
CHUNK, STEP = 4 * BLOCK, 3 * BLOCK
PIECE = 1 << 16  # bytes of a long text in memory at once, a multiple of STRIDE * BLOCK
TRAIN_ROWS, TRAIN_CHARS, PASSES, BATCH, RATE = 3_000, 8_000, 3, 16, 0.01


def initial() -> dict[str, np.ndarray]:
    draw = np.random.default_rng(7)
    normal = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
    return {"embed": normal(256, WIDTH, scale=0.5), "filters": normal(KERNEL * WIDTH, FILTERS, scale=0.15),
            "shift": np.zeros(FILTERS, np.float32), "mean": normal(FILTERS, scale=0.1), "top": normal(FILTERS, scale=0.1),
            "bias": np.zeros(1, np.float32)}


def padded(text: str | None) -> np.ndarray:
    """Bytes of the text, filled up to whole strides with at least one position."""
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    n = max(KERNEL, -(-len(raw) // STRIDE) * STRIDE)
    out = np.zeros(n, np.uint8)
    out[:len(raw)] = raw
    return out


def activations(model: dict, raw: np.ndarray) -> np.ndarray:
    """(positions, filters) after the rectifier."""
    x = np.take(model["embed"], raw, axis=0)
    n = (len(raw) - KERNEL) // STRIDE + 1
    under = np.lib.stride_tricks.as_strided(x, (n, KERNEL * WIDTH), (STRIDE * WIDTH * x.itemsize, x.itemsize), writeable=False)
    z = under @ model["filters"] + model["shift"]
    return np.maximum(z, 0, out=z)


def chunk_starts(positions: int) -> np.ndarray:
    """First positions of the chunks; the last one reaches the end."""
    return np.arange(0, max(1, -(-(positions - (CHUNK - STEP)) // STEP)) * STEP, STEP)


def probability(model: dict, text: str | None) -> float:
    raw = padded(text)
    positions = (len(raw) - KERNEL) // STRIDE + 1
    tops = []  # of blocks; pieces share bytes, so that no position is lost
    for at in range(0, positions * STRIDE, PIECE):
        z = activations(model, raw[at:at + PIECE + KERNEL - STRIDE])
        tops.append(np.maximum.reduceat(z, np.arange(0, len(z), BLOCK)))
    block = np.concatenate(tops)
    starts = chunk_starts(positions) // BLOCK
    block = np.concatenate((block, np.zeros((starts[-1] + 4 - len(block), FILTERS), np.float32))) if starts[-1] + 4 > len(block) else block
    chunk = np.maximum(np.maximum(block[starts], block[starts + 1]), np.maximum(block[starts + 2], block[starts + 3]))
    return float(_logistic(chunk.mean(0) @ model["mean"] + chunk.max(0) @ model["top"] + model["bias"][0]))


def _logistic(x) -> float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def gradients(model: dict, raw: np.ndarray, label: int, out: dict) -> None:
    """Add the gradients of one text's log loss to ``out``."""
    z = activations(model, raw)
    starts = chunk_starts(len(z))
    best = np.empty((len(starts), FILTERS), np.int64)
    for k, s in enumerate(starts):
        best[k] = s + z[s:s + CHUNK].argmax(0)
    each = np.arange(FILTERS)
    chunk = z[best, each]
    mean, lead = chunk.mean(0), chunk.argmax(0)
    top = chunk[lead, each]
    d = np.float32(_logistic(mean @ model["mean"] + top @ model["top"] + model["bias"][0]) - label)
    out["mean"] += d * mean
    out["top"] += d * top
    out["bias"] += d
    g = np.tile(d * model["mean"] / len(starts), (len(starts), 1))
    g[lead, each] += d * model["top"]
    g *= chunk > 0
    out["shift"] += g.sum(0)
    # bytes under each chunk's best position: (chunks, filters, KERNEL)
    under = raw[best[:, :, None] * STRIDE + np.arange(KERNEL)]
    x = model["embed"][under].reshape(len(starts), FILTERS, KERNEL * WIDTH)
    out["filters"] += np.einsum("cf,cfk->kf", g, x)
    back = np.einsum("cf,kf->cfk", g, model["filters"]).reshape(-1, WIDTH)
    for w in range(WIDTH):
        out["embed"][:, w] += np.bincount(under.ravel(), weights=back[:, w], minlength=256).astype(np.float32)


def fit(rows: list[tuple[str, int]]) -> dict:
    """The network learned from (text, label) in this order, with batches drawn
    by a fixed seed; the share of label 1 alone if there are not both labels."""
    model = initial()
    if len({y for _, y in rows}) < 2:
        share = np.clip(np.mean([y for _, y in rows]) if rows else 0.5, 1e-6, 1 - 1e-6)
        return {k: np.zeros_like(v) for k, v in model.items()} | {"bias": np.array([np.log(share / (1 - share))], np.float32)}
    texts = [(padded(t), y) for t, y in rows]
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    draw, t = np.random.default_rng(11), 0
    steps = PASSES * -(-len(texts) // BATCH)
    for _ in range(PASSES):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            g = {k: np.zeros_like(v) for k, v in model.items()}
            part = order[at:at + BATCH]
            for k in part:
                gradients(model, *texts[k], g)
            t += 1
            rate = RATE * (1 - 0.9 * t / steps)
            for k, v in model.items():
                d = g[k] / len(part)
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.99 * second[k] + 0.01 * d * d
                model[k] = v - (rate * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
    return model


def examples(sample: DataFrame, chars: int = TRAIN_CHARS, rows: int = TRAIN_ROWS) -> DataFrame:
    """(order, label, text) with long texts in overlapping pieces, at most ``rows`` examples."""
    python_workers(sample.sparkSession)
    step = chars - chars // 8

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for order, label, text in zip(*(batch.column(c).to_pylist() for c in ("order", "label", "text")), strict=True):
                for piece, at in enumerate(range(0, max(1, len(text) - chars // 8), step)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([order]), pa.array([label], pa.int32()), pa.array([text[at:at + chars]]), pa.array([piece])],
                        names=["order", "label", "text", "piece"])

    pieces = sample.mapInArrow(cut, "order long, label int, text string, piece long")
    own = F.when(F.col("piece") == 0, F.col("order")).otherwise(F.xxhash64("order", "piece"))
    return pieces.select(own.alias("order"), "label", "text").orderBy("order", "label", "text").limit(rows)


def learn(sample: DataFrame) -> dict:
    """The network learned from (order, label, text) in one task."""
    python_workers(sample.sparkSession)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(b.column("text").to_pylist(), b.column("label").to_pylist(), strict=True)]
        model = fit(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(model)), pa.array([v.ravel().astype(np.float64) for v in model.values()])], names=["name", "values"])

    found = (sample.repartition(1).sortWithinPartitions("order", "label", "text")  # one task, TRAIN_ROWS rows
             .mapInArrow(train, "name string, values array<double>").collect())
    shapes = {k: v.shape for k, v in initial().items()}
    return {r["name"]: np.array(r["values"], np.float32).reshape(shapes[r["name"]]) for r in found} or fit([])


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each row of ``docs``."""
    spark = docs.sparkSession
    python_workers(spark)
    sent = spark.sparkContext.broadcast(model)  # a few thousand numbers
    given = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    schema = f"`{id_col}` {given.schema[0].dataType.simpleString()}, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [probability(sent.value, t) for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=[id_col, "score"])

    return given.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 3, held: int = 1, cut: float = 0.5,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, held_out, score, predicted.  Rows of
    fold ``held`` are never learned from."""
    sample = labelled_sample(docs, labels, label_col, fold(id_col, folds) != held, TRAIN_ROWS, id_col, text_col)
    scored = score(docs, learn(examples(sample)), id_col, text_col)
    return scored.select(id_col, F.coalesce(fold(id_col, folds) == held, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))
