"""Quality classifier: a byte-level convolutional network in numpy.

Method.  A document is read as bytes.  Each byte has a learned embedding and
channels that say whether it equals the byte 2..15 places before, so repetition
is visible to a linear filter.  Learned filters of 16 bytes slide in steps of 8,
in overlapping windows that cover the whole document; a document of any length
is cut into chunks, each read with the bytes before and after it that its
windows need, so chunks and batches never change a score.  The filter outputs
are max-pooled over all windows and combined by a logistic unit into one
probability.

Training.  The weights are fitted on the driver, on a bounded sample of labelled
rows that are not held out: at most ``TRAIN_PER_CLASS`` rows of either label, the
first by a hash of the id, each read whole.  Labels, language, source and ids are
never inputs of a score.

Defined results: null and empty texts get the score of padding alone; rows that
repeat an id are scored each; equal texts get scores that agree to 1e-6 (single
precision sums differ in their last digit by batch); an id with several
labels has the lower one; labels that are null or not 0/1 are not learned from;
without labels of both kinds every score is the share of label 1 (or 0.5); very
long texts are read chunk by chunk; an empty table gives none.  Columns of
``docs`` are carried; one that has the name of the output gives way to it, so
name the output otherwise to keep both.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import free_name, table, whole_text

THRESHOLD = 0.3
TRAIN_PER_CLASS = 800
EPOCHS = 14
STEP, EMBED, FILTERS = 8, 6, 16
LAGS = tuple(range(2, 16))
LEAD = 2 * STEP  # whole blocks that hold the bytes of the longest lag
CHANNELS = EMBED + len(LAGS)
CHUNK = 1 << 18  # bytes at a time, a multiple of STEP


def held_out(col="doc_id"):
    """Rows that are never learned from."""
    return F.crc32(F.col(col).cast("string")) % 5 == 0


class Network:
    """Weights as plain arrays, so a network travels in a task's closure."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.embed[0] = 0
        self.filters = rng.normal(0, 0.12, (FILTERS, 2 * STEP * CHANNELS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.3, FILTERS).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)

    def channels(self, data: np.ndarray) -> np.ndarray:
        x = np.zeros((len(data), CHANNELS), np.float32)
        x[:, :EMBED] = self.embed[data]
        for c, lag in enumerate(LAGS):
            x[lag:, EMBED + c] = (data[lag:] == data[:-lag]) & (data[lag:] != 0)
        return x

    def windows(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Filter outputs before the bias at every window, and the blocks they read."""
        blocks = self.channels(data).reshape(-1, STEP * CHANNELS)
        half = STEP * CHANNELS
        return blocks[:-1] @ self.filters[:, :half].T + blocks[1:] @ self.filters[:, half:].T, blocks

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Max-pooled filter outputs of whole documents."""
        out = np.full((len(texts), FILTERS), -np.inf, np.float32)
        for pieces in chunked(texts):
            data, begins = layout([p.raw for p in pieces])
            value, _ = self.windows(data)
            value[~own_windows(pieces, begins, len(value))] = -np.inf
            np.maximum.at(out, [p.owner for p in pieces], np.maximum.reduceat(value, begins, axis=0))
        return np.maximum(out + self.bias, 0)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities of label 1, to six places: sums of single precision hold no more."""
        z = (self.pooled(texts) * self.out).sum(axis=1, dtype=np.float64) + self.out_bias[0]
        return np.round(1 / (1 + np.exp(-z)), 6)


class Piece(NamedTuple):
    """Bytes of a chunk, with LEAD bytes before it unless it is the first and a block after it unless it is the last."""

    owner: int
    raw: bytes
    first: bool
    last: bool


def chunked(texts: list[bytes], size: int | None = None):
    """Lists of pieces of together about ``size`` bytes that cover every text."""
    size = size or CHUNK
    batch, held = [], 0
    for d, text in enumerate(texts):
        for at in range(0, max(1, len(text)), size):
            last = at + size >= len(text)
            batch.append(Piece(d, text[max(0, at - LEAD) : len(text) if last else at + size + STEP], at == 0, last))
            held += len(batch[-1].raw)
            if held >= size:
                yield batch
                batch, held = [], 0
    if batch:
        yield batch


def own_windows(pieces: list[Piece], begins: np.ndarray, n: int) -> np.ndarray:
    """Which windows lie in one piece and belong to its chunk: none reads into the next document."""
    own = np.ones(n, bool)
    own[begins[1:] - 1] = False
    ends = np.r_[begins[1:] - 1, n]
    for p, b, e in zip(pieces, begins.tolist(), ends.tolist()):
        if not p.first:
            own[b : b + LEAD // STEP] = False
        if not p.last:  # its last block is the next chunk's first, the two after it are padding
            own[e - 2 : e] = False
    return own


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another, each padded to whole blocks and two blocks of zeros."""
    sizes = np.array([(len(t) + STEP - 1) // STEP + 2 for t in texts])
    data = np.zeros(int(sizes.sum()) * STEP, np.uint8)
    begins = np.cumsum(sizes) - sizes
    for b, t in zip(begins, texts):
        data[b * STEP : b * STEP + len(t)] = np.frombuffer(t, np.uint8)
    return data, begins


def _winners(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document and filter: the largest output, the inputs of its window and the bytes under it."""
    n = len(texts)
    top = np.full((n, FILTERS), -np.inf, np.float32)
    seen = np.zeros((n, FILTERS, 2 * STEP * CHANNELS), np.float32)
    under = np.zeros((n, FILTERS, 2 * STEP), np.uint8)
    for pieces in chunked(texts):
        data, begins = layout([p.raw for p in pieces])
        value, blocks = net.windows(data)
        value[~own_windows(pieces, begins, len(value))] = -np.inf
        for p, b, e in zip(pieces, begins, np.r_[begins[1:] - 1, len(value)]):
            best = b + value[b:e].argmax(axis=0)
            won = np.flatnonzero(value[best, np.arange(FILTERS)] > top[p.owner])
            best = best[won]
            top[p.owner, won] = value[best, won]
            seen[p.owner, won] = np.concatenate([blocks[best], blocks[best + 1]], axis=1)
            under[p.owner, won] = data[best[:, None] * STEP + np.arange(2 * STEP)]
    return top, seen, under


def train(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on the logistic loss; gradients flow through the winning windows only."""
    net, rng = Network(seed), np.random.default_rng(seed)
    params = [net.embed, net.filters, net.bias, net.out, net.out_bias]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    for epoch in range(epochs):
        rate = 0.02 * (0.5 if epoch > epochs * 0.6 else 1)
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), 32):
            rows = order[lo : lo + 32]
            top, seen, under = _winners(net, [texts[i] for i in rows])
            z = top + net.bias
            a = np.maximum(z, 0)
            p = 1 / (1 + np.exp(-(a @ net.out + net.out_bias[0])))
            g = ((p - labels[rows]) * weight[rows] / len(rows)).astype(np.float32)
            dz = g[:, None] * net.out * (z > 0)
            d_filters = np.einsum("df,dfi->fi", dz, seen) + 1e-4 * net.filters
            d_in = (dz[:, :, None] * net.filters).reshape(len(rows), FILTERS, 2 * STEP, CHANNELS)[..., :EMBED]
            d_embed = np.zeros_like(net.embed)
            np.add.at(d_embed, under.ravel(), d_in.reshape(-1, EMBED))
            d_embed[0] = 0
            t += 1
            for p_, m, v, d in zip(params, first, second, [d_embed, d_filters, dz.sum(0), g @ a, np.array([g.sum()])]):
                m += 0.1 * (d - m)
                v += 0.01 * (d * d - v)
                p_ -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
    return net


def _raw(batches):
    for pdf in batches:
        yield pd.DataFrame({"quality": pdf["quality"], "raw": [t.encode("utf-8", "surrogatepass") for t in pdf["text"]], "nth": pdf["nth"]})


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> tuple[list[bytes], np.ndarray]:
    """A bounded sample of labelled rows outside the held-out part, as whole texts."""
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    nth = F.xxhash64("doc_id")
    picked = [known.filter(F.col("quality") == q).withColumn("nth", nth).orderBy("nth", "doc_id").limit(per_class) for q in (0, 1)]
    sample = picked[0].unionByName(picked[1])
    # at most 2 * per_class rows by the limits above, so broadcasting is bounded
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(sample), "doc_id").select("quality", "text", "nth")
    # of rows that repeat an id the first by its text counts, so the bound holds for them, too
    once = rows.groupBy("nth", "quality").agg(F.min("text").alias("text"))
    got = sorted(once.mapInPandas(_raw, "quality int, raw binary, nth long").collect(), key=lambda r: (r.nth, bytes(r.raw)))
    return [bytes(r.raw) for r in got], np.array([r.quality for r in got], np.int64)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS):
    """A trained network, or the share of label 1 where only one kind of label is there."""
    texts, y = training_rows(docs, labels, per_class)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    return train(texts, y)


def score_documents(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` with the score under the name ``out``; every whole text is read."""
    fixed = model if isinstance(model, float) else None
    docs = docs.drop(out)
    carried = free_name(docs.columns, "__text")
    plain = docs.withColumn(carried, whole_text(text_col))

    def run(batches):
        for batch in batches:
            if fixed is None and batch.num_rows:
                score = model.score([t.encode("utf-8", "surrogatepass") for t in batch.column(carried).to_pylist()])
            else:
                score = np.full(batch.num_rows, fixed or 0.0)
            kept = batch.drop_columns([carried])
            yield kept.append_column(out, pa.array(score, pa.float64()))

    return plain.mapInArrow(run, StructType(docs.schema.fields + [StructField(out, DoubleType())]))


def predict_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = score_documents(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op8_quality(spark, sf_dir: str) -> DataFrame:
    return predict_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
