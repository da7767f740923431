"""A byte-level convolutional network for text quality, in numpy.

The whole text is read as UTF-8 bytes.  Two branches of learned filters slide over
overlapping chunks that together cover every byte:

* shape filters see chunks of 16 bytes (a new chunk every 8 bytes), each byte as a fixed
  vector of ``DIM`` numbers (byte class indicators and fixed pseudo-random numbers);
* rhythm filters see chunks of 64 bytes (a new chunk every 32 bytes), each as the shares of
  its bytes that equal the byte 1, 2, ... 32 places before, which is how a convolution can
  see repeated words.

Each filter's ReLU output is max-pooled and mean-pooled over the document; one logistic
layer combines the pooled values into a probability.  Training is plain Adam on the log
loss with hand-written gradients, seeded, on a bounded sample of labelled rows.  Scoring is a
narrow job; a document's score depends on its own bytes only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernwood.llm.common import fresh, slices, text_bytes

UNIT = 32
STEP = 8
DIM = 12
LAGS = 32
#: bytes of text that are laid out at once (about 100 bytes of memory each)
PIECE = 1 << 18


def byte_vectors() -> np.ndarray:
    """The fixed ``256 x DIM`` byte vectors; byte 0 (padding) is all zeros."""
    b = np.arange(256)
    upper, lower, digit = (b >= 65) & (b <= 90), (b >= 97) & (b <= 122), (b >= 48) & (b <= 57)
    sign = (b > 32) & (b < 127) & ~(upper | lower | digit)
    classes = [upper, lower, digit, sign, b == 32, b == 10, b >= 128]
    random = np.random.default_rng(7).normal(size=(256, DIM - len(classes))) * 0.5
    out = np.concatenate([np.stack(classes, axis=1).astype(float), random], axis=1)
    out[0] = 0
    return out.astype(np.float32)


_VECTORS = byte_vectors()


@dataclass
class Filters:
    """The learned numbers of the network."""

    shape: np.ndarray     # (2, STEP * DIM, n): weights of the two halves of a chunk
    shape_bias: np.ndarray
    rhythm: np.ndarray    # (2, LAGS, m)
    rhythm_bias: np.ndarray
    dense: np.ndarray     # 2 * (n + m)
    bias: np.ndarray      # (1,)

    def arrays(self) -> list[np.ndarray]:
        return [self.shape, self.shape_bias, self.rhythm, self.rhythm_bias, self.dense, self.bias]


def new_filters(n: int = 24, m: int = 8, seed: int = 3) -> Filters:
    rng = np.random.default_rng(seed)

    def draw(*shape, scale):
        return (rng.normal(size=shape) * scale).astype(np.float32)

    return Filters(draw(2, STEP * DIM, n, scale=0.1), np.zeros(n, np.float32), draw(2, LAGS, m, scale=0.3),
                   np.zeros(m, np.float32), draw(2 * (n + m), scale=0.1), np.zeros(1, np.float32))


def repeats(buf: np.ndarray) -> np.ndarray:
    """Of every unit the shares of its bytes that equal the byte 1, 2, ... ``LAGS`` places before."""
    same = np.empty((len(buf) // UNIT, LAGS), np.float32)
    real = buf != 0
    for lag in range(1, LAGS + 1):
        equal = np.zeros(len(buf), bool)
        equal[lag:] = (buf[lag:] == buf[:-lag]) & real[lag:]
        same[:, lag - 1] = np.bitwise_count(np.packbits(equal).view(np.uint32))
    return same / UNIT


class Packed:
    """Texts laid out for the filters: each padded with zeros to whole units, two at least."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        lengths = np.diff(offsets)
        self.units = np.maximum(-(-lengths // UNIT), 2)
        at = np.concatenate(([0], np.cumsum(self.units)))
        self.first = at[:-1]
        buf = np.zeros(int(at[-1]) * UNIT, np.uint8)
        for i in range(len(lengths)):
            s = int(at[i]) * UNIT
            buf[s:s + lengths[i]] = data[offsets[i]:offsets[i + 1]]
        self.vectors = _VECTORS[buf].reshape(-1, STEP * DIM)
        self.same = repeats(buf)
        self.same[self.first] = 0  # a text's first unit has no bytes before it

    def branch(self, rows: np.ndarray, weights: np.ndarray, bias: np.ndarray, per: int):
        """Pre-activations per chunk; the chunk that would reach into the next text is 0."""
        z = rows @ weights[0]
        z[:-1] += (rows[1:] @ weights[1])
        z += bias
        z[(self.first + self.units) * per - 1] = 0
        return z

    def forward(self, net: Filters):
        out, saved = [], []
        for rows, weights, bias, per in ((self.vectors, net.shape, net.shape_bias, UNIT // STEP),
                                         (self.same, net.rhythm, net.rhythm_bias, 1)):
            z = np.maximum(self.branch(rows, weights, bias, per), 0)
            chunks = (self.units * per - 1)[:, None]
            out += [np.maximum.reduceat(z, self.first * per, axis=0),
                    np.add.reduceat(z, self.first * per, axis=0) / chunks]
            saved.append((rows, z, per, chunks))
        pooled = np.concatenate(out, axis=1)
        return pooled @ net.dense + net.bias[0], pooled, saved


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def gradients(net: Filters, batch: Packed, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean log loss over one batch, in the order of ``Filters.arrays``."""
    logit, pooled, saved = batch.forward(net)
    g = ((sigmoid(logit) - y) / len(y)).astype(np.float32)
    into = g[:, None] * net.dense[None, :]
    grads, at = [], 0
    for (rows, z, per, chunks), weights in zip(saved, (net.shape, net.rhythm), strict=True):
        n = weights.shape[2]
        top, mean = into[:, at:at + n], into[:, at + n:at + 2 * n] / chunks
        dz = np.repeat(mean, batch.units * per, axis=0) * (z > 0)
        for i, (s, c) in enumerate(zip(batch.first * per, batch.units * per, strict=True)):
            best = z[s:s + c].argmax(axis=0)
            cols = np.flatnonzero(z[s + best, np.arange(n)] > 0)
            dz[s + best[cols], cols] += top[i, cols]
        grads += [np.stack([rows.T @ dz, rows[1:].T @ dz[:-1]]), dz.sum(axis=0)]
        at += 2 * n
    return [*grads, pooled.T @ g, np.array([g.sum()])]


def fit(texts: list[str], labels: list[int], steps: int = 400, batch: int = 16, rate: float = 4e-3,
        seed: int = 5) -> Filters:
    """Train on a bounded sample for ``steps`` batches, in whole passes; texts are used whole."""
    net, rng = new_filters(), np.random.default_rng(seed)
    y = np.asarray(labels, np.float32)
    moments = [(np.zeros_like(a), np.zeros_like(a)) for a in net.arrays()]
    per_pass = max(1, -(-len(texts) // batch))
    passes = max(1, -(-steps // per_pass))
    step, total = 0, passes * per_pass
    for _ in range(passes):
        order = rng.permutation(len(texts))
        for lo in range(0, len(texts), batch):
            pick = order[lo:lo + batch]
            data, offsets = text_bytes(pa.array([texts[i] for i in pick], pa.string()))
            step += 1
            now = rate * (1 - 0.9 * step / total)
            for a, g, (m, v) in zip(net.arrays(), gradients(net, Packed(data, offsets), y[pick]), moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                a -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
    return net


def long_logit(net: Filters, data: np.ndarray, piece: int = PIECE) -> float:
    """The logit of one text of more than ``UNIT`` bytes, read in pieces.

    A piece holds the chunks that begin in its units: it reads one unit before it (for the
    rhythm) and one behind it (where its last chunks end), and adds to a running maximum and
    sum of every filter.  Memory is bounded by ``piece`` and not by the text.
    """
    units, per = -(-len(data) // UNIT), UNIT // STEP
    step = max(1, piece // UNIT)
    tops, sums = [], []
    for a in range(0, units, step):
        lo, hi = max(a - 1, 0), min(a + step + 1, units)
        buf = np.zeros((hi - lo) * UNIT, np.uint8)
        bytes_ = data[lo * UNIT:hi * UNIT]
        buf[:len(bytes_)] = bytes_
        same = repeats(buf)
        if a == 0:
            same[0] = 0
        begin, end = a - lo, min(a + step, units) - lo
        found = []
        for rows, weights, bias, n in ((_VECTORS[buf].reshape(-1, STEP * DIM), net.shape, net.shape_bias, per),
                                       (same, net.rhythm, net.rhythm_bias, 1)):
            first, last = begin * n, min(end * n, len(rows) - 1)  # a chunk is two rows
            z = rows[first:last] @ weights[0] + rows[first + 1:last + 1] @ weights[1] + bias
            found.append(np.maximum(z, 0))
        tops.append([z.max(axis=0, initial=0) for z in found])
        sums.append([z.sum(axis=0, dtype=np.float64) for z in found])
    out = []
    for i, n in enumerate((per, 1)):
        out += [np.max([t[i] for t in tops], axis=0), np.sum([s[i] for s in sums], axis=0) / (units * n - 1)]
    return float(np.concatenate(out) @ net.dense + net.bias[0])


def predict(net: Filters, column: pa.Array, piece: int = PIECE) -> np.ndarray:
    """Probabilities of a column of texts (null: empty); a text longer than ``piece`` is read in pieces."""
    out = []
    for lo, hi in slices(column, piece):
        data, offsets = text_bytes(column.slice(lo, hi - lo))
        if hi == lo + 1 and len(data) > max(piece, UNIT):
            out.append(sigmoid(np.array([long_logit(net, data, piece)])))
            continue
        out.append(sigmoid(Packed(data, offsets).forward(net)[0].astype(np.float64)))
    return np.concatenate(out) if out else np.zeros(0)


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, eligible, max_rows: int,
                    id_col: str = "doc_id", text_col: str = "text",
                    max_bytes: int = 1 << 18) -> tuple[list[str], list[int]]:
    """At most ``max_rows`` labelled texts of at most ``max_bytes`` each, half of each class where there are enough.

    Both bounds are on what the driver holds; longer texts are left out of the sample whole.

    Rows are taken in the order of a hash of their id, so the sample is the same on every
    run.  Rows without a label (null) or with a label other than 0 and 1 are not used.
    """
    texts, marks = [], []
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).filter(eligible(F.col("_id")))
    for mark in (0, 1):
        few = marked.filter(F.col("_label") == mark).select("_id").distinct().orderBy(
            F.xxhash64("_id"), "_id").limit(max_rows // 2)
        found = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(
            F.broadcast(few), "_id").filter(F.octet_length("_text") <= max_bytes).orderBy(F.xxhash64("_id"), "_id", "_text").limit(max_rows // 2)
        got = [r["_text"] for r in found.select("_text").collect()]
        texts += got
        marks += [mark] * len(got)
    return texts, marks


def held_out(doc_id):
    """The rows that no label is learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scored_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                 max_rows: int, out: str) -> DataFrame:
    """All columns of ``docs`` and ``out``, the score of a network fitted on rows that are not held out."""
    spark = docs.sparkSession
    texts, marks = training_sample(docs, labels, label_col, lambda i: i.isNotNull() & ~held_out(i), max_rows,
                                   id_col, text_col)
    net = spark.sparkContext.broadcast(fit(texts, marks) if 0 < sum(marks) < len(marks) else None)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = np.full(b.num_rows, 0.5) if net.value is None else predict(net.value, b.column(at))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score, pa.float64())],
                                             names=[*b.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", max_rows: int = 1000, threshold: float = 0.3) -> DataFrame:
    """The rows whose score reaches ``threshold``, columns unchanged."""
    score = fresh("_score", docs.columns)
    return scored_rows(docs, labels, id_col, text_col, label_col, max_rows, score).filter(
        F.col(score) >= threshold).drop(score)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", max_rows: int = 1000, threshold: float = 0.3) -> DataFrame:
    """``id_col, held_out, score, predicted`` for every row of ``docs``.

    ``max_rows`` bounds the labelled rows the network is fitted on (on the driver, texts of
    at most 256 KB); every whole text is scored, a very long one in pieces.  Null and empty texts get the score of no bytes; repeated rows get
    equal scores; without any usable label the score is 0.5; an empty table gives an empty
    result.  A null id is never held out.
    """
    scored = scored_rows(docs.select(id_col, text_col), labels, id_col, text_col, label_col, max_rows, "_score")
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), F.col("_score").alias("score"),
                         (F.col("_score") >= threshold).cast("int").alias("predicted"))
