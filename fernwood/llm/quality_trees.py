"""Quality rules: fixed limits on document statistics, then gradient-boosted trees over them.

Statistics.  Every whole text is read as bytes, in groups of a bounded size: a byte histogram,
word and line hashes and 8-word windows give the statistics of ``FEATURES``.  Words, lines and
windows are compared by 64-bit hashes.

Base rules.  A text fails with fewer than 20 words, or where more than 30 % of its words lie in
8-word windows that occur twice or more in it.

Trees.  The others are judged by boosted regression trees on the log loss: histogram splits over
at most ``BINS`` values per statistic, second-order leaf values with shrinkage.  For the statistics
in ``FALLING`` a higher value may never raise the score: a split whose children's values are
the wrong way round is not taken, and both children are held to their own side of the mean of the
two values, so the whole tree and the sum of trees fall in that statistic.  All trees are kept
as flat numpy arrays (statistic, threshold, children, value); rows walk down them together, one
array step per level.

The trees are fitted on the driver on the statistics (never the texts) of at most ``max_rows``
labelled rows, taken in the order of a hash of their id; scoring is a narrow job over all rows.

Defined results: a null text counts as empty; empty and short texts fail the base rules; repeated
rows get equal results; ids may be null; of several labels of an id the lowest counts, null and
other labels than 0 and 1 are not used; without rows of both labels every score is 0.5; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernwood.llm.byte_cnn import held_out
from fernwood.llm.common import SPACE, mix64, shingle_hashes, slices, text_bytes, word_spans

#: the statistics, in order; the first five are counts that the base rules and the query use
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "top_share",
            "letter_share", "digit_share", "upper_share", "stop_per_word", "mark_per_word", "wide_share", "words_per_line",
            "longest_word", "entropy")
#: statistics whose rise may never raise the score
FALLING = ("symbol_share", "dup_line_share", "repeat_share")
BINS = 64

MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8


# ---------------------------------------------------------------- statistics

_BASE = 0x9E3779B97F4A7C15 | 1
_CHUNK = 1 << 20
_NEWLINE = np.arange(256) == 10


def _bytes_of(chars: bytes) -> np.ndarray:
    t = np.zeros(256)
    t[list(chars)] = 1
    return t


_STARTS = (np.arange(256) & 0xC0 != 0x80).astype(float)  # first bytes of characters
_CLASSES = np.stack([
    _STARTS * ~SPACE,
    _bytes_of(b"#*$%&|<>"),
    _bytes_of(bytes(range(65, 91)) + bytes(range(97, 123))) + (np.arange(256) >= 0xC3) * _STARTS,
    _bytes_of(b"0123456789"),
    _bytes_of(bytes(range(65, 91))),
    _bytes_of(b".?!"),
    _bytes_of(b",;:'\"()-/"),
    (np.arange(256) >= 0xC0).astype(float),
    _bytes_of(b"\n"),
], axis=1)


def byte_histograms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bytes of each row by value, ``rows x 256``, in chunks of the data."""
    n = len(offsets) - 1
    out = np.zeros(n * 256, np.int64)
    for lo in range(0, len(data), _CHUNK):
        hi = min(lo + _CHUNK, len(data))
        part = np.clip(offsets, lo, hi)
        rows = np.flatnonzero(part[1:] > part[:-1])
        first = int(rows[0])
        row = np.repeat(rows - first, np.diff(part)[rows])
        counts = np.bincount(row * 256 + data[lo:hi], minlength=(int(rows[-1]) - first + 1) * 256)
        out[first * 256:first * 256 + len(counts)] += counts
    return out.reshape(n, 256)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of bytes (spans in order, none overlaps), in chunks of the data."""
    out = np.zeros(len(starts), np.uint64)
    if len(starts) == 0:
        return out
    up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(_CHUNK, np.uint64(_BASE))]))
    down = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(_CHUNK, np.uint64(pow(_BASE, -1, 1 << 64)))]))
    for lo in range(0, len(data), _CHUNK):
        hi = min(lo + _CHUNK, len(data))
        a, b = np.searchsorted(ends, lo, side="right"), np.searchsorted(starts, hi)
        if a >= b:
            continue
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:hi - lo], out=sums[1:])
        begin = starts[a:b] - lo
        piece = sums[np.minimum(ends[a:b], hi) - lo] - sums[np.maximum(begin, 0)]
        shift = down[np.maximum(begin, 0)]
        if begin[0] < 0:  # only the first span can come from the chunk before
            shift[0] = np.uint64(pow(_BASE, int(-begin[0]), 1 << 64))
        out[a:b] += piece * shift
    return mix64(out)


def _rows_of(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def _repeats(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For items sorted by (row, hash): their order, the first of each run of equals, and run lengths."""
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    return order, first, np.diff(np.append(first, len(r)))


def _dup_lines(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    begin, end, line_offsets, _ = word_spans(data, offsets, _NEWLINE)
    rows = _rows_of(line_offsets)
    worded = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    hashes = span_hashes(data, begin, end)
    # what two lines have in common also has the same words, so lines without one drop out first
    rows, hashes = rows[worded], hashes[worded]
    order, first, size = _repeats(rows, hashes)
    return np.bincount(rows[order][first], size - 1, n).astype(np.int64)


def _repeat_words(words: np.ndarray, word_offsets: np.ndarray, n: int) -> np.ndarray:
    """Words that lie in a window found twice or more in their row."""
    windows, window_offsets = shingle_hashes(words, word_offsets, WINDOW)
    rows = _rows_of(window_offsets)
    order, first, size = _repeats(rows, windows)
    again = np.zeros(len(windows), bool)
    again[order[np.repeat(size, size) > 1]] = True
    at = np.flatnonzero(again)
    begin = at - window_offsets[rows[at]] + word_offsets[rows[at]]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + WINDOW, -1)
    inside = np.cumsum(cover[:-1]) > 0
    return np.bincount(_rows_of(word_offsets)[inside], minlength=n).astype(np.int64)


def statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``COUNTS`` (rows x 5, whole numbers) and ``FEATURES`` of a column of texts."""
    counts, features = [np.zeros((0, len(COUNTS)), np.int64)], [np.zeros((0, len(FEATURES)))]
    for lo, hi in slices(column):
        data, offsets = text_bytes(column.slice(lo, hi - lo))
        n = hi - lo
        hist = byte_histograms(data, offsets)
        chars, symbols, letters, digits, upper, stops, marks, wide, newlines = (hist @ _CLASSES).T
        if len(data):
            starts, ends, word_offsets, _ = word_spans(data, offsets)
        else:
            starts = ends = np.zeros(0, np.int64)
            word_offsets = np.zeros(n + 1, np.int64)
        words = span_hashes(data, starts, ends)
        n_words = np.diff(word_offsets)
        dup = _dup_lines(data, offsets, starts, n) if len(data) else np.zeros(n, np.int64)
        repeat = _repeat_words(words, word_offsets, n)
        rows = _rows_of(word_offsets)
        order, first, size = _repeats(rows, words)
        distinct = np.bincount(rows[order][first], minlength=n)
        top, longest = np.zeros(n), np.zeros(n)
        np.maximum.at(top, rows[order][first], size)
        np.maximum.at(longest, rows, ends - starts)
        one = np.maximum(n_words, 1)
        total = np.maximum(hist.sum(axis=1), 1)
        share = hist / total[:, None]
        entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
        counts.append(np.stack([n_words, chars.astype(np.int64), symbols.astype(np.int64), dup, repeat], axis=1))
        features.append(np.stack([
            np.log1p(n_words), chars / one, symbols / np.maximum(chars, 1), dup / (newlines + 1), repeat / one, distinct / one,
            top / one, letters / np.maximum(chars, 1), digits / np.maximum(chars, 1), upper / np.maximum(letters, 1), stops / one,
            marks / one, wide / np.maximum(chars, 1), n_words / (newlines + 1), np.log1p(longest), entropy], axis=1))
    return np.concatenate(counts), np.concatenate(features)


# ---------------------------------------------------------------- trees

@dataclass
class Trees:
    """All trees in flat arrays; a leaf is its own child.  ``roots`` are the first nodes."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaf values of every row, before the logistic function."""
        out = np.full(len(x), self.bias)
        for lo in range(0, len(x), 4096):
            part = x[lo:lo + 4096]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            row = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                at = np.where(part[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out[lo:lo + 4096] += self.value[at].sum(axis=1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, falling: tuple[int, ...], n_trees: int = 120, depth: int = 4, rate: float = 0.1,
              smoothing: float = 1.0, min_weight: float = 2.0) -> Trees:
    """Boosted trees on the log loss; ``falling`` are the features with a falling constraint."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    flat = bins + np.arange(x.shape[1]) * BINS
    mean = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    bias = float(np.log(mean / (1 - mean)))
    margin = np.full(len(y), bias)
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []
    falls = np.isin(np.arange(x.shape[1]), falling)

    def leaf(value: float) -> int:
        nodes.append([0, 0.0, len(nodes), len(nodes), value])
        return len(nodes) - 1

    def grow(rows: np.ndarray, grad: np.ndarray, weight: np.ndarray, left_depth: int, low: float, high: float) -> int:
        g, h = grad[rows].sum(), weight[rows].sum()
        value = float(np.clip(-g / (h + smoothing), low, high))
        at = leaf(rate * value)
        if left_depth == 0 or len(rows) < 2:
            margin[rows] += rate * value
            return at
        size = x.shape[1] * BINS
        gl, hl = (np.cumsum(np.bincount(flat[rows].ravel(), np.repeat(w[rows], x.shape[1]), size).reshape(-1, BINS), axis=1)
                  for w in (grad, weight))
        gr, hr = g - gl, h - hl
        vl, vr = (np.clip(-a / (b + smoothing), low, high) for a, b in ((gl, hl), (gr, hr)))
        # the loss of a clipped value, not of the free optimum
        gain = -(gl * vl + 0.5 * (hl + smoothing) * vl ** 2) - (gr * vr + 0.5 * (hr + smoothing) * vr ** 2) + (
            g * value + 0.5 * (h + smoothing) * value ** 2)
        gain[(hl < min_weight) | (hr < min_weight)] = -np.inf
        gain[falls[:, None] & (vl < vr)] = -np.inf
        best = int(np.argmax(gain))
        if gain.ravel()[best] <= 1e-9:
            margin[rows] += rate * value
            return at
        f, b = divmod(best, BINS)
        goes = bins[rows, f] <= b
        bounds = (low, high), (low, high)
        if falls[f]:
            middle = (vl[f, b] + vr[f, b]) / 2
            bounds = (middle, high), (low, middle)
        left = grow(rows[goes], grad, weight, left_depth - 1, *bounds[0])
        right = grow(rows[~goes], grad, weight, left_depth - 1, *bounds[1])
        nodes[at][:4] = [f, float(cuts[f][b]), left, right]
        return at

    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), depth, -np.inf, np.inf))
    feature, threshold, left, right, value = zip(*nodes, strict=True)
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(roots), depth,
                 bias)


# ---------------------------------------------------------------- Spark jobs

def _with_statistics(docs: DataFrame, id_col: str, text_col: str, extra: list, run) -> DataFrame:
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *extra])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *run(batch.column(1))], names=schema.names)
    return docs.select(id_col, text_col).mapInArrow(each, schema)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``COUNTS`` and the array ``features`` of every document."""
    def run(column: pa.Array) -> list[pa.Array]:
        counts, features = statistics(column)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(features) + 1) * len(FEATURES), pa.int32()),
                                         pa.array(features.ravel(), pa.float64()))
        return [*[pa.array(c, pa.int64()) for c in counts.T], lists]
    return _with_statistics(docs, id_col, text_col, [*[T.StructField(c, T.LongType()) for c in COUNTS],
                                                     T.StructField("features", T.ArrayType(T.DoubleType()))], run)


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, max_rows: int, id_col: str = "doc_id",
                  text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``max_rows`` labelled rows that are not held out."""
    marked = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(
        F.col(id_col).alias("_id")).agg(F.min(label_col).cast("double").alias("_label"))
    few = marked.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = document_statistics(named.join(F.broadcast(few.select("_id")), "_id"), "_id", "_text")
    rows = found.select("_id", "features").join(F.broadcast(few), "_id").orderBy(
        F.xxhash64("_id"), "_id", "features").limit(max_rows).select("features", "_label").toArrow()
    x = np.array(rows.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
    return x, rows.column("_label").to_numpy()


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  max_rows: int = 20000, threshold: float = 0.3) -> DataFrame:
    """``id_col``, ``COUNTS``, ``base_failed``, ``kept`` and ``score`` of every document.

    ``max_rows`` bounds the labelled rows that the trees are fitted on; a document that passes the
    base rules is kept where its score reaches ``threshold``.
    """
    spark = docs.sparkSession
    x, y = training_rows(docs, labels, label_col, max_rows, id_col, text_col)
    falling = tuple(FEATURES.index(f) for f in FALLING)
    trees = spark.sparkContext.broadcast(fit_trees(x, y, falling) if 0 < y.sum() < len(y) else None)

    def run(column: pa.Array) -> list[pa.Array]:
        counts, features = statistics(column)
        score = np.full(len(counts), 0.5) if trees.value is None else trees.value.score(features)
        failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > REPEAT_PERCENT * counts[:, 0])
        return [*[pa.array(c, pa.int64()) for c in counts.T], pa.array(failed), pa.array(~failed & (score >= threshold)),
                pa.array(score, pa.float64())]
    return _with_statistics(docs, id_col, text_col, [
        *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()), T.StructField("score", T.DoubleType())], run)
