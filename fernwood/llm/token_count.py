"""Token counts of documents under a unigram model, by a trie of distinct pre-tokens.

Method (trie-shared dynamic programming).  A text is cut at white space into
pre-tokens, each marked with the word-start sign of the vocabulary.  The distinct
pre-tokens of a group of texts are inserted in a trie.  A trie node stands for a prefix
and has the best unigram score of that prefix (the forward score) with its number of
tokens; both are computed once per node and so shared by every pre-token that passes
through it.  The node where a pre-token ends holds its count.

The trie is built level by level over the sorted pre-tokens, and all nodes of a level get
their forward scores together in numpy: for every piece length the node's last bytes are
looked up among the pieces by a 64-bit hash.

The pieces come from a public vocabulary file (a path parameter).  Those files hold the
rank of each piece and no probabilities, so piece ``r`` gets the Zipf-Mandelbrot
log-probability ``-ln(r + 2.7)``, up to a constant per piece.  A character that no piece
covers costs one byte token per UTF-8 byte.  Of two segmentations with the same score the
one with fewer tokens wins.

The job is narrow: no shuffle, and a document's counts never depend on its neighbours.
Texts are handled in groups of a bounded number of bytes; very long pre-tokens are scored
one by one along their path.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fernwood.llm.common import distinct_words, slices, text_bytes

WORD_START = "▁"
#: score of one byte token, below any piece
BYTE_SCORE = -14.0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_BITS = 20
#: pre-tokens of more bytes do not enter the trie
MAX_BYTES = 61


def load_pieces(model_path: str) -> dict[bytes, float]:
    """Scores of the pieces of a sentencepiece file, read on the driver."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return {sp.id_to_piece(i).encode(): -math.log(i + 2.7) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}


class Pieces:
    """The pieces by length as sorted hashes with scores, and as a tree for single paths."""

    def __init__(self, scores: dict[bytes, float]):
        self.tree: dict = {}
        by_length: dict[int, list] = {}
        for piece, score in scores.items():
            at, h = self.tree, np.zeros(1, np.uint64)
            for byte in piece:
                at = at.setdefault(byte, {})
                h = h * _BASE + np.uint64(byte + 1)
            at[-1] = score
            by_length.setdefault(len(piece), []).append((h[0], score))
        self.tables, self.maybe = {}, np.zeros(1 << _BITS, bool)
        for length, found in sorted(by_length.items()):
            found.sort()
            hashes = np.array([h for h, _ in found], np.uint64)
            self.tables[length] = (hashes, np.array([s for _, s in found]))
            self.maybe[(hashes * _SPREAD) >> np.uint64(64 - _BITS)] = True
        powers = [np.ones(1, np.uint64)]
        for _ in range(max(by_length, default=0)):
            powers.append(powers[-1] * _BASE)
        self.powers = [p[0] for p in powers]

    def path_count(self, word: bytes) -> int:
        """Tokens of one pre-token, scored along its own path."""
        score, count, begun = 0.0, 0, []
        for byte in word:
            best, tokens, still = score + BYTE_SCORE, count + 1, []
            for s, c, at in [*begun, (score, count, self.tree)]:
                at = at.get(byte)
                if at is None:
                    continue
                still.append((s, c, at))
                if -1 in at and (s + at[-1], -c - 1) > (best, -tokens):
                    best, tokens = s + at[-1], c + 1
            score, count, begun = best, tokens, still
        return count


def trie_counts(words: np.ndarray, lengths: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Tokens of each pre-token; ``words`` is a zero-padded byte matrix, one row each."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    order = np.argsort(np.ascontiguousarray(words).view(f"S{words.shape[1]}").ravel(), kind="stable")
    words, lengths = words[order], lengths[order]
    differ = words[1:] != words[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), words.shape[1])
    shared = np.concatenate(([-1], np.minimum(shared, np.minimum(lengths[1:], lengths[:-1]))))
    # per level: forward score, tokens, prefix hash and parent of every node
    levels = [(np.zeros(1), np.zeros(1, np.int64), np.zeros(1, np.uint64), np.zeros(1, np.int64))]
    node_of, counts = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for depth in range(1, int(lengths.max(initial=0)) + 1):
        here = np.flatnonzero(lengths >= depth)
        new = shared[here] < depth
        first = here[new]
        parent = node_of[first]
        score, tokens, prefix, _ = levels[-1]
        h = prefix[parent] * _BASE + (words[first, depth - 1].astype(np.uint64) + np.uint64(1))
        best, fewest, at = score[parent] + BYTE_SCORE, tokens[parent] + 1, parent
        for length in range(1, min(depth, len(pieces.powers) - 1) + 1):
            begun = levels[depth - length]
            if length in pieces.tables:
                last = h - begun[2][at] * pieces.powers[length]
                some = np.flatnonzero(pieces.maybe[(last * _SPREAD) >> np.uint64(64 - _BITS)])
                hashes, scores = pieces.tables[length]
                place = np.minimum(np.searchsorted(hashes, last[some]), len(hashes) - 1)
                hit = hashes[place] == last[some]
                some, place = some[hit], place[hit]
                s, t = begun[0][at[some]] + scores[place], begun[1][at[some]] + 1
                win = (s > best[some]) | ((s == best[some]) & (t < fewest[some]))
                best[some[win]], fewest[some[win]] = s[win], t[win]
            at = begun[3][at]
        levels.append((best, fewest, h, parent))
        node_of[here] = np.cumsum(new) - 1
        ends = here[lengths[here] == depth]
        counts[ends] = fewest[node_of[ends]]
    out = np.empty(n, np.int64)
    out[order] = counts
    return out


def count_texts(column: pa.Array, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Pre-tokens and tokens of every text of a column (null: empty)."""
    data, offsets = text_bytes(column)
    starts, ends, number, at = distinct_words(data, offsets)
    mark = np.frombuffer(WORD_START.encode(), np.uint8)
    lengths = ends - starts
    short = np.flatnonzero(lengths <= MAX_BYTES)
    counts = np.zeros(len(starts), np.int64)
    width = int(lengths[short].max(initial=0))
    grid = starts[short][:, None] + np.arange(width)
    inside = np.arange(width) < lengths[short][:, None]
    words = np.zeros((len(short), width + len(mark)), np.uint8)
    words[:, :len(mark)] = mark
    if width:
        words[:, len(mark):] = data[np.minimum(grid, len(data) - 1)] * inside
    counts[short] = trie_counts(words, lengths[short] + len(mark), pieces)
    for i in np.flatnonzero(lengths > MAX_BYTES):
        counts[i] = pieces.path_count(mark.tobytes() + data[starts[i]:ends[i]].tobytes())
    total = np.concatenate(([0], np.cumsum(counts[number])))
    return np.diff(at), total[at[1:]] - total[at[:-1]]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 group_bytes: int = 1 << 23) -> DataFrame:
    """One row per document: ``id_col``, ``n_words``, ``n_tokens`` (long).

    Null, empty and white-space texts count 0.  Repeated rows are counted one by one, extra
    columns are ignored, an empty table gives an empty result.  ``group_bytes`` bounds the
    texts whose pre-tokens share a trie (a longer text is a group of its own).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load_pieces(model_path))  # the vocabulary: fixed size
    schema = docs.select(id_col).schema.add("n_words", "long").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi in slices(texts, group_bytes):
                words, tokens = count_texts(texts.slice(lo, hi - lo), pieces)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                    names=[id_col, "n_words", "n_tokens"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)
