"""Benchmark decontamination by spaced seeds that tolerate word substitutions.

A spaced seed is a mask over a window of words: the hash covers the words at the mask's
positions and ignores the others, so a window still hits where the ignored words were
replaced.  Several fixed masks ignore different positions.

1. every window of every benchmark item is hashed under every mask (the test hashes);
2. every window of every document is hashed the same way and matched with them;
3. around each hit the two texts are compared word by word along their common alignment:
   the overlap is the longest run of positions around the hit of which at least
   ``min_identity`` agree, cut to begin and end with an equal word;
4. an overlap counts when it has at least ``min_words`` words (or the whole item, when that
   is shorter, but at least ``min_item`` words).

Inner replacements in a whole item of 8 to 15 words are all found, up to one word in five.
Items of fewer than ``min_item`` words count only where all their words are a whole text or
whole sentences of it (up to a full stop, ``!``, ``?`` or line break on both sides).

Words are runs of ASCII letters, digits and non-ASCII characters of the lower-cased text
(letters of all scripts); hashes are 64 bits wide, and a reported overlap has been compared
by the hash of each word.

The documents never move: the job is one narrow pass.  The benchmark is the stated query
set; it is cut into blocks of at most ``block_words`` words, and each block's hashes are
sent to the tasks, so what is broadcast has a fixed bound whatever the benchmark's size;
a larger benchmark takes more passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwood.llm.common import NOT_ALNUM, mix64, slices, text_bytes, word_hashes, word_spans

#: word positions that each mask keeps
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 3, 4, 7, 8), (0, 2, 3, 6, 8, 9), (0, 1, 4, 6, 7, 10), (0, 3, 4, 5, 9, 11),
         (0, 1, 2, 4, 9, 11))
#: further masks, of lower weight, for items of fewer than ``SHORT`` words
SHORT_MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 5, 6))
SHORT = 13
_STEP = np.uint64(0xD6E8FEB86659FD93)
_FILTER_BITS = 23
#: bytes that end a sentence
_STOPS = np.zeros(256, dtype=bool)
_STOPS[list(b".!?\n\r")] = True


def seed_hashes(words: np.ndarray, offsets: np.ndarray, mask: tuple[int, ...], salt: int):
    """Hash and start of every window of ``mask`` that lies inside one text."""
    span = mask[-1] + 1
    n = len(words) - span + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    at = np.flatnonzero(ends[:n] - np.arange(n) >= span)
    h = np.full(len(at), np.uint64(salt + 1))
    for p in mask:
        h = (h ^ words[at + p]) * _STEP
    return mix64(h), at


def sentence_bounds(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether a sentence or text ends before each word; true behind the last word."""
    starts, ends, word_offsets, _ = word_spans(data, offsets, NOT_ALNUM)
    stops = np.concatenate(([0], np.cumsum(_STOPS[data])))
    bound = np.ones(len(starts) + 1, dtype=bool)
    bound[1:-1] = stops[starts[1:]] > stops[ends[:-1]]
    bound[word_offsets] = True
    return bound


class SeedIndex:
    """The hashed windows of one block of benchmark items; ``masks`` for all, ``SHORT_MASKS`` for
    short items, and whole items of fewer than ``min_item`` words."""

    def __init__(self, ids: list, texts: list[str], masks=MASKS, min_item: int = 8):
        self.ids = ids
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        self.words, self.offsets = word_hashes(data, offsets, NOT_ALNUM)
        lengths = np.diff(self.offsets)
        self.item_of = np.repeat(np.arange(len(lengths)), lengths)
        length_of = np.repeat(lengths, lengths)
        whole = [tuple(range(n)) for n in range(1, min_item) if (lengths == n).any()]
        self.masks, self.tables = [*masks, *SHORT_MASKS, *whole], []
        self.first_whole = len(masks) + len(SHORT_MASKS)
        for m, mask in enumerate(self.masks):
            h, at = seed_hashes(self.words, self.offsets, mask, m)
            if m >= self.first_whole:
                fits = length_of[at] == len(mask)
            else:
                fits = (length_of[at] >= min_item) & ((m < len(masks)) | (length_of[at] < SHORT))
            h, at = h[fits], at[fits]
            order = np.argsort(h, kind="stable")
            self.tables.append((h[order], at[order]))
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        for h, _ in self.tables:
            self.filter[h >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, words: np.ndarray, offsets: np.ndarray, bounds) -> tuple[np.ndarray, np.ndarray]:
        """(text word, item word) positions of all window matches, one per alignment and place.

        ``bounds()`` gives the text's ``sentence_bounds``; asked for only if there are whole items.
        """
        left, right = [], []
        bound = bounds() if len(self.masks) > self.first_whole else None
        for m, mask in enumerate(self.masks):
            table, where = self.tables[m]
            if not len(table):
                continue
            h, at = seed_hashes(words, offsets, mask, m)
            if m >= self.first_whole:
                alone = bound[at] & bound[at + len(mask)]
                h, at = h[alone], at[alone]
            some = np.flatnonzero(self.filter[h >> np.uint64(64 - _FILTER_BITS)])
            lo = np.searchsorted(table, h[some], side="left")
            n = np.searchsorted(table, h[some], side="right") - lo
            if n.sum() == 0:
                continue
            which = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            left.append(np.repeat(at[some], n))
            right.append(where[which])
        if not left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(left), np.concatenate(right)


def extend(equal: np.ndarray, at: int, identity: float) -> tuple[int, int]:
    """The longest run [start, end) over position ``at`` with at least ``identity`` equal words.

    With the gains 1 - identity for an equal and -identity for another word, a run has enough
    equal words when its gains sum to 0 or more.
    """
    total = np.concatenate(([0.0], np.cumsum(np.where(equal, 1 - identity, -identity))))
    # the highest sum at or behind each end; the last end that reaches a start's sum is its best
    behind = np.maximum.accumulate(total[at + 1:][::-1])[::-1]
    starts = np.flatnonzero(equal[:at + 1])
    reach = len(behind) - np.searchsorted(behind[::-1], total[starts] - 1e-9)
    ok = reach > 0
    if not ok.any():
        return at, at
    starts, ends = starts[ok], at + reach[ok]
    best = int((ends - starts).argmax())
    start, end = int(starts[best]), int(ends[best])
    while end > start and not equal[end - 1]:
        end -= 1
    return start, end


def overlaps(index: SeedIndex, words: np.ndarray, lo: int, hi: int, left: np.ndarray, right: np.ndarray,
             min_words: int, min_identity: float):
    """Verified overlaps of the text ``words[lo:hi]``: (item, start, end, item start, equal words)."""
    done: dict[tuple[int, int], int] = {}
    item_of, item_offsets = index.item_of, index.offsets
    for i, j in sorted(zip(left.tolist(), right.tolist(), strict=True)):
        item, diagonal = int(item_of[j]), i - j
        if done.get((item, diagonal), -1) > i:
            continue
        a, b = int(item_offsets[item]), int(item_offsets[item + 1])
        x, y = max(lo, a + diagonal), min(hi, b + diagonal)
        equal = words[x:y] == index.words[x - diagonal:y - diagonal]
        s, e = extend(equal, i - x, min_identity)
        done[(item, diagonal)] = max(i, x + e)
        same = int(equal[s:e].sum())
        # the windows of an item of fewer than min_item words are the whole item
        need = min(min_words, b - a)
        if e - s >= need:
            yield item, x + s - lo, x + e - lo, x + s - diagonal - a, same


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int,
                     min_item: int = 8) -> Iterator[SeedIndex]:
    """The benchmark in blocks of bounded size, streamed through the driver one by one."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(id_col, F.lower(text_col)).filter(F.col(text_col).isNotNull())
    for row in rows.toLocalIterator():
        n = len(row[1]) // 2 + 1
        if texts and size + n > block_words:
            yield SeedIndex(ids, texts, min_item=min_item)
            ids, texts, size = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        size += n
    if texts:
        yield SeedIndex(ids, texts, min_item=min_item)


def contaminated_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          item_col: str = "item_id", item_text_col: str = "text", min_words: int = 13,
                          min_identity: float = 0.8, min_item: int = 8,
                          block_words: int = 2_000_000) -> DataFrame:
    """Verified overlaps: ``id_col, item_id, start_word, end_word, item_start_word, same_words``.

    One row per (document, item, alignment, place); a clean document has no row.  Word
    positions count the words defined above from 0.  Null and empty texts, on either side,
    overlap nothing; items with fewer than ``min_item`` words match only equal whole texts or
    sentences.  Repeated rows are reported once per row.  An empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    schema = (docs.select(id_col).schema.add("item_id", benchmark.schema[item_col].dataType)
              .add("start_word", "long").add("end_word", "long").add("item_start_word", "long")
              .add("same_words", "long"))

    def scan(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids, texts = batch.column(0), batch.column(1)
                found: list[tuple] = []
                for lo, hi in slices(texts):
                    data, offsets = text_bytes(texts.slice(lo, hi - lo))
                    words, at = word_hashes(data, offsets, NOT_ALNUM)
                    left, right = index.hits(words, at, lambda data=data, offsets=offsets: sentence_bounds(data, offsets))
                    if not len(left):
                        continue
                    order = np.argsort(left, kind="stable")
                    left, right = left[order], right[order]
                    rows = np.searchsorted(at, left, side="right") - 1
                    for mine in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(rows)) + 1):
                        row = int(rows[mine[0]])
                        found += [(lo + row, *x) for x in overlaps(
                            index, words, int(at[row]), int(at[row + 1]), left[mine], right[mine],
                            min_words, min_identity)]
                if found:
                    cols = list(zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(cols[0], pa.int64())),
                         pa.array([index.ids[i] for i in cols[1]]),
                         *(pa.array(c, pa.int64()) for c in cols[2:])], names=schema.names)
        return run

    out = None
    for index in benchmark_blocks(benchmark, item_col, item_text_col, block_words, min_item):
        part = docs.select(id_col, F.lower(text_col)).mapInArrow(scan(spark.sparkContext.broadcast(index)), schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage; columns unchanged.

    Rows with a null id are judged together: they go when one of them is contaminated.
    """
    hits = contaminated_passages(docs, benchmark, id_col, **options).select(id_col).distinct()
    hits = hits.withColumnRenamed(id_col, "_hit")
    return docs.join(hits, docs[id_col].eqNullSafe(hits["_hit"]), "left_anti")
