"""Helpers shared by the operators: written intermediate tables, skew-safe
look-ups and vectorised word hashing inside tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernwood.session import scratch_path

#: a word is a maximal run of characters outside this ASCII white space
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: a hot key is spread over this many sub-keys
SALTS = 512


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def fresh(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores behind it until no column in ``taken`` has it."""
    names = {c.lower() for c in taken}
    while name.lower() in names:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared checkpoint folder (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def spent(*tables: DataFrame) -> None:
    """Deletes the folders of ``written`` tables.

    Only for tables that nothing reads any more: what was made from them has been written itself.
    """
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def salt_of(*cols: str | Column, salts: int = SALTS) -> Column:
    """A sub-key in [0, salts) drawn from the row's own columns, the same on every retry."""
    return F.pmod(F.xxhash64(*cols), F.lit(salts))


def salted_groups(rows: DataFrame, keys: Sequence[str], spread: Column,
                  aggs: dict[str, tuple[Column, str]], salts: int = SALTS) -> DataFrame:
    """Group totals laid out for a join that no hot key can overload.

    ``aggs`` maps an output name to ``(first-level aggregate, name of the function that
    merges two of them)``.  Returns one row per ``(keys, _salt)`` with the totals of the
    whole key group: a hot key has at most ``salts`` rows here and its rows join on
    ``(keys, _salt)``, so neither side of that join has more than 1/salts of it in one place.
    """
    first = rows.groupBy(*keys, salt_of(spread, salts=salts).alias("_salt")).agg(
        *[agg.alias(name) for name, (agg, _) in aggs.items()])
    first = written(first, "groups")
    total = first.groupBy(*keys).agg(
        *[getattr(F, merge)(name).alias(f"_t_{name}") for name, (_, merge) in aggs.items()])
    parts = first.select(*keys, "_salt")
    return parts.join(total, list(keys)).withColumnsRenamed({f"_t_{n}": n for n in aggs})


def salted_lookup(rows: DataFrame, table: DataFrame, key: str, spread: Column,
                  how: str = "inner", salts: int = 64) -> DataFrame:
    """Join a large ``rows`` with a ``table`` unique on ``key``, hot keys spread.

    The table is repeated once per sub-key that really occurs in ``rows``.
    """
    salted = rows.withColumn("_salt", salt_of(spread, salts=salts))
    wanted = salted.select(key, "_salt").distinct().join(table, key)
    return salted.join(wanted, [key, "_salt"], how).drop("_salt")


#: bits per bit map of Spark's bitmap functions, and the most bit maps that are broadcast (64 MB)
_BITS = 32768
MAX_BITMAPS = 16384


def maybe_among(rows: DataFrame, keys: DataFrame, key: Sequence[str], flag: str) -> DataFrame:
    """``rows`` with a boolean ``flag``: false only for rows whose ``key`` is surely not in ``keys``.

    A Bloom-like test without a shuffle of ``rows``: the hashes of ``keys`` are set in bit
    maps of at most 64 MB in all, which are broadcast.  A wrong true is possible, so an exact
    step has to follow; a null key is tested like any value.
    """
    n_keys, n_maps = keys.count(), 1
    while n_maps < MAX_BITMAPS and n_maps * _BITS < 16 * n_keys:
        n_maps *= 2
    slot = F.pmod(F.xxhash64(*key), F.lit(n_maps * _BITS))
    number, bit = F.floor(slot / _BITS).cast("int"), F.pmod(slot, F.lit(_BITS)).cast("int")
    maps = keys.groupBy(number.alias("_map")).agg(F.bitmap_construct_agg(bit.cast("long")).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    found = rows.withColumns({"_map": number, "_bit": bit}).join(F.broadcast(maps), "_map", "left").withColumn(
        "_byte", byte)
    hit = F.coalesce(F.expr("mod(shiftright(_byte, mod(_bit, 8)), 2)") == 1, F.lit(False))
    return found.withColumn(flag, hit).drop("_map", "_bit", "_bits", "_byte")


# ---------------------------------------------------------------- word hashing in tasks

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xD6E8FEB86659FD93)
_POWERS: list[np.ndarray] = []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (every input bit reaches every output bit)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = []
        for base in (_BASE, inverse):
            p = np.full(size, np.uint64(base), dtype=np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0], _POWERS[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the ``n + 1`` offsets of its rows; null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[np.frombuffer(chars, dtype=np.uint8)] = True
    return t


SPACE = _table(b"\x20\x09\x0a\x0b\x0c\x0d")
#: everything but ASCII letters, digits and non-ASCII bytes separates
NOT_ALNUM = ~(_table(b"0123456789" + UPPER.encode() + LOWER.encode()) | (np.arange(256) >= 128))
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


NO_FOLD = np.arange(256, dtype=np.uint8)


def word_spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE):
    """Start and end byte of every word (run of bytes not in ``breaks``), each row's word offsets,
    and which bytes are inside a word."""
    inside = ~breaks[data]
    start, last = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[first] = inside[first]
    last[first[first > 0] - 1] = inside[first[first > 0] - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets), inside


def word_hashes(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE,
                block: int = 1 << 20, fold: np.ndarray = FOLD) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word in order, A-Z folded by default, and each row's word offsets.

    The hash is a polynomial over the bytes, so it needs no per-word Python; it is made in
    blocks that end between words.
    """
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts, _, word_offsets, inside = word_spans(data, offsets, breaks)
    return _hashes(data, starts, inside, block, fold), word_offsets


def _hashes(data, starts, inside, block, fold) -> np.ndarray:
    n = len(data)
    out = np.empty(len(starts), dtype=np.uint64)
    lo = 0
    while lo < len(starts):
        hi = int(np.searchsorted(starts, starts[lo] + block, side="right"))
        hi = max(hi - 1, lo + 1) if hi < len(starts) else hi
        a, b = int(starts[lo]), int(starts[hi]) if hi < len(starts) else n
        up, down = _powers(b - a)
        part = (fold[data[a:b]].astype(np.uint64) + np.uint64(1)) * inside[a:b] * up[:b - a]
        at = starts[lo:hi] - a
        out[lo:hi] = np.add.reduceat(part, at) * down[at]
        lo = hi
    return mix64(out)


def distinct_words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE, block: int = 1 << 20):
    """The distinct words of all rows: start and end byte of one occurrence each, the number of
    the distinct word that every word is, and each row's word offsets.  Case counts."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(len(offsets), np.int64)
    starts, ends, word_offsets, inside = word_spans(data, offsets, breaks)
    _, one, number = np.unique(_hashes(data, starts, inside, block, NO_FOLD), return_index=True, return_inverse=True)
    return starts[one], ends[one], number, word_offsets


def shingle_hashes(words: np.ndarray, word_offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``size``-word shingles of each row, and each row's shingle offsets.

    A row with some words but fewer than ``size`` has its whole sequence as its one shingle.
    """
    counts = np.diff(word_offsets)
    rows = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(rows, out=offsets[1:])
    total = int(offsets[-1])
    if total == 0:
        return np.zeros(0, np.uint64), offsets
    at = np.arange(total) - np.repeat(offsets[:-1] - word_offsets[:-1], rows)
    left = np.repeat(word_offsets[1:], rows) - at
    out = np.zeros(total, np.uint64)
    for i in range(size):
        have = left > i
        step = words[np.minimum(at + i, len(words) - 1)] * have + have
        out = mix64(out * _STEP + step.astype(np.uint64))
    return out, offsets


def slices(column: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most about ``max_bytes`` of text each (one long row may exceed it)."""
    _, offsets = text_bytes(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi
