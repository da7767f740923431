"""Token ids in fixed-length rows: best-fit-decreasing packing, binary output.

Each text is encoded with a public byte-level BPE vocabulary (a path parameter) and ended
with the end-of-text id.  A document longer than a row is split without loss: full rows of
``row_tokens`` ids, and a rest that is packed like any other piece.  Pieces are packed into
rows by best-fit decreasing: in order of falling length, each goes to the row whose free
space is the smallest that still holds it.  That row is found in a segment tree over the
free spaces 1..``row_tokens`` (a leaf lists the rows with that much space; an inner node says
whether any leaf below it has a row).

Packing is done over windows of at least ``window_tokens`` ids (or what a task has), so a
task holds one window in memory and there is no shuffle; every document is complete in its
window.  Each result row is one row of the id matrix with what is needed to train on it:
cumulative segment lengths, position ids that restart at every segment, and where each
segment came from.  Ids and positions are little-endian binaries of fixed length, so a
written table is a matrix on disk.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fernwood.llm.common import slices

#: the pre-token pattern of the vocabulary file (a fixed value, published with it)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: long runs of the pattern's white space, which its look-ahead would walk back one by one
LONG_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")

_ENCODERS: dict = {}


def schema_of(id_type: str = "bigint") -> str:
    """The columns of a packed table whose documents have ids of this type."""
    return ("pack_id bigint, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, "
            f"doc_ids array<{id_type}>, doc_starts array<bigint>")


def _arrow(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("pack_id", pa.int64()), ("n_tokens", pa.int32()), ("input_ids", pa.binary()),
                      ("position_ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())),
                      ("doc_ids", pa.list_(id_type)), ("doc_starts", pa.list_(pa.int64()))])


def encoder(ranks_file: bytes, pattern: str = PATTERN):
    """The encoder of a vocabulary file's content, made once per Python worker."""
    key = (hash(ranks_file), pattern)
    if key not in _ENCODERS:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        _ENCODERS[key] = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def encoded(made, text: str) -> list[int]:
    """The ids of a text; long runs of white space are handed over as the pieces they are."""
    out, at = [], 0
    for run in LONG_SPACE.finditer(text) if len(text) >= 10000 else ():
        # the pattern keeps a run but for its last character, which may belong to what follows
        end = run.end() - (run.end() < len(text))
        out += made.encode_ordinary(text[at:run.start()])
        out += made._encode_single_piece(text[run.start():end])
        at = end
    return out + made.encode_ordinary(text[at:] if at else text)


class SpaceTree:
    """Rows by free space; ``take(n)`` gives the row with the least space that holds ``n``."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.rows: list[list[int]] = [[] for _ in range(self.size)]
        self.any = bytearray(2 * self.size)

    def put(self, space: int, row: int) -> None:
        self.rows[space].append(row)
        node = space + self.size
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, n: int) -> tuple[int, int] | None:
        node = n + self.size
        if not self.any[node]:
            # up to the first right sibling that has a row, then down its leftmost one
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        space = node - self.size
        row = self.rows[space].pop()
        if not self.rows[space]:
            self.any[node] = 0
            node >>= 1
            while node and not (self.any[2 * node] or self.any[2 * node + 1]):
                self.any[node] = 0
                node >>= 1
        return row, space


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of piece numbers; every length is between 1 and ``capacity``."""
    tree, rows = SpaceTree(capacity), []
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[piece]
        found = tree.take(n)
        if found is None:
            row, space = len(rows), capacity
            rows.append([])
        else:
            row, space = found
        rows[row].append(piece)
        if space > n:
            tree.put(space - n, row)
    return rows


def _pack(pieces: list[tuple], capacity: int, end_id: int, dtype, first_id: int, schema: pa.Schema) -> pa.RecordBatch:
    """One window's pieces ``(doc_id, start, ids)`` as matrix rows."""
    out = [[] for _ in schema]
    for row in best_fit_decreasing([len(p[2]) for p in pieces], capacity):
        ids = np.full(capacity, end_id, dtype)
        positions = np.zeros(capacity, dtype)
        ends = [0]
        for i in row:
            n = len(pieces[i][2])
            ids[ends[-1]:ends[-1] + n] = pieces[i][2]
            positions[ends[-1]:ends[-1] + n] = np.arange(n)
            ends.append(ends[-1] + n)
        values = (first_id + len(out[0]), ends[-1], ids.tobytes(), positions.tobytes(), ends,
                  [pieces[i][0] for i in row], [pieces[i][1] for i in row])
        for column, value in zip(out, values, strict=True):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)


def packed_rows(docs: DataFrame, ranks_path: str, row_tokens: int = 2048, end_id: int = 50256,
                window_tokens: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed id matrix, one DataFrame row per matrix row (:func:`schema_of`).

    ``cu_seqlens`` starts at 0 and ends at ``n_tokens``; behind it ids are ``end_id`` and
    positions 0.  Segment ``k`` holds the ids of document ``doc_ids[k]`` from its id number
    ``doc_starts[k]`` on.  Null and empty texts are a single end id; repeated rows are packed
    each; ids may be null and of any type (whole numbers come back as bigint); an empty table
    gives an empty result; other columns are ignored.  Token ids and positions are uint16 where
    both fit, else uint32.
    """
    spark = docs.sparkSession
    with open(ranks_path, "rb") as f:  # a vocabulary of fixed size, on the driver
        content = f.read()
    shared = spark.sparkContext.broadcast(content)
    top = max(end_id, content.count(b"\n") + 1, row_tokens)
    dtype = np.dtype("<u2") if top < 1 << 16 else np.dtype("<u4")
    whole = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    ids = docs[id_col].cast("long") if whole else docs[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(shared.value)
        next_id = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        pieces, held, schema = [], 0, None
        for batch in batches:
            schema = schema or _arrow(batch.schema.field(0).type)
            for lo, hi in slices(batch.column(1)):
                names = batch.column(0).slice(lo, hi - lo).to_pylist()
                for doc, text in zip(names, batch.column(1).slice(lo, hi - lo).to_pylist(), strict=True):
                    tokens = encoded(made, text) if text else []
                    tokens.append(end_id)
                    tokens = np.array(tokens, dtype)
                    for start in range(0, len(tokens), row_tokens):
                        pieces.append((doc, start, tokens[start:start + row_tokens]))
                    held += len(tokens)
                    if held >= window_tokens:
                        yield (done := _pack(pieces, row_tokens, end_id, dtype, next_id, schema))
                        next_id += done.num_rows
                        pieces, held = [], 0
        if pieces:
            yield _pack(pieces, row_tokens, end_id, dtype, next_id, schema)

    id_type = "bigint" if whole else docs.schema[id_col].dataType.simpleString()
    return docs.select(ids, text_col).mapInArrow(run, schema_of(id_type))


def write_packed(rows: DataFrame, path: str) -> None:
    """The matrix as a Parquet table of fixed-length binaries."""
    rows.write.parquet(path)


def read_packed(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    return spark.read.schema(schema_of(id_type)).parquet(path)


def matrix(column: list[bytes], row_tokens: int) -> np.ndarray:
    """Binaries of one column as a ``rows x row_tokens`` array (dtype by their length)."""
    dtype = np.dtype("<u2") if not column or len(column[0]) == 2 * row_tokens else np.dtype("<u4")
    return np.frombuffer(b"".join(column), dtype).reshape(-1, row_tokens)
