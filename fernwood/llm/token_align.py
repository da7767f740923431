"""Alignment of two tokenizers over the same bytes, by divide and conquer at shared cuts.

Every text (with one space in front) is encoded by a byte-level BPE vocabulary (A) and by a
piece vocabulary with byte fallback (B).  Byte offsets where tokens of both end are shared cuts;
they part the tokens into groups that cover the same bytes.

Method.  An interval is a run of A tokens and a run of B tokens over the same bytes.  From the
end of its middle A token a common end is looked for by bisection: the next end of B at or behind
it, the next end of A at or behind that, and so on until both meet; where that is only the
interval's own end, the same is done towards the front.  A common end cuts the interval in two,
which are divided in turn; an interval without a cut, or with a single token on a side, is a
leaf, that is a group.  All intervals of a depth are divided together in numpy.

An id pair is linked where its tokens end together.  One of the two is then a suffix of the other,
so the number of different pairs is bounded by the bytes of both vocabularies, whatever the
corpus (:func:`most_pairs`): pair counts of a task and of the whole corpus fit in memory and in a
broadcast.  Documents are encoded once; no text is shuffled.

Texts that are null or empty, or whose tokens' bytes differ from the text (the piece vocabulary
normalises some), have no tokens.  Ids may be of any type, null and repeated; very long texts are
handled whole (white space runs that the encoder's pattern can't take are cut as the pattern
would); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernwood.llm.common import slices, written
from fernwood.llm.packing import PATTERN

#: a run of white space that is encoded apart from the rest of its text
LONG_SPACE = re.compile(r"\s{20000,}")


# ---------------------------------------------------------------- vocabularies

def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: printable Latin-1 characters
    stand for themselves, the others for 256, 257, ... in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_level_tokens(content: bytes) -> dict[bytes, int]:
    """Bytes and id of every token of a byte-level BPE file; ids must follow the order of merges."""
    model, letters = json.loads(content)["model"], byte_letters()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"]["".join(p)] for p in pairs]
    if made != sorted(made) or made[0] < 256:
        raise ValueError("the ids of this vocabulary do not follow the order of its merges")
    return {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}


def _piece_bytes(sp) -> list[bytes]:
    def one(i: int) -> bytes:
        piece = sp.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode()
    return [one(i) for i in range(sp.get_piece_size())]


class Encoders:
    """Both encoders with the bytes of every id."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        import sentencepiece
        import tiktoken

        ranks = byte_level_tokens(byte_level)
        self.a = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.bytes_b = _piece_bytes(self.b)
        self.size_a, self.size_b = (np.array([len(t) for t in x]) for x in (self.bytes_a, self.bytes_b))

    def encode_a(self, text: str) -> list[int]:
        out, at = [], 0
        for run in LONG_SPACE.finditer(text) if len(text) > 20000 else ():
            # the pattern keeps a run but for its last character, which may belong to what follows
            end = run.end() - (run.end() < len(text))
            out += self.a.encode_ordinary(text[at:run.start()])
            out += self.a._encode_single_piece(text[run.start():end])
            at = end
        return out + self.a.encode_ordinary(text[at:] if at else text)

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of both for every text; none where the bytes are not those of the text."""
        filled = [t or "" for t in texts]
        out = []
        for text, b in zip(filled, self.b.encode(filled, num_threads=1), strict=True):
            whole = b" " + text.encode()
            if not text or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
                out.append(([], []))
                continue
            a = self.encode_a(" " + text)
            out.append((a, b) if b"".join(map(self.bytes_a.__getitem__, a)) == whole else ([], []))
        return out


_MADE: dict = {}


def encoders(content: tuple[bytes, bytes]) -> Encoders:
    """Made once per Python worker."""
    key = tuple(hashlib.sha256(c).digest() for c in content)
    if key not in _MADE:
        _MADE[key] = Encoders(*content)
    return _MADE[key]


def most_pairs(bytes_a: list[bytes], bytes_b: list[bytes]) -> int:
    """No more id pairs than this can end together: the shorter token is a suffix of the longer."""
    def fits(of: list[bytes], among: list[bytes]) -> int:
        count: dict[bytes, int] = {}
        for token in among:
            count[token] = count.get(token, 0) + 1
        return sum(count.get(token[i:], 0) for token in of for i in range(len(token)))
    return fits(bytes_a, bytes_b) + fits(bytes_b, bytes_a)


# ---------------------------------------------------------------- divide and conquer

def _meet(ends_a, ends_b, x, i, j, low_a, low_b, forward: bool):
    """From offset ``x`` on, step to the next end of B, then of A, ... until both have it.

    Returns token numbers ``i, j`` of the common end; -1 where the front of the interval is passed.
    """
    todo = np.arange(len(x))
    while len(todo):
        if forward:
            j[todo] = np.searchsorted(ends_b, x[todo])
            same = ends_b[j[todo]] == x[todo]
        else:
            j[todo] = np.searchsorted(ends_b, x[todo], side="right") - 1
            out = j[todo] < low_b[todo]
            i[todo[out]] = -1
            todo = todo[~out]
            same = ends_b[j[todo]] == x[todo]
        todo = todo[~same]
        x[todo] = ends_b[j[todo]]
        if forward:
            i[todo] = np.searchsorted(ends_a, x[todo])
            same = ends_a[i[todo]] == x[todo]
        else:
            i[todo] = np.searchsorted(ends_a, x[todo], side="right") - 1
            out = i[todo] < low_a[todo]
            i[todo[out]] = -1
            todo = todo[~out]
            same = ends_a[i[todo]] == x[todo]
        todo = todo[~same]
        x[todo] = ends_a[i[todo]]
    return i, j


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, docs_a: np.ndarray, docs_b: np.ndarray):
    """The groups of all documents: the end (a token number) of each on both sides, in order.

    ``ends_a`` and ``ends_b`` are rising byte offsets of token ends over all documents in a row,
    ``docs_a`` and ``docs_b`` the token numbers where documents begin and end (``n + 1`` each).
    """
    some = docs_a[1:] > docs_a[:-1]
    al, ah, bl, bh = docs_a[:-1][some], docs_a[1:][some], docs_b[:-1][some], docs_b[1:][some]
    leaves_a, leaves_b = [], []
    while len(al):
        open_ = (ah - al > 1) & (bh - bl > 1)
        leaves_a.append(ah[~open_])
        leaves_b.append(bh[~open_])
        al, ah, bl, bh = al[open_], ah[open_], bl[open_], bh[open_]
        mid = al + (ah - al) // 2 - 1
        i, j = _meet(ends_a, ends_b, ends_a[mid], mid.copy(), bl.copy(), al, bl, True)
        back = np.flatnonzero(i == ah - 1)  # only the interval's own end lies behind the middle
        back = back[mid[back] > al[back]]
        i[i == ah - 1] = -1
        if len(back):
            start = mid[back] - 1
            i[back], j[back] = _meet(ends_a, ends_b, ends_a[start], start.copy(), bl[back].copy(), al[back], bl[back], False)
        cut = i >= 0
        leaves_a.append(ah[~cut])
        leaves_b.append(bh[~cut])
        al, ah, bl, bh, i, j = al[cut], ah[cut], bl[cut], bh[cut], i[cut] + 1, j[cut] + 1
        al, ah, bl, bh = (np.concatenate(x) for x in ((al, i), (i, ah), (bl, j), (j, bh)))
    a = np.concatenate([*leaves_a, np.zeros(0, np.int64)]).astype(np.int64)
    b = np.concatenate([*leaves_b, np.zeros(0, np.int64)]).astype(np.int64)
    order = np.argsort(a)
    return a[order], b[order]


def _offsets(lists: list[list[int]]) -> np.ndarray:
    out = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=out[1:])
    return out


def _flat(lists: list[list[int]], total: int) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, total)


class Aligned:
    """Tokens and groups of a slice of texts: ids in a row, where each document's begin, and the
    number of tokens of the slice up to every group's end."""

    def __init__(self, made: Encoders, column: pa.Array):
        both = made.encode(column.to_pylist())
        self.docs_a, self.docs_b = _offsets([x for x, _ in both]), _offsets([x for _, x in both])
        self.a = _flat([x for x, _ in both], self.docs_a[-1])
        self.b = _flat([x for _, x in both], self.docs_b[-1])
        self.ends_a, self.ends_b = shared_cuts(np.cumsum(made.size_a[self.a]), np.cumsum(made.size_b[self.b]),
                                               self.docs_a, self.docs_b)
        self.groups = np.searchsorted(self.ends_a, self.docs_a, side="right")

    def own_ends(self) -> tuple[np.ndarray, np.ndarray]:
        """The groups' ends as token numbers of their own document."""
        n = np.diff(self.groups)
        return self.ends_a - np.repeat(self.docs_a[:-1], n), self.ends_b - np.repeat(self.docs_b[:-1], n)


def _per_slice(docs: DataFrame, byte_level_path: str, piece_path: str, id_col: str, text_col: str,
               extra: list[T.StructField], columns) -> DataFrame:
    """``id_col`` and ``extra`` for every document, ``columns(aligned slice)`` giving the latter."""
    content = []
    for path in (byte_level_path, piece_path):  # vocabularies of fixed size, on the driver
        with open(path, "rb") as f:
            content.append(f.read())
    shared = docs.sparkSession.sparkContext.broadcast(tuple(content))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoders(shared.value)
        for batch in batches:
            for lo, hi in slices(batch.column(1), 1 << 18):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *columns(Aligned(made, batch.column(1).slice(lo, hi - lo)))],
                    names=schema.names)
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def aligned_tokens(docs: DataFrame, byte_level_path: str, piece_path: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id_col, a_ids, b_ids, a_ends, b_ends`` per document: both token sequences, and for every
    group the number of tokens up to its end.  The files are read on the driver."""
    def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))

    def columns(x: Aligned) -> list[pa.Array]:
        a_ends, b_ends = x.own_ends()
        return [lists(x.a, x.docs_a), lists(x.b, x.docs_b), lists(a_ends, x.groups), lists(b_ends, x.groups)]
    ints = T.ArrayType(T.IntegerType())
    return _per_slice(docs, byte_level_path, piece_path, id_col, text_col,
                      [T.StructField(n, ints) for n in ("a_ids", "b_ids", "a_ends", "b_ends")], columns)


# ---------------------------------------------------------------- counts and digests

def _decimal_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0..size-1 as bytes, and their lengths."""
    length = np.array([len(str(i)) for i in range(size)])
    table = np.zeros((size, int(length.max()) + 1), np.uint8)
    for i in range(size):
        table[i, :length[i]] = np.frombuffer(str(i).encode(), np.uint8)
    return table, length


_TABLES: dict[int, tuple] = {}


def groups_text(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the decimal ids of every group in order."""
    if len(a) == 0:
        return b""
    size = 1 << int(max(a.max(), b.max())).bit_length()
    if size not in _TABLES:
        _TABLES[size] = _decimal_table(size)
    table, length = _TABLES[size]
    # A tokens of a group stand before its B tokens
    group_a, group_b = (np.repeat(np.arange(len(e)), np.diff(e, prepend=0)) for e in (a_ends, b_ends))
    at_a = np.arange(len(a)) + np.concatenate([[0], b_ends])[group_a]
    at_b = np.arange(len(b)) + a_ends[group_b]
    ids = np.empty(len(a) + len(b), np.int64)
    ids[at_a], ids[at_b] = a, b
    behind = np.full(len(ids), ord(","), np.uint8)
    behind[at_a[a_ends - 1]] = ord("|")
    behind[at_b[b_ends - 1]] = ord(";")
    rows, digits = table[ids], length[ids]
    rows[np.arange(len(ids)), digits] = behind
    return rows[np.arange(rows.shape[1]) <= digits[:, None]].tobytes()[:-1]


def _binaries(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Each document's part of ``values`` as little-endian uint32."""
    held = values.astype("<u4")
    return pa.array([held[i:j].tobytes() for i, j in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of :func:`_binaries`, and where each document's begin."""
    parts = [np.frombuffer(x, "<u4") for x in column.to_pylist()]
    return np.concatenate([*parts, np.zeros(0, "<u4")]).astype(np.int64), _offsets(parts)


def linked_documents(docs: DataFrame, byte_level_path: str, piece_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``id_col, n_a, n_b, n_groups, groups_sha256, link_a, link_b``: counts and digest of the
    groups, and the ids of the two tokens that end together at the end of every group (binaries
    of little-endian uint32)."""
    def columns(x: Aligned) -> list[pa.Array]:
        digests, (own_a, own_b) = [], x.own_ends()
        for k in range(len(x.groups) - 1):
            g = slice(x.groups[k], x.groups[k + 1])
            text = groups_text(x.a[x.docs_a[k]:x.docs_a[k + 1]], x.b[x.docs_b[k]:x.docs_b[k + 1]], own_a[g], own_b[g])
            digests.append(hashlib.sha256(text).hexdigest() if text else "")
        return [*[pa.array(np.diff(o), pa.int64()) for o in (x.docs_a, x.docs_b, x.groups)], pa.array(digests, pa.string()),
                _binaries(x.a[x.ends_a - 1], x.groups), _binaries(x.b[x.ends_b - 1], x.groups)]
    return _per_slice(docs, byte_level_path, piece_path, id_col, text_col, [
        *[T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups")], T.StructField("groups_sha256", T.StringType()),
        T.StructField("link_a", T.BinaryType()), T.StructField("link_b", T.BinaryType())], columns)


def pair_counts(linked: DataFrame) -> DataFrame:
    """``pair, n``: how many links hold each id pair (``pair`` is ``a * 2^32 + b``).

    Every task adds up its own pairs; their number is bounded by :func:`most_pairs`.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                some, n = np.unique((_ids(part.column(0))[0] << 32) | _ids(part.column(1))[0], return_counts=True)
                all_pairs, number = np.unique(np.concatenate([pairs, some]), return_inverse=True)
                counts = np.bincount(number, np.concatenate([counts, n]), len(all_pairs)).astype(np.int64)
                pairs = all_pairs
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])
    return linked.select("link_a", "link_b").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def alignment_summary(docs: DataFrame, byte_level_path: str, piece_path: str, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Per document ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``n_best`` counts links whose pair is as frequent in the corpus as any pair of their B id,
    ``count_sum`` adds up the corpus counts of the document's links.
    """
    spark = docs.sparkSession
    linked = written(linked_documents(docs, byte_level_path, piece_path, id_col, text_col), "linked")
    counted = pair_counts(linked).toArrow()  # bounded by the vocabularies, see most_pairs
    pairs, counts = counted.column("pair").to_numpy(), counted.column("n").to_numpy()
    order = np.argsort(pairs)
    pairs, counts = pairs[order], counts[order]
    b_ids, number = np.unique(pairs & 0xFFFFFFFF, return_inverse=True)
    highest = np.zeros(len(b_ids), np.int64)
    np.maximum.at(highest, number, counts)
    shared = spark.sparkContext.broadcast((pairs, counts, counts == highest[number]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                a, offsets = _ids(part.column(5))
                found = np.searchsorted(pairs, (a << 32) | _ids(part.column(6))[0])
                n_best, total = (np.diff(np.concatenate([[0], np.cumsum(v[found])])[offsets]) for v in (best.astype(np.int64), counts))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], part.column(3), pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), part.column(4)],
                    names=schema.names)

    schema = T.StructType([linked.schema[id_col], *[T.StructField(n, T.LongType()) for n in (
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], T.StructField("groups_sha256", T.StringType())])
    return linked.mapInArrow(run, schema)
