"""Secrets in texts: fixed patterns, and dictionary-primed zstandard novelty.

Base spans, leftmost and not overlapping per kind (code points, end exclusive):

* ``assign``: a key word, a separator and a value of at least 6 characters;
* ``access``: an access key id of at least 20 characters;
* ``hex``: a run of at least 24 lower-case hexadecimal digits.

The method adds ``novel`` spans.  A candidate is a run of key characters near a sensitive
word, mixing letters and digits, or letters of both cases that do not read as words.  It is compressed with a zstandard dictionary made of
the identifiers, and the words in them, that are common around sensitive words in the whole input
and of the text around the candidate.  The marginal bytes (the frame of a known beginning and the
candidate minus that of the beginning alone, so a frame is never stored raw because little is
saved) per character are small for names, words and repeated values, and close to one
for random strings: candidates at or above ``novelty`` are reported.

Two narrow passes: the first counts the identifiers near sensitive words (partial counts,
then a top-k of fixed size, broadcast), the second scans and scores.  Only texts that pass
one linear regular-expression test are taken apart in Python.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwood.llm.common import slices

# fixed values: the base kinds in their order, with the least length of the checked group
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.ASCII | re.IGNORECASE), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    # the leftmost matches of [0-9a-f]+ are its maximal runs, and short ones fail
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
KINDS = ("assign", "access", "hex", "novel")
SENSITIVE = ("password", "passwd", "secret", "token", "api_?key", "credential", "private_?key", "access_?key",
             "auth", "bearer", "signature")
_NEAR = re.compile("|".join(SENSITIVE), re.ASCII | re.IGNORECASE)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+")
# words joined by underscores, each with a short number at most: random strings do not look so
_IDENTIFIER = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z]+[0-9]{0,2}(?:_[A-Za-z]+[0-9]{0,2})*(?![A-Za-z0-9_])", re.ASCII)
# the words of identifiers without digits (camel case, capitals)
_WORDS = re.compile(r"[A-Z]?[a-z]{3,}|[A-Z]{4,}")
#: bytes of the dictionary in front of a candidate
_KNOWN = 64
#: zstandard codes the letters of runs of this many bytes
_CODED = 64
#: texts without this hold no base span and no candidate
_SOME = "(?i:" + "|".join(SENSITIVE) + ")|AKIA|[0-9a-f]{24}"


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """``(start, kind number, end, start of the checked group)`` of the base spans, in order.

    The checked group ends where its span does.
    """
    found = []
    for kind, (_, pattern, group, least) in enumerate(BASE):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), kind, m.end(), m.start(group)))
    return sorted(found)


def mixed(run: str) -> bool:
    """Whether a run has letters and digits, or letters of both cases of which under 0.8 are in words."""
    letters = sum(c.isalpha() for c in run)
    if any(c.isdigit() for c in run):
        return letters > 0
    return run.lower() != run != run.upper() and 5 * sum(map(len, _WORDS.findall(run))) < 4 * letters


def candidates(text: str, taken: list[tuple[int, ...]], reach: int, least: int):
    """``mixed`` runs of key characters, close behind or before a sensitive word."""
    end, passed, reached = 0, 0, 0  # base spans before a run are passed once, as runs come in order
    spans = sorted((span[0], span[2]) for span in taken)
    for near in _NEAR.finditer(text):
        lo, hi = max(end, near.start() - reach), min(len(text), near.end() + reach)
        if _CANDIDATE.match(text, lo):  # the run may have begun before the window
            while lo > end and _CANDIDATE.match(text, lo - 1, lo):
                lo -= 1
        for m in _CANDIDATE.finditer(text, lo, hi):
            s, e = m.span()
            if e == hi:  # the run may go on behind the window
                e = _CANDIDATE.match(text, s).end()
            if s < end:
                continue
            end = e
            run = text[s:e]
            while passed < len(spans) and spans[passed][0] < e:
                reached = max(reached, spans[passed][1])
                passed += 1
            if e - s >= least and mixed(run) and reached <= s:
                yield s, e


def novelty(text: str, start: int, end: int, identifiers: bytes, around: int, level: int = 5) -> float:
    """Marginal compressed bytes per byte of ``text[start:end]``.

    From 64 bytes on zstandard also codes single letters by their frequency, so random runs of
    few letters would look known: there a negative level is taken, which codes repeats only.
    """
    import zstandard as zstd

    run = text[start:end].encode()
    level = level if len(run) < _CODED else -1
    primed = identifiers + text[max(0, start - around):start].encode() + b" " + text[end:end + around].encode()
    # a dictionary shorter than 8 bytes is not accepted
    coder = zstd.ZstdCompressor(level=level, write_content_size=False, dict_data=zstd.ZstdCompressionDict(
        primed.rjust(8), dict_type=zstd.DICT_TYPE_RAWCONTENT))
    known = primed[:_KNOWN]
    return (len(coder.compress(known + run)) - len(coder.compress(known))) / max(1, len(run))


def _flagged(texts: pa.Array) -> pa.Array:
    return pc.fill_null(pc.match_substring_regex(texts, _SOME), False)


def identifier_dictionary(docs: DataFrame, text_col: str = "text", size: int = 2000, around: int = 200) -> bytes:
    """The ``size`` identifiers and words of identifiers found near sensitive words in most documents, as zstandard priming.

    Rare first: zstandard finds matches near the end of a dictionary cheapest.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                texts = batch.column(0).slice(lo, hi - lo)
                words: list[str] = []
                for text in texts.filter(_flagged(texts)).to_pylist():
                    mine: set[str] = set()
                    for near in _NEAR.finditer(text):
                        for m in _IDENTIFIER.finditer(text, max(0, near.start() - around), near.end() + around):
                            if 4 <= m.end() - m.start() <= 40:
                                mine.add(m.group())
                                mine.update(w for w in _WORDS.findall(m.group()) if len(w) >= 4)
                    words += sorted(mine)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string())], names=["word"])

    common = (docs.select(text_col).mapInArrow(run, "word string").groupBy("word").count()
              .filter("count > 1").orderBy(F.desc("count"), "word").limit(size))
    return " ".join(r["word"] for r in reversed(common.collect())).encode()


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_novelty: float = 0.85,
                 least: int = 16, reach: int = 40, around: int = 200, dictionary_size: int = 2000) -> DataFrame:
    """One row per document: ``id_col`` and ``spans array<struct<kind, start, end, novelty>>``.

    Spans are sorted by start, then kind; base spans stay whatever their novelty, which is that of
    the checked group (low for values that are common or repeated around).  Null and empty texts have none; repeated rows get equal results; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(identifier_dictionary(docs, text_col, dictionary_size, around))
    schema = (f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, "
              "spans array<struct<kind: string, start: bigint, end: bigint, novelty: double>>")
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("novelty", pa.float64())]))

    def spans_of(text: str) -> list[dict]:
        base = base_spans(text)
        found = [(s, k, e, novelty(text, at, e, shared.value, around)) for s, k, e, at in base]
        for s, e in candidates(text, base, reach, least):
            score = novelty(text, s, e, shared.value, around)
            if score >= least_novelty:
                found.append((s, 3, e, score))
        return [{"kind": KINDS[k], "start": s, "end": e, "novelty": n}
                for s, k, e, n in sorted(found, key=lambda x: x[:3])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                texts = batch.column(1).slice(lo, hi - lo)
                flags = _flagged(texts).to_pylist()
                spans = [spans_of(texts[i].as_py()) if flags[i] else [] for i in range(len(flags))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(spans, arrow)],
                                                 names=[id_col, "spans"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def span_digest(found: DataFrame, kinds: tuple[str, ...], id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, SHA-256 of the base spans and all spans as text, from ``spans``."""
    def joined(keep=None):
        spans = F.col("spans") if keep is None else F.filter("spans", keep)
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def base(s):
        return s["kind"].isin(*kinds)

    def of(kind):
        return lambda s: s["kind"] == kind

    counts = [F.size(F.filter("spans", of(k))).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select(id_col, *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined().alias("spans"))

