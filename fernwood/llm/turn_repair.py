"""Repair of conversation structure by a generalised LR parse of the role sequence.

Legal role initials are ``(s?(ua)+)?``, as a left-recursive grammar::

    Dialog -> (empty) | Pairs | s Pairs          Pairs -> u a | Pairs u a

Method.  The rows of a conversation are read in order by an LR automaton of that grammar whose
stacks form a graph: a node is an automaton state with a link to the node below it.  At every
row each stack top may *keep* the row (shift its role), *rerole* it (shift ``u`` or ``a``) or
*delete* it, and between rows it may *insert* an empty ``u`` or ``a`` row.  Tops with the same
state merge; the smaller ``(cost, audit)`` stays, where the audit is the string of edit initials
``K R D I`` so far.  (At equal cost no audit is a proper prefix of another one that has read the
same rows, so the smaller one stays smaller whatever follows.)  The answer is the smallest pair
of a top that may end the dialog.

Scale.  A conversation may hold any share of the rows, so none is handled as a whole:

* positions come from a range-bucketed rank over slim rows (ids, role, hashes; no texts);
* positions are cut in blocks of ``BLOCK`` rows.  A block is parsed once from every state it may
  begin in; its result is a small table ``(start, end) -> (cost, audit)``;
* tables of neighbouring blocks combine ``FAN`` at a time, level by level, as the parse is
  associative; then the chosen states go back down to the blocks.  Conversations of up to
  ``BLOCK`` rows need no level;
* repeats are found by the smallest position per (conversation, role, text), and texts meet
  their edits once, on keys that only identical rows share.

An audit is as long as its conversation, and so is the text that a digest covers: the digest
streams over sorted rows, holding one batch.

Defined results: a null role or text counts as one space, a null conversation id is a
conversation, null turns come first; rows of the same turn are ordered by role, then by a hash
of the row.  Roles and texts are compared by 128 bits of hashes.  An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernwood.llm.common import written
from fernwood.operators.ranking import global_rank

#: costs of the edits
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: rows of a block, and blocks that combine at a time
BLOCK, FAN = 256, 64

#: the LR automaton: shifts, what a completed right side pops, and the state behind Pairs
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (4, "u"): 5, (5, "a"): 6}
POPS = {3: 2, 6: 3}
PAIRS = {0: 4, 1: 4}
ENDS = (0, 4)
#: a stack for every state that can be on top after reductions
STACKS = {0: (0, None), 1: (1, (0, None)), 2: (2, (0, None)), 4: (4, (0, None)), 5: (5, (4, (0, None)))}

#: how a row is written in a block's code: its initial, upper case if truncated; other roles; rows to delete
OTHER, OTHER_TRUNCATED, GONE = "-", "_", "x"


def shifted(node: tuple, role: str) -> tuple | None:
    """The stack after ``role`` and the reductions that follow it, None where it can't come."""
    state = SHIFT.get((node[0], role))
    if state is None:
        return None
    node = (state, node)
    while node[0] in POPS:
        for _ in range(POPS[node[0]]):
            node = node[1]
        node = (PAIRS[node[0]], node)
    return node


def _offer(tops: dict, node: tuple, cost: int, audit: str) -> bool:
    """Merge a stack into the tops; True where it is the smaller of its state."""
    held = tops.get(node[0])
    if held is not None and held[1:] <= (cost, audit):
        return False
    tops[node[0]] = (node, cost, audit)
    return True


def _inserts(tops: dict) -> dict:
    """The tops with any number of inserted rows behind each."""
    todo = list(tops.values())
    while todo:
        node, cost, audit = todo.pop()
        if tops[node[0]][1:] != (cost, audit):
            continue  # replaced meanwhile
        for role in "ua":
            to = shifted(node, role)
            if to is not None and _offer(tops, to, cost + INSERT, audit + "I"):
                todo.append(tops[to[0]])
    return tops


@lru_cache(maxsize=1 << 16)
def parse_block(code: str, start: int) -> dict[int, tuple[int, str]]:
    """``end state -> (cost, audit)`` for a block of rows read from the state ``start``."""
    tops = _inserts({start: (STACKS[start], 0, "")})
    for c in code:
        after: dict = {}
        for node, cost, audit in tops.values():
            _offer(after, node, cost + DELETE, audit + "D")
            if c == GONE:
                continue
            extra = TRUNCATED if c == OTHER_TRUNCATED or c.isupper() else 0
            to = shifted(node, c.lower())
            if to is not None:
                _offer(after, to, cost + extra, audit + "K")
            for role in "ua":
                to = shifted(node, role)
                if to is not None:
                    _offer(after, to, cost + extra + REROLE, audit + "R")
        tops = _inserts(after)
    return {state: (cost, audit) for state, (_, cost, audit) in tops.items()}


def combined(blocks: list[dict]) -> dict[tuple[int, int], tuple[int, str, tuple[int, ...]]]:
    """Tables ``(start, end) -> (cost, audit)`` of neighbours as one table, with each one's end state."""
    out = {}
    for first in {s for s, _ in blocks[0]}:
        tops: dict[int, tuple] = {first: (0, "", ())}
        for table in blocks:
            after: dict[int, tuple] = {}
            for (s, e), (cost, audit) in table.items():
                if s in tops:
                    new = (tops[s][0] + cost, tops[s][1] + audit, (*tops[s][2], e))
                    if e not in after or new[:2] < after[e][:2]:
                        after[e] = new
            tops = after
        for e, found in tops.items():
            out[first, e] = found
    return out


def replay(code: str, audit: str, start: int) -> list[tuple[int, str, str]]:
    """The rows that stay or are new: ``(row number, edit, role initial)``; an inserted row has the
    number of the row it stands before (the block's length at its end)."""
    out, at, node = [], 0, STACKS[start]
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        # K shifts the row's own role; what R and I shift follows from the state
        role = code[at].lower() if edit == "K" else next(r for r in "ua" if shifted(node, r))
        node = shifted(node, role)
        out.append((at, edit, role))
        at += edit != "I"
    return out


# ---------------------------------------------------------------- rows, faults and positions

def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """The rows with deterministic damage, drawn by ``crc32('conv:turn') % 20`` (nulls: one space).

    0 drops a row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes its role ``user``.
    """
    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(text_of(conv_col), F.lit(":"), text_of(turn_col)).cast("binary")) % 20
    rows = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), text_of("role").alias("role"),
        text_of("text").alias("text"), draw.alias("_draw")).filter(F.col("_draw") != 0)
    return rows.select(
        "conv_id", "turn", F.when(F.col("_draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_draw") == 1, "").when(F.col("_draw") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def _conv_key(col: str) -> Column:
    """A key that is never null and differs for null."""
    return F.when(F.col(col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(col).cast("string")))


def _row_keys() -> list[Column]:
    return [F.xxhash64("turn", "role", "text").alias("_k1"),
            F.xxhash64(F.lit(1), F.col("text"), F.lit(2), F.col("role"), F.lit(3), F.col("turn")).alias("_k2")]


def checked_rows(rows: DataFrame) -> DataFrame:
    """Slim rows ``_c, turn, pos, initial, fault`` with the row's keys; ``fault`` is the first of
    blank, duplicate and truncated, or null.  ``rows`` has conv_id, turn, role, text, and may have
    ``copy`` (the number of an adjacent repeat)."""
    text = F.col("text")
    if "copy" not in rows.columns:
        rows = rows.withColumn("copy", F.lit(0))
    slim = rows.select(
        _conv_key("conv_id").alias("_c"), "turn", "copy", F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce(text, F.lit(" ")).alias("text")).select(
        "_c", "turn", "role", "copy", *_row_keys(),
        F.xxhash64("role", "text").alias("_d1"), F.xxhash64(F.lit(4), F.col("text"), F.lit(5), F.col("role")).alias("_d2"),
        (~text.rlike(r"[^\x20\x09-\x0D]")).alias("_blank"),
        (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("_cut"))
    order = [(c, True) for c in ("turn", "role", "_k1", "_k2", "copy")]
    ranked = written(global_rank(slim, order, ["_c"], "pos"), "turns")
    first = ranked.groupBy("_c", "_d1", "_d2").agg(F.min("pos").alias("pos")).select("_c", "pos", F.lit(True).alias("_first"))
    fault = (F.when(F.col("_blank"), "blank").when(F.col("_first").isNull(), "duplicate")
             .when(F.col("_cut"), "truncated"))
    return written(ranked.join(first, ["_c", "pos"], "left").select(
        "_c", "pos", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), "_k1", "_k2"), "faults")


# ---------------------------------------------------------------- blocks

_TABLE = "_c string, node bigint, start int, end int, cost bigint, audit string, mids array<int>"


def _blocks(rows: DataFrame) -> DataFrame:
    """``_c, node, code, previous``: each block's code and the initial of the row before it."""
    plain = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise(F.lit(OTHER))
    cut = F.when(F.col("initial").isin("s", "u", "a"), F.upper("initial")).otherwise(F.lit(OTHER_TRUNCATED))
    code = (F.when(F.col("fault").isin("blank", "duplicate"), F.lit(GONE))
            .when(F.col("fault") == "truncated", cut).otherwise(plain))
    node = F.floor((F.col("pos") - 1) / BLOCK)
    # a block's last row is also given to the next block, for the pair across the cut
    copies = F.when(F.col("pos") % BLOCK == 0, F.array(node, node + 1)).otherwise(F.array(node))
    many = rows.select("_c", "pos", plain.alias("role"), code.alias("code"), F.explode(copies).alias("node"))
    held = many.groupBy("_c", "node").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "code"))).alias("rows"))
    own = F.filter("rows", lambda r: r["pos"] > F.col("node") * BLOCK)
    return held.select("_c", "node", F.array_join(F.transform(own, lambda r: r["code"]), "").alias("code"),
                       F.array_join(F.transform("rows", lambda r: r["role"]), "").alias("roles")).filter(F.col("code") != "")


def _record(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_TABLE_ARROW = pa.schema([("_c", pa.string()), ("node", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                          ("cost", pa.int64()), ("audit", pa.string()), ("mids", pa.list_(pa.int32()))])


def _in_parts(found: Iterator[tuple], schema: pa.Schema, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in found:
        held.append(row)
        if len(held) == rows:
            yield _record(schema, held)
            held = []
    if held:
        yield _record(schema, held)


def _block_tables(blocks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            def found(batch=batch):
                for c, node, code in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                    for start in (0,) if node == 0 else STACKS:
                        for end, (cost, audit) in parse_block(code, start).items():
                            yield c, node, start, end, cost, audit, None
            yield from _in_parts(found(), _TABLE_ARROW)
    return blocks.select("_c", "node", "code").mapInArrow(run, _TABLE)


def _next_level(tables: DataFrame) -> DataFrame:
    """Tables of ``FAN`` neighbours as one, with the end state of each."""
    grouped = tables.groupBy("_c", F.floor(F.col("node") / FAN).alias("node")).agg(F.sort_array(F.collect_list(
        F.struct(F.col("node").alias("child"), "start", "end", "cost", "audit"))).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            def found(batch=batch):
                for i in range(batch.num_rows):
                    children: dict[int, dict] = {}
                    for r in batch.column(2)[i].as_py():
                        children.setdefault(r["child"], {})[r["start"], r["end"]] = (r["cost"], r["audit"])
                    c, node = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                    for (start, end), (cost, audit, mids) in combined([children[k] for k in sorted(children)]).items():
                        yield c, node, start, end, cost, audit, list(mids)
            yield from _in_parts(found(), _TABLE_ARROW, 64)
    return grouped.mapInArrow(run, _TABLE)


def _chosen(tables: DataFrame) -> DataFrame:
    """The best end of each conversation that has come down to one table."""
    best = tables.filter((F.col("node") == 0) & (F.col("start") == 0) & F.col("end").isin(*ENDS)).groupBy("_c").agg(
        F.min(F.struct("cost", "audit", "end")).alias("b"))
    return best.select("_c", F.lit(0).cast("bigint").alias("node"), F.lit(0).alias("start"), F.col("b.end").alias("end"),
                       F.col("b.cost").alias("cost"), F.col("b.audit").alias("audit"))


def parsed(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(roots, blocks, parts)``: ``_c, cost, audit`` of each conversation; the blocks; and
    ``_c, node, start, audit`` with the chosen part of every block.  ``rows`` as :func:`checked_rows`."""
    blocks = written(_blocks(rows), "blocks")
    levels = [written(_block_tables(blocks), "tables")]
    last = blocks.agg(F.max("node")).first()[0] or 0
    while last > 0:
        last //= FAN
        levels.append(written(_next_level(levels[-1]), "tables"))
    chosen = _chosen(levels[-1])
    roots = chosen.select("_c", "cost", "audit")
    for table in reversed(levels[1:]):
        picked = chosen.select("_c", "node", "start", "end").join(
            table.select("_c", "node", "start", "end", "mids"), ["_c", "node", "start", "end"])
        begins = F.concat(F.array("start"), F.slice("mids", F.lit(1), F.size("mids") - 1))
        chosen = picked.select("_c", "node", F.posexplode(F.arrays_zip(begins.alias("start"), F.col("mids").alias("end")))
                               ).select("_c", (F.col("node") * FAN + F.col("pos")).alias("node"),
                                        F.col("col.start").alias("start"), F.col("col.end").alias("end"))
        chosen = written(chosen, "chosen")
    parts = chosen.select("_c", "node", "start", "end").join(
        levels[0].select("_c", "node", "start", "end", "audit"), ["_c", "node", "start", "end"]).select(
        "_c", "node", "start", "audit")
    return roots, blocks, parts


_EDITS = "_c string, pos bigint, seq int, edit string, role string"
_EDITS_ARROW = pa.schema([("_c", pa.string()), ("pos", pa.int64()), ("seq", pa.int32()), ("edit", pa.string()),
                          ("role", pa.string())])
_NAMES = {"u": "user", "a": "assistant"}


def kept_edits(blocks: DataFrame, parts: DataFrame) -> DataFrame:
    """``_c, pos, seq, edit, role``: every row that stays or is new, in order; a kept row's role is
    null here (it is its own), an inserted row has the position of the row it stands before."""
    joined = blocks.select("_c", "node", "code").join(parts, ["_c", "node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            def found(batch=batch):
                columns = [batch.column(i).to_pylist() for i in range(5)]
                for c, node, code, start, audit in zip(*columns, strict=True):
                    for seq, (at, edit, role) in enumerate(replay(code, audit, start)):
                        # inserted rows at the end of a block stand behind its last row
                        pos = node * BLOCK + min(at, len(code) - 1) + 1
                        yield c, pos, seq, edit, None if edit == "K" else _NAMES[role]
            yield from _in_parts(found(), _EDITS_ARROW)
    return joined.select("_c", "node", "code", "start", "audit").mapInArrow(run, _EDITS)


def repaired_rows(rows: DataFrame, checked: DataFrame, edits: DataFrame) -> DataFrame:
    """``_c, pos, seq, edit, role, text`` of the repaired conversations (``seq`` orders a block's rows).

    A kept or reroled row is never a repeat, so it is found by its keys among the rows without
    their copies; rows of the input that agree in every column come out as often as they occur
    there, on the same ``(_c, pos, seq)``: whoever reads on takes one of them.
    """
    if "copy" in rows.columns:
        rows = rows.filter(F.col("copy") == 0)
    new = edits.filter(F.col("edit") == "I").select("_c", "pos", "seq", "edit", "role", F.lit("").alias("text"))
    stay = edits.filter(F.col("edit") != "I").join(checked.select("_c", "pos", "_k1", "_k2"), ["_c", "pos"])
    texts = rows.select(_conv_key("conv_id").alias("_c"), "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text")).select(
        "_c", *_row_keys(), F.col("role").alias("_own"), "text")
    found = texts.join(stay, ["_c", "_k1", "_k2"]).select(
        "_c", "pos", "seq", "edit", F.coalesce("role", "_own").alias("role"), "text")
    return found.unionByName(new)


_DIGEST_ARROW = pa.schema([("_c", pa.string()), ("repaired_sha256", pa.string())])


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """``_c, repaired_sha256`` over ``role:text`` lines, one pass over sorted rows in bounded memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seen, state, out = None, None, None, []
        for batch in batches:
            for c, pos, seq, line in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if c != conv:
                    if conv is not None:
                        out.append((conv, state.hexdigest()))
                    conv, seen, state = c, None, hashlib.sha256()
                if (pos, seq) == seen:
                    continue
                state.update((line if seen is None else "\n" + line).encode())
                seen = (pos, seq)
            if len(out) >= 1024:
                yield _record(_DIGEST_ARROW, out)
                out = []
        if conv is not None:
            out.append((conv, state.hexdigest()))
        if out:
            yield _record(_DIGEST_ARROW, out)
    lines = repaired.select("_c", "pos", "seq", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.repartition("_c").sortWithinPartitions("_c", "pos", "seq").mapInArrow(run, "_c string, repaired_sha256 string")


def _illegal_pairs(blocks: DataFrame) -> DataFrame:
    """``_c, illegal``: neighbouring initials other than su, ua and au."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("roles") - 1), lambda i: F.substr(F.col("roles"), i, F.lit(2)))
    bad = F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))
    return blocks.select("_c", F.when(F.length("roles") > 1, bad).otherwise(F.lit(0)).alias("n")).groupBy("_c").agg(
        F.sum("n").alias("illegal"))


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations``: faults of ``rows`` (what is left of them),
    the cheapest repair's cost and audit, and the digest of its result."""
    rows = written(rows, "rows")
    checked = checked_rows(rows)
    roots, blocks, parts = parsed(checked)
    repaired = repaired_rows(rows, checked, kept_edits(blocks, parts))

    def faults(kind: str) -> Column:
        return F.sum((F.col("fault") == kind).cast("long"))
    counts = checked.groupBy("_c").agg(
        (F.max("turn") - F.min("turn") + 1).cast("long").alias("_span"), faults("blank").alias("blank"),
        faults("duplicate").alias("duplicate"), faults("truncated").alias("truncated"))
    turns = checked.filter(F.col("turn").isNotNull()).groupBy("_c", "turn").agg(F.lit(1).alias("_one")).groupBy("_c").agg(
        F.count("*").alias("_turns"))
    every = conversations.select("conv_id").distinct().withColumn("_c", _conv_key("conv_id"))
    out = every
    for part in (counts, turns, _illegal_pairs(blocks), roots, conversation_digests(repaired)):
        out = out.join(part, "_c", "left")

    def number(c: str | Column) -> Column:
        return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0)).cast("long")
    return out.select(
        "conv_id", number(F.col("_span") - F.col("_turns")).alias("gaps"),
        *[number(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
