"""Near-duplicate groups: min-hash lists, bottom-k sketches, exact Jaccard on top.

A document's set holds its distinct word shingles (A-Z folded); two documents are linked
when the Jaccard similarity of their full sets reaches ``percent`` / 100, and a group is
what links connect.

1. Sketches.  One 64-bit hash per shingle; a document keeps the ``k`` smallest values of its
   set.  Documents with equal sets (size and a 128-bit sum of the set) form a class; from
   here on only one row per class is compared.
2. Lists.  A document is listed under one key for each of a number of bands; a key is made of
   ``depth`` min-hashes, and two documents share it with the chance of their similarity to that
   power.  There are so many bands that a link at the threshold meets in none with a chance
   under 1e-8, while documents that share a few common shingles hardly ever meet.
3. Very long lists are first compared with one document per list and size class only (its
   pivot, another one in every list), links are verified, and groups are formed.  While the
   pairs of such a list that are in different groups are many more than the list entries,
   more pivots are drawn.
4. What meets in long lists forms a family.  A family is cut into blocks, and every two blocks
   meet in a task that counts the shared shingles of all pairs of full sets at once.  Its pairs
   are never rows; blocks of one group only are not compared with each other.  Short lists give
   the pairs that are in no common family.  No pair of different groups that meets is left out.
5. A pair from a short list or with a pivot is checked by size, then by its union sketch (the k
   smallest values of both: the share that both retain estimates the similarity; below the floor
   it is dropped), then by exact Jaccard on the full sets, which are rebuilt from the texts of
   the documents that need it.
6. Groups are formed by the smallest row number over links, with pointer jumping.

Lists, pairs, links and groups stay in Spark; the driver sees counts only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernwood.llm.common import (
    maybe_among, mix64, shingle_hashes, slices, spent, text_bytes, word_hashes, written,
)

#: at most so many min-hashes are in a key, and so many bands are taken for more than one
DEPTH, MAX_BANDS = 5, 64
#: lists of at most this many documents give their pairs one by one
SHORT = 16
#: a block of a family has about so many documents, and shingles, at most
BLOCK, BLOCK_SHINGLES = 512, 1 << 18
_LONGS = pa.list_(pa.int64())


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most ``rows`` rows in an Arrow batch of what is run inside: rows that hold whole sets are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def retained_overlap(n: np.ndarray, k: int, percent: int) -> np.ndarray:
    """Retained values that a set of ``n`` shingles shares with any set it is linked with.

    Where the union fits in a sketch all shared values are retained, at least ``percent`` of the
    set.  Else the k smallest values of the union are a draw without replacement of which at
    least ``percent`` are shared: the mean less 5 deviations for the largest possible union.  A
    set that fits in a sketch may have a union of either kind, so the smaller bound holds.
    """
    j = percent / 100
    n = np.asarray(n, np.int64)
    left = np.clip(1 - k * j / np.maximum(n, 1), 0, 1)
    drawn = np.floor(k * j - 5 * np.sqrt(k * j * (1 - j) * left)).astype(np.int64)
    whole = -(-percent * n // 100)
    return np.where(100 * n <= percent * k, whole, np.minimum(whole, np.maximum(drawn, 1)))


def set_rows(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """Per text: its sorted shingle set (uint64) and the two halves of the set's signature."""
    for lo, hi in slices(column):
        data, offsets = text_bytes(column.slice(lo, hi - lo))
        words, at = word_hashes(data, offsets)
        hashes, at = shingle_hashes(words, at, size)
        for i in range(hi - lo):
            values = np.unique(hashes[at[i]:at[i + 1]])
            yield values, int(values.sum().view(np.int64)), int(mix64(values ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64))


def _longs(arrays: list[np.ndarray]) -> pa.Array:
    """A list column from uint64 arrays (as the same 64 bits, signed)."""
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _arrays(column: pa.Array) -> list[np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, ends = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def bands_for(percent: int) -> tuple[int, int]:
    """Min-hashes in a key, and bands with which a link at the threshold shares no key with a chance under 1e-8."""
    if percent >= 100:
        return DEPTH, 1
    for depth in range(DEPTH, 0, -1):
        bands = math.ceil(math.log(1e-8) / math.log1p(-((max(percent, 1) / 100) ** depth)))
        if bands <= MAX_BANDS:
            break
    return depth, bands


def min_hashes(values: np.ndarray, factors: np.ndarray, columns: int = 1024) -> np.ndarray:
    """For every factor the smallest product with a value of the set; an empty set has the largest number."""
    low = np.full(len(factors), np.iinfo(np.uint64).max)
    for at in range(0, len(values), columns):
        low = np.minimum(low, np.multiply.outer(factors, values[at:at + columns]).min(axis=1))
    return low


def band_keys(low: np.ndarray, depth: int) -> np.ndarray:
    """The key of every row in every band, from the rows' min-hashes."""
    keys = np.arange(low.shape[1] // depth, dtype=np.uint64)[None, :]
    for i in range(depth):
        keys = mix64(keys * np.uint64(0xD6E8FEB86659FD93) + low[:, i::depth])
    return keys


def sketches(docs: DataFrame, size: int, percent: int, k: int, id_col: str, text_col: str) -> DataFrame:
    """``(_row, _id, _h, n, s1, s2, sketch, keys)`` of every row, written; ``_h`` is a hash of the text."""
    kind = docs.schema[id_col].dataType.simpleString()
    depth, bands = bands_for(percent)
    factors = mix64(np.arange(1, depth * bands + 1, dtype=np.uint64)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(v), a, b, v[:k].copy(), min_hashes(v, factors)) for v, a, b in set_rows(batch.column(1), size)]
            n, s1, s2, low, least = zip(*sets, strict=True) if sets else ((), (), (), (), ())
            keys = band_keys(np.stack(least), depth) if sets else ()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *(pa.array(x, pa.int64()) for x in (n, s1, s2)),
                 _longs(list(low)), _longs(list(keys))],
                names=["_id", "_h", "n", "s1", "s2", "sketch", "keys"])

    rows = docs.select(F.col(id_col).alias("_id"), text_col, F.xxhash64(F.coalesce(text_col, F.lit("")))).mapInArrow(
        run, f"_id {kind}, _h long, n long, s1 long, s2 long, sketch array<long>, keys array<long>")
    with small_batches(docs.sparkSession, 1000):
        return written(rows.withColumn("_row", F.monotonically_increasing_id()), "sketches")


def estimated(pairs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """``(a, b, sure)``: pairs that pass the union-sketch test; ``sure`` where it was exact."""
    side = nodes.select("node", "n", "sketch")
    both = (pairs.join(side.withColumnsRenamed({"node": "a", "n": "na", "sketch": "sa"}), "a")
            .join(side.withColumnsRenamed({"node": "b", "n": "nb", "sketch": "sb"}), "b")
            .select("a", "b", "na", "nb", "sa", "sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            keep, sure = [], []
            sizes = np.maximum(t.column(2).to_numpy(), t.column(3).to_numpy())
            floors = retained_overlap(sizes, k, percent).tolist()
            for x, y, n, floor in zip(_arrays(t.column(4)), _arrays(t.column(5)), sizes.tolist(), floors, strict=True):
                common = np.intersect1d(x, y, assume_unique=True)
                if n <= k:
                    keep.append(100 * len(common) >= percent * (len(x) + len(y) - len(common)))
                    sure.append(True)
                else:
                    union = np.union1d(x, y)[:k]
                    keep.append(np.searchsorted(common, union[-1], side="right") >= floor)
                    sure.append(False)
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(sure, pa.bool_())],
                                             names=["a", "b", "sure"]).filter(keep)

    return both.mapInArrow(run, "a long, b long, sure boolean")


def full_sets(docs: DataFrame, rows: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``(node, full)``: the full shingle sets of ``rows(node, _id, s1)``, rebuilt from the texts."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = maybe_among(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")),
                        rows.select("_id").distinct(), ["_id"], "_hit").filter("_hit").select("_id", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for lo, hi in slices(b.column(1)):
                sets = list(set_rows(b.column(1).slice(lo, hi - lo), size))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([s for _, s, _ in sets], pa.int64()),
                     _longs([v for v, _, _ in sets])], names=["_id", "s1", "full"])
                at = hi

    sets = texts.mapInArrow(run, f"_id {kind}, s1 long, full array<long>")
    same = sets["_id"].eqNullSafe(rows["_id"]) & (sets["s1"] == rows["s1"])
    return sets.join(rows, same).select("node", "full").dropDuplicates(["node"])


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, percent: int, size: int, id_col: str,
             text_col: str) -> DataFrame:
    """``(a, b)``: the pairs that are links, written."""
    passed = written(estimated(pairs, nodes, k, percent), "passed")
    open_pairs = passed.filter("NOT sure").select("a", "b")
    wanted = open_pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = written(nodes.select("node", "_id", "s1").join(wanted, "node", "left_semi"), "wanted")
    sets = full_sets(docs, wanted, size, id_col, text_col)
    with small_batches(docs.sparkSession, 1000):
        sets = written(sets, "sets")
    both = (open_pairs.join(sets.withColumnsRenamed({"node": "a", "full": "fa"}), "a")
            .join(sets.withColumnsRenamed({"node": "b", "full": "fb"}), "b").select("a", "b", "fa", "fb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            keep = []
            for x, y in zip(_arrays(t.column(2)), _arrays(t.column(3)), strict=True):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1)], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    exact = both.mapInArrow(run, "a long, b long")
    with small_batches(docs.sparkSession, 128):
        links = written(passed.filter("sure").select("a", "b").unionByName(exact), "links")
    spent(passed, wanted, sets)
    return links


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` of every linked node: the smallest node that it is connected with, written."""
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                    "edges")
    labels = written(edges.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    current = labels
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node", "left").select(
            "node", "label", F.least("label", F.coalesce("m", "label")).alias("to"))
        step = written(step, "step")
        jump = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
        moved = step.join(jump, "to", "left").select("node", "label", F.coalesce("next", "to").alias("new"))
        moved = written(moved, "moved")
        changed = moved.filter("new < label").limit(1).count()
        spent(step, current)
        current, labels = moved, moved.select("node", F.col("new").alias("label"))
        if not changed:
            spent(edges)
            return labels


def _labelled(entries: DataFrame, labels: DataFrame) -> DataFrame:
    return entries.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def list_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: pairs of nodes of different groups and families that meet in a list of ``entries``."""
    others = entries.select("value", *[F.col(c).alias(f"{c}_") for c in ("node", "n", "label", "family")])
    allowed = 100 * F.least("n", "n_") >= percent * F.greatest("n", "n_")
    return entries.join(others, "value").filter(
        (F.col("node") < F.col("node_")) & (F.col("label") != F.col("label_"))
        & (F.col("family") != F.col("family_")) & allowed).select(
        F.col("node").alias("a"), F.col("node_").alias("b")).distinct()


def families(entries: DataFrame) -> DataFrame:
    """``(node, family)``: nodes that lists of ``entries`` connect are a family."""
    first = entries.groupBy("value").agg(F.min("node").alias("a"))
    stars = entries.join(first, "value").filter("node != a").select("a", F.col("node").alias("b")).distinct()
    return components(stars).withColumnRenamed("label", "family")


def linked_in_block(sets: list[np.ndarray], labels: np.ndarray, second: np.ndarray, percent: int,
                    columns: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``(x, root)``: links between the rows of two blocks (``second`` says which), as a forest.

    Where a block meets itself no row is a second one, and all rows are compared with all.
    """
    n = np.array([len(s) for s in sets], np.int64)
    rows = np.repeat(np.arange(len(sets)), n)
    _, number, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    left, right = (np.flatnonzero(~second), np.flatnonzero(second)) if second.any() else (np.arange(len(sets)),) * 2
    many = counts > 1  # a shingle of one set is in no intersection
    column = np.cumsum(many) - 1
    keep = many[number]
    order = np.argsort(column[number[keep]], kind="stable")
    rows, at = rows[keep][order], column[number[keep]][order]
    shared = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(many.sum()), columns):
        a, b = np.searchsorted(at, (lo, lo + columns))
        has = np.zeros((len(sets), columns), np.float32)
        has[rows[a:b], at[a:b] - lo] = 1
        shared += has[left] @ has[right].T
    common = shared.astype(np.int64)
    linked = (100 * common >= percent * (n[left][:, None] + n[right][None] - common)) & (
        labels[left][:, None] != labels[right][None])
    root = np.arange(len(sets))
    x, y = np.nonzero(linked)
    x, y = left[x], right[y]
    while True:  # the smallest position that links connect a row with
        new = root.copy()
        np.minimum.at(new, x, root[y])
        np.minimum.at(new, y, root[x])
        new = new[new]
        if (new == root).all():
            break
        root = new
    x = np.flatnonzero(root != np.arange(len(sets)))
    return x, root[x]


def family_links(members: DataFrame, docs: DataFrame, percent: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """``(a, b)``, written: links that connect what is linked among ``members(node, _id, s1, n, label, family)``.

    Every pair of a family with different labels is compared on the full sets, block by block.
    """
    def count(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("parts"))

    # a large group has blocks of its own, which are not compared with each other
    large = count(members, "family", "label").filter("parts > 1").select("family", "label", F.col("label").alias("owner"))
    owned = members.join(large, ["family", "label"], "left").withColumn("owner", F.coalesce("owner", F.lit(-1)))
    parts = owned.join(count(owned, "family", "owner"), ["family", "owner"])
    block = F.struct("owner", F.pmod(F.xxhash64("node", "family"), F.col("parts")).alias("part"))
    dealt = written(parts.select("node", "_id", "s1", "label", "family", block.alias("block")), "dealt")
    sets = full_sets(docs, dealt.select("node", "_id", "s1"), size, id_col, text_col)
    with small_batches(docs.sparkSession, 1000):
        sets = written(sets, "sets")

    blocks = dealt.select("family", "block").distinct()
    meets = blocks.withColumnRenamed("block", "one").join(blocks.withColumnRenamed("block", "two"), "family").filter(
        (F.col("one") <= F.col("two")) & ((F.col("one.owner") != F.col("two.owner")) | (F.col("one.owner") == -1)))
    meets = written(meets, "meets")
    sides = meets.withColumns({"block": F.col("one"), "second": F.lit(False)}).unionByName(
        meets.filter("one != two").withColumns({"block": F.col("two"), "second": F.lit(True)}))
    rows = dealt.join(sets, "node").join(sides, ["family", "block"]).select(
        "family", "one", "two", "second", "node", "label", "full")

    def run(t: pa.Table) -> pa.Table:
        nodes, labels, second = (t[c].to_numpy() for c in ("node", "label", "second"))
        x, root = linked_in_block(_arrays(t["full"]), labels, second.astype(bool), percent)
        return pa.table({"a": nodes[x], "b": nodes[root]})

    links = written(rows.groupBy("family", "one", "two").applyInArrow(run, "a long, b long"), "links")
    spent(dealt, sets, meets)
    return links


def grouped_rows(docs: DataFrame, size: int, percent: int, k: int, id_col: str, text_col: str, rounds: int,
                 enough: int, pivoted: int) -> DataFrame:
    """``(_row, _id, _h, n, label, component_id)`` of every row; ``label`` names its group."""
    rows = sketches(docs, size, percent, k, id_col, text_col)
    filled = rows.filter("n > 0")
    # large classes are pre-aggregated; the join back is one that Spark splits where a key is hot
    classes = filled.groupBy("n", "s1", "s2").agg(F.min("_row").alias("node"))
    first = F.col("_row") == F.col("node")
    members = written(filled.join(classes, ["n", "s1", "s2"]).select(
        "_row", "_id", "_h", "n", "s1", "node", F.when(first, F.col("sketch")).alias("sketch"),
        F.when(first, F.col("keys")).alias("keys")), "members")
    blank = written(rows.filter("n = 0").select("_row", "_id", "_h", "n"), "blank")
    spent(rows)
    nodes = members.filter(F.col("sketch").isNotNull()).select("node", "_id", "n", "s1", "sketch")

    listed = members.select("node", F.explode("keys").alias("value"))
    lengths = listed.groupBy("value").agg(F.count(F.lit(1)).alias("length")).filter("length > 1")
    step = math.log(100 / percent) if percent < 100 else 1.0
    entries = written(listed.join(lengths, "value").join(nodes.select("node", "n"), "node").withColumn(
        "band", F.floor(F.log(F.col("n").cast("double")) / step).cast("int")), "lists")

    def check(pairs: DataFrame) -> DataFrame:
        return verified(pairs, nodes, docs, k, percent, size, id_col, text_col)

    labels = links = tested = None
    before = math.inf
    huge = entries.filter(F.col("length") > pivoted)
    for turn in range(0 if huge.isEmpty() else rounds):
        now = huge
        if labels is None:
            now = now.withColumn("label", F.col("node"))
        else:
            now = labelled = written(_labelled(now, labels), "labelled")
            # pairs of a long list that lie in different groups
            per = now.groupBy("value", "label").agg(F.count(F.lit(1)).cast("double").alias("c")).groupBy("value").agg(
                (F.pow(F.sum("c"), 2) - F.sum(F.col("c") * F.col("c"))).alias("open"))
            still = per.agg(F.coalesce(F.sum("open"), F.lit(0.0))).first()[0]
            # few are left, or pivots no longer help: documents that share much and are not linked
            if still <= 2 * enough * now.count() or 2 * still > before:
                spent(labelled)
                break
            before = still
        # every list has its own pivots, so a document is compared with as many as it has lists
        pivots = now.groupBy("value", "band").agg(
            F.min(F.struct(F.xxhash64("node", "value", F.lit(turn)), "node", "n", "label")).alias("p")).select(
            "value", "band", F.col("p.node").alias("pivot"), F.col("p.n").alias("pn"), F.col("p.label").alias("pl"))
        pairs = (now.join(pivots, ["value", "band"]).filter(F.col("label") != F.col("pl"))
                 .filter(100 * F.least("n", "pn") >= percent * F.greatest("n", "pn"))
                 .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())
        pairs = written(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = check(pairs)
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        if turn:
            spent(labelled)

    left = _labelled(entries, labels) if labels is not None else entries.withColumn("label", F.col("node"))
    left = written(left.select("value", "node", "n", "length", "label"), "open")
    several = left.groupBy("value").agg((F.min("label") != F.max("label")).alias("_open")).filter("_open")
    long = left.filter(F.col("length") > SHORT).join(several, "value", "left_semi")
    family = families(long)
    short = left.filter(F.col("length") <= SHORT).join(family, "node", "left").withColumn(
        "family", F.coalesce("family", -1 - F.col("node")))
    pairs = list_pairs(short, percent)
    found = check(written(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs"))
    relatives = nodes.select("node", "_id", "n", "s1").join(family, "node")
    relatives = _labelled(relatives, labels) if labels is not None else relatives.withColumn("label", F.col("node"))
    found = found.unionByName(family_links(relatives, docs, percent, size, id_col, text_col))
    labels = components(found if links is None else links.unionByName(found))
    spent(entries, left)

    everyone = nodes.select("node").join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    grouped = written(members.select("_row", "_id", "_h", "n", "node").join(everyone, "node"), "grouped")
    spent(members)
    smallest = grouped.groupBy("label").agg(F.min("_id").alias("component_id"))
    out = grouped.join(smallest, "label")
    empty = blank.withColumns({"component_id": F.col("_id"), "label": F.col("_row")})
    columns = ["_row", "_id", "_h", "n", "label", "component_id"]
    return out.select(columns).unionByName(empty.select(columns))


def near_duplicate_groups(docs: DataFrame, size: int = 5, percent: int = 80, k: int = 64, id_col: str = "doc_id",
                          text_col: str = "text", rounds: int = 4, enough: int = 4,
                          pivoted: int = 4096) -> DataFrame:
    """One row per input row: ``id_col, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id of the row's group, ``kept`` says whether it is the
    row's own.  A text with fewer than ``size`` words has its whole sequence as its one
    shingle; null, empty and white-space texts have none and are groups of their own.
    Repeated rows are separate documents with equal sets.  Null ids take part; a group's
    smallest id is null only if all its ids are.  An empty table gives an empty result; other
    columns are ignored.  Lists of more than ``pivoted`` documents meet pivots first;
    ``rounds`` and ``enough`` set when pivots give way to comparing all open pairs.  None of the
    three changes a result.
    """
    out = grouped_rows(docs, size, percent, k, id_col, text_col, rounds, enough, pivoted)
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80, k: int = 64, id_col: str = "doc_id",
                 text_col: str = "text", rounds: int = 4, enough: int = 4,
                 pivoted: int = 4096) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, columns unchanged.

    The smallest id of a group stays (of rows that share it, the one with the smallest text
    hash, and one row of those that are the same).
    """
    groups = grouped_rows(docs, size, percent, k, id_col, text_col, rounds, enough, pivoted)
    chosen = written(groups.filter(F.col("_id").eqNullSafe(F.col("component_id"))).groupBy("label").agg(
        F.min(F.struct("_h", "_id")).alias("x"), F.count(F.lit(1)).alias("c")).select("x._id", "x._h", "c"), "chosen")
    text_hash = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    kept = docs.join(chosen, docs[id_col].eqNullSafe(chosen["_id"]) & (text_hash == chosen["_h"]), "left_semi")
    # texts are only shuffled to drop repeated rows where there are any
    repeated = not chosen.filter("c > 1").isEmpty()
    return kept.dropDuplicates([id_col, text_col]) if repeated else kept
