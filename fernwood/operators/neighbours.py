"""Exact nearest neighbours inside each class, by pivots and blocks.

Comparing all points of a class costs the square of its size, and one join key per class puts
that square into one task.  Here:

1. every class has up to ``PIVOTS`` pivot points (farthest-first among a few rows drawn by hash);
   each point knows its distance to all of them and belongs to the cell of the nearest;
2. a cell is cut by a hash of the key into blocks of about ``ROWS`` points, so a block is small
   whatever the size of its class.  Inside its own block every point finds ``k`` neighbours,
   and with them a radius that its true neighbours cannot exceed;
3. by the triangle inequality a block can only hold neighbours of a point if, for every pivot,
   its range of distances meets the point's distance plus or minus the radius.  This is tested
   between blocks, on one interval per pivot and block: pairs of blocks that fail are dropped;
4. the pairs left are compared as matrices: a product gives all distances with a bounded error,
   and the few candidates within it are computed again as sums of squared differences.  Pairs are
   dealt out in tiles of up to ``TILE`` by ``TILE`` blocks; at most ``k`` neighbours per point leave
   a tile, those within its radius;
5. a point's candidates are merged by ``(distance, key)``.

No join key holds more than one block's vectors on its right side, a tile holds at most twice ``TILE``
blocks, and vectors travel once per tile, in single precision where that is what they are given in.  In few dimensions, or where a class has structure, most pairs are dropped; in
many dimensions without structure nearly all remain, as any exact search would.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernwood.functions import unit_draw
from fernwood.session import write_scratch

PIVOTS = 16
#: candidates drawn per class for its pivots
DRAWN = 128
ROWS = 512
#: most blocks on a side of a tile; smaller classes have about TILES tiles on a side
TILE, TILES = 32, 4
_SLACK = 1e-9


def _farthest_first(x: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of ``x``, each the farthest from those before it."""
    picked = [0]
    gap = ((x - x[0]) ** 2).sum(axis=1)
    while len(picked) < min(n, len(x)) and gap.max() > 0:
        picked.append(int(gap.argmax()))
        gap = np.minimum(gap, ((x - x[picked[-1]]) ** 2).sum(axis=1))
    return x[picked]


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows of a matrix."""
    if len(column) == 0:
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _rough(q: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by a matrix product, and what each row may be off by."""
    qq, bb = (q * q).sum(axis=1), (b * b).sum(axis=1)
    off = 1e-13 * q.shape[1] * (qq + (bb.max() if len(bb) else 0.0)) + 1e-300
    return qq[:, None] + bb[None, :] - 2 * (q @ b.T), off


def nearest(q: np.ndarray, q_keys: np.ndarray, b: np.ndarray, b_keys: np.ndarray, k: int,
            limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every row of ``q`` its ``k`` nearest rows of ``b`` by ``(distance, key)``, as row numbers of
    both and squared distances; rows with the same key and rows farther than ``limit`` are left out."""
    rough, off = _rough(q, b)
    same = np.equal(q_keys[:, None], b_keys[None, :])
    rough[same] = np.inf
    reach = limit + off
    if b.shape[0] > k:
        reach = np.minimum(reach, np.partition(rough, k - 1, axis=1)[:, k - 1] + 2 * off)
    i, j = np.nonzero((rough <= reach[:, None]) & ~same)
    exact = np.empty(len(i))
    for lo in range(0, len(i), 65536):
        part = slice(lo, lo + 65536)
        exact[part] = ((q[i[part]] - b[j[part]]) ** 2).sum(axis=1)
    fits = exact <= limit[i]
    i, j, exact = i[fits], j[fits], exact[fits]
    order = np.lexsort((np.argsort(np.argsort(b_keys, kind="stable"), kind="stable")[j], exact, i))
    i, j, exact = i[order], j[order], exact[order]
    first = np.searchsorted(i, i)  # where each row's run begins
    keep = np.arange(len(i)) - first < k
    return i[keep], j[keep], exact[keep]


def knn_within_class(df: DataFrame, key: str, label: str, features: str, k: int,
                     classes: Sequence[int] | None = None) -> DataFrame:
    """Exact ``k`` nearest neighbours of the same class, ``(label, key, nbr_rank, nbr_key, dist)``.

    Ties in distance are broken by neighbour key.  A class of ``k`` rows or fewer gives all the
    neighbours there are.  Rows without a class are left out; keys are unique and vectors of one
    length.  Classes are few (their sizes and pivots come to the driver).
    """
    spark = df.sparkSession
    pts = df.where(F.col(label).isNotNull()).select(
        F.col(key).alias("key"), F.col(label).alias("cls"), F.transform(features, lambda v: v.cast("double")).alias("x"))
    if classes is not None:
        pts = pts.where(F.col("cls").isin(list(classes)))
    key_type, cls_type = pts.schema["key"].dataType, pts.schema["cls"].dataType
    kind = np.float32 if df.schema[features].dataType.elementType == T.FloatType() else np.float64
    sizes = {r["cls"]: r["n"] for r in pts.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], T.StructType([
            T.StructField(label, cls_type), T.StructField(key, key_type), T.StructField("nbr_rank", T.IntegerType()),
            T.StructField("nbr_key", key_type), T.StructField("dist", T.DoubleType())]))

    # about DRAWN rows per class, whatever its size; a class that draws none has one cell and no pivot
    share = spark.createDataFrame([(c, DRAWN / n) for c, n in sizes.items()], T.StructType([
        T.StructField("cls", cls_type), T.StructField("share", T.DoubleType())]))
    drawn: dict = {}
    for r in pts.join(F.broadcast(share), "cls").where(unit_draw(F.col("key"), 7) < F.col("share")).orderBy(
            "cls", "key").select("cls", "x").collect():
        drawn.setdefault(r["cls"], []).append(r["x"])
    pivots = spark.sparkContext.broadcast({c: _farthest_first(np.array(x), PIVOTS) for c, x in drawn.items()})

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, x = batch.column(1).to_pylist(), _matrix(batch.column(2))
            cell, gaps = np.zeros(len(cls), np.int32), [[]] * len(cls)
            numbers: dict = {}
            for i, c in enumerate(cls):
                numbers.setdefault(c, []).append(i)
            for c, rows in numbers.items():
                if c in pivots.value:
                    d = np.sqrt(np.stack([((x[rows] - p) ** 2).sum(axis=1) for p in pivots.value[c]], axis=1))
                    cell[rows] = d.argmin(axis=1)
                    for i, row in zip(rows, d, strict=True):
                        gaps[i] = row
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32()), pa.array(gaps, pa.list_(pa.float64()))],
                names=["key", "cls", "x", "cell", "gaps"])

    doubles = T.ArrayType(T.DoubleType())
    placed = write_scratch(pts.mapInArrow(assign, T.StructType([
        *pts.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("gaps", doubles)])), "knn-cells")

    # at most PIVOTS cells per class
    cells, n_blocks = [], {}
    for r in placed.groupBy("cls", "cell").agg(F.count(F.lit(1)).alias("n")).orderBy("cls", "cell").collect():
        parts, before = math.ceil(r["n"] / ROWS), n_blocks.get(r["cls"], 0)
        cells.append((r["cls"], r["cell"], before, parts))
        n_blocks[r["cls"]] = before + parts
    cell_table = spark.createDataFrame(cells, T.StructType([
        T.StructField("cls", cls_type), T.StructField("cell", T.IntegerType()), T.StructField("before", T.IntegerType()),
        T.StructField("parts", T.IntegerType())]))
    located = placed.join(F.broadcast(cell_table), ["cls", "cell"]).select(
        "cls", (F.col("before") + F.pmod(F.xxhash64("key"), F.col("parts"))).cast("int").alias("block"), "key", "x", "gaps")

    block_schema = T.StructType([
        T.StructField("cls", cls_type), T.StructField("block", T.IntegerType()), T.StructField("keys", T.ArrayType(key_type)),
        T.StructField("x", T.BinaryType()), T.StructField("reach", T.BinaryType()),
        *[T.StructField(n, doubles) for n in ("ask_lo", "ask_hi", "has_lo", "has_hi")]])

    def pack(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        keys, x, gaps = (t.column(c).combine_chunks() for c in ("key", "x", "gaps"))
        names, rows, d = keys.to_numpy(zero_copy_only=False), _matrix(x), _matrix(gaps)
        limit = np.full(len(rows), np.inf)
        i, _, found = nearest(rows, names, rows, names, k, limit)
        n = np.bincount(i, minlength=len(rows))
        last = np.cumsum(n) - 1
        full = n == k
        limit[full] = found[last[full]] * (1 + _SLACK)
        radius = np.sqrt(limit)[:, None] * (1 + _SLACK) + _SLACK * (1 + d)
        lists = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
        spans = [(d - radius).min(axis=0), (d + radius).max(axis=0), d.min(axis=0), d.max(axis=0)]
        return pa.table([t.column("cls").slice(0, 1), t.column("block").slice(0, 1), lists, pa.array([rows.astype(kind).tobytes()], pa.binary()),
                         pa.array([limit.tobytes()], pa.binary()), *[pa.array([s.tolist()], pa.list_(pa.float64())) for s in spans]],
                        names=block_schema.names)
    blocks = write_scratch(located.groupBy("cls", "block").applyInArrow(pack, block_schema), "knn-blocks")

    # pairs of blocks whose intervals meet for every pivot
    counted = spark.createDataFrame([(c, n, max(1, min(TILE, math.ceil(n / TILES)))) for c, n in n_blocks.items()], T.StructType([
        T.StructField("cls", cls_type), T.StructField("n", T.IntegerType()), T.StructField("side", T.IntegerType())]))
    asks = blocks.select("cls", F.col("block").alias("asking"), "ask_lo", "ask_hi").join(F.broadcast(counted), "cls").select(
        "cls", "side", "asking", "ask_lo", "ask_hi", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block"))
    apart = F.exists(F.zip_with("ask_lo", "has_hi", lambda a, b: a > b), lambda x: x) | F.exists(
        F.zip_with("ask_hi", "has_lo", lambda a, b: a < b), lambda x: x)
    tile = [F.floor(F.col(c) / F.col("side")).cast("int").alias(name) for c, name in (("asking", "down"), ("block", "across"))]
    pairs = write_scratch(asks.join(blocks.select("cls", "block", "has_lo", "has_hi"), ["cls", "block"]).where(~apart).select(
        "cls", *tile, "asking", "block"), "knn-pairs")
    at = ["cls", "down", "across"]
    asking = blocks.select("cls", F.col("block").alias("asking"), F.col("keys").alias("q_keys"), F.col("x").alias("q"), "reach")
    left = pairs.groupBy(*at, "asking").agg(F.collect_list("block").alias("blocks")).join(asking, ["cls", "asking"])
    right = pairs.select(*at, "block").distinct().join(blocks.select("cls", "block", "keys", "x"), ["cls", "block"]).select(
        *(F.col(c).alias(f"to_{c}") for c in at), "block", "keys", "x")
    found_schema = T.StructType([T.StructField("cls", cls_type), T.StructField("key", key_type), T.StructField("nbr_key", key_type),
                                 T.StructField("d2", T.DoubleType())])

    def compare(asks: pa.Table, has: pa.Table) -> pa.Table:
        held = {b: i for i, b in enumerate(has.column("block").to_pylist())}
        out = []
        for cls, names, q, reach, wanted in zip(*(asks.column(c) for c in ("cls", "q_keys", "q", "reach", "blocks")), strict=True):
            q_keys, limit = names.values.to_numpy(zero_copy_only=False), np.frombuffer(reach.as_buffer())
            q = np.frombuffer(q.as_buffer(), kind).astype(float).reshape(len(q_keys), -1)
            some = []
            for b in wanted.as_py():
                keys = has.column("keys")[held[b]].values
                x = np.frombuffer(has.column("x")[held[b]].as_buffer(), kind).astype(float).reshape(len(keys), -1)
                i, j, d2 = nearest(q, q_keys, x, keys.to_numpy(zero_copy_only=False), k, limit)
                some.append((i, keys.take(pa.array(j)), d2))
            i, d2 = (np.concatenate([s[c] for s in some]) for c in (0, 2))
            keys = pa.concat_arrays([s[1] for s in some])
            order = np.lexsort((np.argsort(np.argsort(keys.to_numpy(zero_copy_only=False), kind="stable"), kind="stable"), d2, i))
            order = order[np.arange(len(order)) - np.searchsorted(i[order], i[order]) < k]
            out.append(pa.table([pa.array([cls.as_py()] * len(order), asks.schema.field("cls").type), names.values.take(pa.array(i[order])),
                                 keys.take(pa.array(order)), pa.array(d2[order])], names=found_schema.names))
        return pa.concat_tables(out) if out else pa.table([pa.array([], asks.schema.field("cls").type), *(
            pa.array([], asks.schema.field("q_keys").type.value_type) for _ in range(2)), pa.array([], pa.float64())], names=found_schema.names)
    found = left.groupBy(*at).cogroup(right.groupBy(*(f"to_{c}" for c in at))).applyInArrow(compare, found_schema)
    # a point has at most k candidates from each tile
    merged = found.groupBy("cls", "key").agg(F.slice(F.sort_array(F.collect_list(F.struct("d2", "nbr_key"))), 1, k).alias("near"))
    return merged.select(F.col("cls").alias(label), F.col("key").alias(key), F.posexplode("near").alias("pos", "near")).select(
        label, key, (F.col("pos") + 1).cast("int").alias("nbr_rank"), F.col("near.nbr_key").alias("nbr_key"),
        F.sqrt("near.d2").alias("dist"))
