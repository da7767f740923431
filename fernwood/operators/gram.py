"""Pearson correlations of wide tables from one pass of matrix products.

One aggregate of ``corr`` per pair grows with the square of the columns.  Here every task adds up,
over its own rows, four products of the shifted data matrix X (missing cells 0) and the matrix M
of present cells: X'X, X'M, (X*X)'M and M'M.  They hold, for every pair of columns, the sums over
the rows where both are present, so missing values (null or NaN) are left out by pair.  The sums
are cut into bands of ``BAND`` columns, added up band by band in two levels, and turned into
correlations where the band ends up; the matrix never comes to the driver.

A first pass takes each column's mean; shifting by it keeps the sums small, so subtracting their
products loses no digits.  A task holds six matrices of columns x columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwood.operators.quantiles import present

BAND = 64
_SUMS = "band int, salt int, sums binary"


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
    """The sums of every band of a task."""
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for band, blob in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            part = np.frombuffer(blob)
            held[band] = part.copy() if band not in held else held[band] + part
    yield from ((band, 0, sums) for band, sums in sorted(held.items()))


def _batch(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([r[2].tobytes() for r in rows], pa.binary())], names=["band", "salt", "sums"])


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(a, b, r)`` for all column numbers ``a < b``; ``r`` is null where fewer than two rows hold
    both columns or one of them does not vary over these rows."""
    spark, d = df.sparkSession, len(cols)
    row = df.agg(*[F.avg(present(c)) for c in cols]).first()
    shift = np.array([0.0 if m is None or not math.isfinite(m) else m for m in row])
    bands = range(0, d, BAND)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.column(0).slice(lo, 4096)
                x = part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), d) - shift
                m = (~np.isnan(x)).astype(float)
                x = np.where(m > 0, x, 0.0)
                found = np.stack([x.T @ x, x.T @ m, (x * x).T @ m, m.T @ m])
                sums = found if sums is None else sums + found
        if sums is not None:
            xx, xm, qm, mm = sums
            # what a band needs of both columns of its pairs
            six = np.stack([xx, xm, xm.T, qm, qm.T, mm])
            number = hash_of_task()
            for i, lo in enumerate(bands):
                yield _batch([(i, number, np.ascontiguousarray(six[:, lo:lo + BAND]))])

    def halfway(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _added(batches):
            yield _batch([found])

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for band, _, sums in _added(batches):
            xx, xm, mx, qm, mq, n = sums.reshape(6, -1, d)
            with np.errstate(divide="ignore", invalid="ignore"):
                covered = xx - xm * mx / n
                left, right = qm - xm * xm / n, mq - mx * mx / n
                r = covered / np.sqrt(left * right)
                flat = 1e-24 * shift * shift
                known = (n >= 2) & (left > n * flat[band * BAND:band * BAND + len(n), None]) & (right > n * flat[None, :])
            a, b = np.nonzero(np.arange(d)[None, :] > np.arange(band * BAND, band * BAND + len(n))[:, None])
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a + band * BAND, pa.int32()), pa.array(b, pa.int32()),
                     pa.array(np.clip(r[a, b], -1.0, 1.0), pa.float64(), mask=~known[a, b])], names=["a", "b", "r"])

    parts = df.select(F.array(*[present(c) for c in cols]).alias("x")).mapInArrow(products, _SUMS)
    groups = max(1, math.ceil(math.sqrt(parts.rdd.getNumPartitions())))
    if groups > 4:
        parts = parts.withColumn("salt", F.pmod("salt", F.lit(groups))).repartition("band", "salt").mapInArrow(halfway, _SUMS)
    return parts.repartition("band").mapInArrow(finished, "a int, b int, r double")


def hash_of_task() -> int:
    """The number of the task's partition, the same on every retry."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0
