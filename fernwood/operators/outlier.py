"""IQR fences, outlier counts, clipping and log1p (fit once, apply anywhere).

Fences are ``q1 - 1.5*iqr`` and ``q3 + 1.5*iqr`` from exact linear quantiles;
a value is an outlier when strictly outside.  Missing or non-numeric columns
are skipped and report 0.  ``fit_bounds`` runs one distributed quantile job
and returns a small object (a handful of numbers per column) that is applied
as literals, so transforms are a single narrow ``select`` inside codegen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernwood.operators.quantiles import numeric_columns, quantile_table

# Fixed values (default long-tail columns and the Tukey factor)
LONG_TAIL_COLUMNS = ["src_bytes", "dst_bytes", "count", "srv_count"]
IQR_K = 1.5


@dataclass
class Bounds:
    """Fitted fences: ``{column: (q1, q3, lower, upper)}``; ``skipped`` lists ignored columns."""

    fences: dict[str, tuple[float, float, float, float]]
    requested: list[str]
    skipped: list[str] = field(default_factory=list)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(c, *self.fences[c]) for c in self.requested if c in self.fences]
        return spark.createDataFrame(
            rows, "feature string, q1 double, q3 double, lower double, upper double")


def fit_bounds(df: DataFrame, cols: Sequence[str], k: float = IQR_K,
               method: str = "exact", skip_zero_iqr: bool = False) -> Bounds:
    """Quantile pass over ``df``; the fences are reused for reports, clipping and other frames."""
    cols = list(cols)
    usable = numeric_columns(df, cols)
    q = quantile_table(df, usable, [0.25, 0.75], method) if usable else {}
    fences = {}
    for c in usable:
        if c not in q:  # column with only nulls
            continue
        q1, q3 = q[c]
        iqr = q3 - q1
        if skip_zero_iqr and iqr == 0:
            continue
        fences[c] = (q1, q3, q1 - k * iqr, q3 + k * iqr)
    skipped = [c for c in cols if c not in fences]
    return Bounds(fences, cols, skipped)


def _outside(v, lo: float, hi: float):
    """Strictly outside the fences; a null or NaN is not (Spark orders NaN above all numbers)."""
    return ~F.isnan(v) & ((v < F.lit(lo)) | (v > F.lit(hi)))


def outlier_counts(df: DataFrame, bounds: Bounds) -> DataFrame:
    """``(column, n_outliers, n_rows)`` for every requested column, one aggregate pass."""
    spark = df.sparkSession
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c, (_, _, lo, hi) in bounds.fences.items():
        aggs.append(F.sum(F.when(_outside(F.col(c).cast("double"), lo, hi), 1)
                          .otherwise(0)).cast("long").alias(c))
    row = df.agg(*aggs)
    stacked = [F.struct(F.lit(c).alias("feature"),
                        (F.col(c) if c in bounds.fences else F.lit(0)).cast("long").alias("n_outliers"))
               for c in bounds.requested]
    if not stacked:
        return spark.createDataFrame([], "feature string, n_outliers long, n_rows long")
    return row.select(F.explode(F.array(*stacked)).alias("s"), F.col("_n").alias("n_rows")) \
        .select("s.feature", "s.n_outliers", "n_rows")


def detect_outliers_iqr(df: DataFrame, cols: Sequence[str], method: str = "exact") -> DataFrame:
    """Fit fences on ``df`` and count values strictly outside them."""
    return outlier_counts(df, fit_bounds(df, cols, method=method))


def clip(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Clip each fitted column to its fences; rows kept, nulls and NaN stay, the result is double."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    clipped = {}
    for c, (_, _, lo, hi) in bounds.fences.items():
        if c not in fields:
            continue
        v = F.col(c).cast("double")
        clipped[c] = F.when(v.isNull() | F.isnan(v), v).otherwise(F.least(F.greatest(v, F.lit(lo)), F.lit(hi)))
    return df.withColumns(clipped) if clipped else df


def log1p_append(df: DataFrame, cols: Sequence[str], suffix: str = "_log1p") -> DataFrame:
    """Append ``{col}_log1p`` for each numeric column; originals kept."""
    usable = numeric_columns(df, cols)
    if not usable:
        return df
    return df.withColumns({f"{c}{suffix}": F.log1p(F.col(c).cast("double")) for c in usable})


def outlier_pipeline(df: DataFrame, numeric_cols: Sequence[str],
                     long_tail_cols: Sequence[str] | None = None,
                     bounds: Bounds | None = None, method: str = "exact"):
    """Counts on the raw frame -> clip -> log1p of the clipped long-tail columns.

    Pass ``bounds`` fitted on the training frame to apply the same fences to
    another frame (no leak from test statistics).  Returns
    ``(frame, counts, bounds)``.
    """
    bounds = bounds or fit_bounds(df, numeric_cols, method=method)
    counts = outlier_counts(df, bounds)
    tail = list(long_tail_cols) if long_tail_cols is not None else LONG_TAIL_COLUMNS
    tail = [c for c in tail if c in df.columns]
    out = log1p_append(clip(df, bounds), tail)
    return out, counts, bounds
