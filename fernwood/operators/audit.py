"""Data-quality audit and exploration as aggregate jobs.

Every report is one or two aggregate passes that fold all columns together,
then an ``unpivot``/``explode`` of the single result row into a long table.
Nothing is ever collected except small fitted statistics (min/max per column).
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from fernwood.operators.gram import correlations
from fernwood.operators.quantiles import numeric_columns, present, quantile_table
from fernwood.operators.ranking import running_total
from fernwood.schema import columns_with_prefix


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(feature, n_null)`` per column; NaN counts as missing on float columns."""
    cols = list(cols) if cols is not None else df.columns
    fields = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for c in cols:
        miss = F.col(c).isNull()
        if isinstance(fields[c], (DoubleType, FloatType)):
            miss = miss | F.isnan(F.col(c))
        aggs.append(F.sum(miss.cast("long")).alias(c))
    row = df.agg(*aggs)
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("n_null"))
        for c in cols])).alias("s")).select("s.*")


def check_missing(df: DataFrame) -> tuple[int, list[str]]:
    """Total missing cells and the columns that have any; warns, never fills."""
    rows = null_counts(df).where(F.col("n_null") > 0).collect()
    total = int(sum(r["n_null"] for r in rows))
    cols = [r["feature"] for r in rows]
    if total:
        warnings.warn(f"{total} missing values in columns {cols}; not filled", UserWarning,
                      stacklevel=2)
    return total, cols


def shape(df: DataFrame, split_col: str | None = None) -> DataFrame:
    """``(split, n_rows, n_cols)``; one count pass."""
    ncols = len([c for c in df.columns if c != split_col])
    if split_col is None:
        return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(ncols))
    return df.groupBy(F.col(split_col).alias("split")).agg(
        F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(ncols))


def describe(df: DataFrame, cols: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (exact, linear) and max per numeric column."""
    cols = numeric_columns(df, cols)
    quarters = [0.25, 0.5, 0.75]
    if method == "exact":
        q = quantile_table(df, cols, quarters)
        q25, q50, q75 = ({c: F.lit(x[i]) for c, x in q.items()} for i in range(3))
        sketches = []
    else:
        q25, q50, q75 = ({c: F.col(f"q{j}")[i] for j, c in enumerate(cols)} for i in range(3))
        sketches = [F.percentile_approx(present(c), quarters, 100000).alias(f"q{j}") for j, c in enumerate(cols)]
    none = F.lit(None).cast("double")
    # one row for all columns, then one row per column
    row = df.agg(*sketches, *[F.struct(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                                       F.min(v).alias("min"), F.max(v).alias("max")).alias(f"c{j}")
                              for j, v in enumerate(map(present, cols))])
    stacked = [F.struct(F.lit(c).alias("feature"), *[F.col(f"c{j}")[f].alias(f) for f in ("count", "mean", "std", "min")],
                        *[q.get(c, none).alias(n) for n, q in (("q25", q25), ("q50", q50), ("q75", q75))],
                        F.col(f"c{j}")["max"].alias("max")) for j, c in enumerate(cols)]
    if not stacked:
        return df.sparkSession.createDataFrame([], "feature string, count long, mean double, std double, min double, "
                                                   "q25 double, q50 double, q75 double, max double")
    return row.select(F.explode(F.array(*stacked)).alias("s")).select("s.*")


def label_distribution(df: DataFrame, label: str = "label", split: str = "split") -> DataFrame:
    """``(split, label, n, share)``, share within the split."""
    counts = df.groupBy(F.col(split).alias("split"), F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"))
    total = counts.groupBy(F.col("split").alias("_split")).agg(F.sum("n").alias("_total"))
    return counts.join(total, F.col("split").eqNullSafe(F.col("_split"))).select(
        "split", "label", "n", (F.col("n") / F.col("_total")).alias("share"))


def category_distribution(df: DataFrame, label_dim: DataFrame, label: str = "label",
                          split: str = "split", splits: Sequence[str] = ("train", "test")) -> DataFrame:
    """Category counts per split side by side (``pivot`` on the split)."""
    dim = label_dim.select(F.col("name").alias(label), "category")
    joined = df.select(label, split).join(dim, label, "inner")
    wide = joined.groupBy("category").pivot(split, list(splits)).agg(F.count(F.lit(1)))
    return wide.select("category", *[F.coalesce(F.col(s), F.lit(0)).cast("long").alias(f"n_{s}")
                                     for s in splits])


def top_k_frequency(df: DataFrame, col: str, k: int = 15) -> DataFrame:
    """The ``k`` most frequent values; ties by value ascending."""
    return (df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("value")).limit(k))


def unseen_labels(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Labels present in ``test`` and absent from ``train`` (anti join, never a constant)."""
    return (test.select(F.col(label).alias("label")).distinct()
            .join(train.select(F.col(label).alias("label")).distinct(), "label", "left_anti"))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width histogram per column between its min and max; empty bins kept as 0.

    ``bin = least(floor((v - min) / (max - min) * bins), bins - 1)``, so the
    maximum falls in the last bin.
    """
    cols = numeric_columns(df, cols)
    mm = df.agg(*[F.min(present(c)).alias(f"lo_{i}") for i, c in enumerate(cols)],
                *[F.max(present(c)).alias(f"hi_{i}") for i, c in enumerate(cols)]).first()
    edges = {c: (mm[f"lo_{i}"], mm[f"hi_{i}"]) for i, c in enumerate(cols)}
    binned = []
    for c in cols:
        lo, hi = edges[c]
        if lo is None:
            continue
        width = (hi - lo) if hi > lo else 1.0
        b = F.floor((present(c) - F.lit(lo)) / F.lit(width) * F.lit(bins))
        # a missing value is in no bin
        binned.append(F.struct(F.lit(c).alias("feature"), F.when(b.isNotNull(), F.least(b, F.lit(bins - 1))).cast("int").alias("bin")))
    counts = (df.select(F.explode(F.array(*binned)).alias("s")).where(F.col("s.bin").isNotNull())
              .groupBy("s.feature", "s.bin").agg(F.count(F.lit(1)).alias("n")))
    spark = df.sparkSession
    grid = spark.createDataFrame(
        [(c, i, lo + (hi - lo) * i / bins, lo + (hi - lo) * (i + 1) / bins)
         for c, (lo, hi) in edges.items() if lo is not None for i in range(bins)],
        "feature string, bin int, lo double, hi double")
    # both sides are columns x bins rows
    return grid.join(counts, ["feature", "bin"], "left").select(
        "feature", "bin", "lo", "hi", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def categorical_top_k(df: DataFrame, cols: Sequence[str], k: int = 10) -> DataFrame:
    """Per column, the ``k`` most frequent values (ties by value) with their rank."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("s")).select("s.*")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    # distinct values per column: a per-column window is bounded by the column's cardinality
    w = Window.partitionBy("feature").orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson ``r`` for every pair ``a < b`` (column order), missing values left out by pair.

    Null where fewer than two rows hold both columns or one of them is constant there.
    """
    cols = numeric_columns(df, cols)
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, r double")
    names = F.array(*map(F.lit, cols))
    return correlations(df, cols).select(names[F.col("a")].alias("feature_a"), names[F.col("b")].alias("feature_b"), "r")


def correlated_pairs(corr: DataFrame, threshold: float = 0.8) -> DataFrame:
    """C11: pairs with ``|r| >= threshold``."""
    return corr.where(F.abs(F.col("r")) >= threshold)


def before_after(raw: DataFrame, transformed: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``describe`` of the same columns before and after a transform, tagged by stage."""
    a = describe(raw, cols).withColumn("stage", F.lit("before"))
    made = set(columns_with_prefix(transformed, [f"{x}_" for x in cols])) | set(cols)
    b = describe(transformed, [c for c in transformed.columns if c in made])
    return a.unionByName(b.withColumn("stage", F.lit("after")))


def dimension_path(stages: Sequence[tuple[str, DataFrame]], exclude: Sequence[str] = ()) -> DataFrame:
    """C14: ``(step, stage, n_columns)`` read from the schema of each stage (no data pass)."""
    spark = stages[0][1].sparkSession
    rows = [(i, name, len([c for c in d.columns if c not in exclude]))
            for i, (name, d) in enumerate(stages)]
    return spark.createDataFrame(rows, "step int, stage string, n_columns int")


def cumulative_share(df: DataFrame, key: str, value: str) -> DataFrame:
    """Share of ``value`` and its running share, ordered by value desc then key.

    The running sum goes through :func:`running_total`, so a long ranking is
    never pulled into one task.
    """
    total = df.agg(F.sum(value).alias("t")).first()["t"] or 0
    ordered = df.select(key, value).withColumn("_v", F.col(value).cast("double"))
    ranked = running_total(ordered, [("_v", False), (key, True)], {"_cum": value})
    return ranked.select(
        key, value,
        (F.col(value) / F.lit(float(total))).alias("share"),
        (F.col("_cum") / F.lit(float(total))).alias("cumulative_share"),
    )
