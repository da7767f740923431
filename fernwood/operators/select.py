"""Feature selection: variance filter, forest importance, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwood.operators.quantiles import numeric_columns, present

DEFAULT_VARIANCE_THRESHOLD = 0.01
DEFAULT_TOP_K = 20
DEFAULT_TREES = 100
DEFAULT_SEED = 42


def column_variances(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(position, feature, variance)``: population variance of every column, one pass; null and NaN are left out."""
    cols = numeric_columns(df, cols)
    row = df.agg(*[F.var_pop(present(c)).alias(f"v{i}") for i, c in enumerate(cols)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), F.col(f"v{i}").alias("variance"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")


def variance_filter(df: DataFrame, cols: Sequence[str] | None = None,
                    threshold: float = DEFAULT_VARIANCE_THRESHOLD) -> list[str]:
    """columns whose population variance is above ``threshold``, in input order."""
    rows = column_variances(df, cols).where(F.col("variance") > threshold).orderBy("position").collect()
    return [r["feature"] for r in rows]


def top_k(ranking: DataFrame, k: int, score: str = "importance", position: str = "position") -> DataFrame:
    """the ``k`` highest scores, descending; ties keep input order; ``k`` capped by length."""
    return ranking.orderBy(F.desc(score), F.asc(position)).limit(max(int(k), 0))


def importances_frame(spark, names: Sequence[str], values) -> DataFrame:
    """Feature importances of a fitted tree model as ``(position, feature, importance)`` rows."""
    arr = values.toArray() if hasattr(values, "toArray") else list(values)
    return spark.createDataFrame([(i, n, float(arr[i])) for i, n in enumerate(names)],
                                 "position int, feature string, importance double")


def rf_importance(df: DataFrame, features: Sequence[str], label: str = "y",
                  trees: int = DEFAULT_TREES, seed: int = DEFAULT_SEED, **params):
    """importances of a ``trees``-tree forest (sum 1); returns ``(frame, model)``."""
    from fernwood.operators.learn import assemble, forest

    model = forest(trees=trees, seed=seed, label=label, **params).fit(assemble(df, features, label))
    return importances_frame(df.sparkSession, features, model.featureImportances), model


def feature_selection(df: DataFrame, features: Sequence[str], label: str = "y",
                      k: int = DEFAULT_TOP_K, threshold: float = DEFAULT_VARIANCE_THRESHOLD,
                      seed: int = DEFAULT_SEED, trees: int = DEFAULT_TREES, max_depth: int | None = None):
    """variance filter -> forest on the kept columns -> top ``k`` by importance.

    Returns ``(selected columns, forest model)``; apply with ``df.select(*cols)``.
    """
    kept = variance_filter(df, features, threshold)
    imp, model = rf_importance(df, kept, label, trees=trees, seed=seed, max_depth=max_depth)
    cols = [r["feature"] for r in top_k(imp, k).collect()]
    return cols, model
