"""Model comparison tables over a long metrics table.

The long table is ``(model, task, metric, class_id, value)``: one row per
model and metric (``class_id`` is -1 for whole-model metrics).  It is small
(models x metrics), so these are plain relational steps: pivot, ranking
window per task, self join on the metric, outer joins to fixed dimensions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def metrics_long(wide: DataFrame, task: str, metrics: Sequence[str], model: str = "model") -> DataFrame:
    """Wide per-model metrics -> ``(model, task, metric, class_id, value)``."""
    return wide.select(model, *[F.col(m).cast("double").alias(m) for m in metrics]) \
        .unpivot([model], list(metrics), "metric", "value") \
        .select(F.col(model).alias("model"), F.lit(task).alias("task"), "metric",
                F.lit(-1).alias("class_id"), "value")


def model_comparison(long: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Model x metric table (one column per metric)."""
    return long.where(F.col("class_id") == -1).groupBy("model", "task") \
        .pivot("metric", list(metrics)).agg(F.first("value"))


def best_model(long: DataFrame, metric: str) -> DataFrame:
    """Per task, the model with the highest ``metric`` (ties: first model name)."""
    w = Window.partitionBy("task").orderBy(F.desc("value"), F.asc("model"))
    # one partition per task, models x 1 rows each
    return long.where((F.col("metric") == metric) & (F.col("class_id") == -1)) \
        .withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1) \
        .select("task", "model", F.lit(metric).alias("metric"), "value")


def metric_compare(long: DataFrame, metric: str) -> DataFrame:
    """Every ordered pair of models of a task compared on ``metric``: better / worse / equal."""
    m = long.where((F.col("metric") == metric) & (F.col("class_id") == -1)).select("task", "model", "value")
    a = m.select("task", F.col("model").alias("model_a"), F.col("value").alias("value_a"))
    b = m.select("task", F.col("model").alias("model_b"), F.col("value").alias("value_b"))
    j = a.join(b, "task", "inner").where(F.col("model_a") != F.col("model_b"))
    return j.select("task", "model_a", "model_b", F.lit(metric).alias("metric"),
                    F.when(F.col("value_a") > F.col("value_b"), "better")
                    .when(F.col("value_a") < F.col("value_b"), "worse").otherwise("equal").alias("verdict"))


def metric_delta(long: DataFrame, baseline: str, tuned: str) -> DataFrame:
    """Per metric, ``tuned - baseline``."""
    p = long.where(F.col("class_id") == -1).where(F.col("model").isin(baseline, tuned)) \
        .groupBy("task", "metric").pivot("model", [baseline, tuned]).agg(F.first("value"))
    return p.select("task", "metric", F.col(baseline).alias("baseline"), F.col(tuned).alias("tuned"),
                    (F.col(tuned) - F.col(baseline)).alias("delta"))


def generalization_gap(train_long: DataFrame, test_long: DataFrame) -> DataFrame:
    """``(train - test) * 100`` per model and metric, in points."""
    a = train_long.select("model", "metric", F.col("value").alias("train"))
    b = test_long.select("model", "metric", F.col("value").alias("test"))
    return a.join(b, ["model", "metric"], "inner").withColumn(
        "gap_points", (F.col("train") - F.col("test")) * F.lit(100.0))


def category_spread(cat_f1: DataFrame) -> DataFrame:
    """Mean, min and max of a per-category score over models."""
    return cat_f1.groupBy("category").agg(F.avg("f1").alias("mean_f1"), F.min("f1").alias("min_f1"),
                                          F.max("f1").alias("max_f1"), F.count(F.lit(1)).alias("n_models"))


def key_metric_series(long: DataFrame, metrics: Sequence[str], rename: tuple[str, str] | None = None) -> DataFrame:
    """``(label, metric, value)`` for a fixed metric list; a missing metric is 0.

    ``rename`` is a ``(pattern, replacement)`` applied to the model name for display.
    """
    models = long.select("model").distinct()
    grid = models.withColumn("metric", F.explode(F.array(*[F.lit(m) for m in metrics])))
    vals = long.where(F.col("class_id") == -1).select("model", "metric", "value")
    out = grid.join(vals, ["model", "metric"], "left").withColumn("value", F.coalesce("value", F.lit(0.0)))
    label = F.regexp_replace("model", rename[0], rename[1]) if rename else F.col("model")
    return out.select("model", label.alias("label"), "metric", "value")


def category_series(cat_f1: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Per model, the F1 of each fixed category; a missing category is 0."""
    grid = cat_f1.select("model").distinct().withColumn(
        "category", F.explode(F.array(*[F.lit(c) for c in categories])))
    return grid.join(cat_f1.select("model", "category", "f1"), ["model", "category"], "left") \
        .withColumn("f1", F.coalesce("f1", F.lit(0.0)))
