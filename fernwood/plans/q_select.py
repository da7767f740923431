"""Feature selection and array-prediction queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fernwood.functions import argmax, rounded, softmax
from fernwood.operators import select as sel
from fernwood.plans.registry import register
from fernwood.plans.standins import CONNECTION_SQL, connection_log
from fernwood.sources.tables import table

_VAR_COLS = ["value", "k", "hour", "user_id"]
_VAR_SQL = f"WITH {CONNECTION_SQL} " + " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS feature, var_pop({c}) AS variance FROM conn WHERE split = 'train'"
    for i, c in enumerate(_VAR_COLS))


_LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINE_VAR_SQL = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS feature, var_pop({c}) AS variance FROM lineitem"
    for i, c in enumerate(_LINE_COLS))


@register("variance_filter", sql=f"""SELECT position, feature, round(variance, 6) AS variance,
  variance > 0.01 AS kept FROM ({_LINE_VAR_SQL})""")
def variance_filter(spark, sf_dir):
    """F1: population variance per column and whether it passes the 0.01 threshold."""
    v = sel.column_variances(table(spark, sf_dir, "lineitem"), _LINE_COLS)
    return v.select("position", "feature", rounded(F.col("variance")).alias("variance"),
                    (F.col("variance") > sel.DEFAULT_VARIANCE_THRESHOLD).alias("kept"))


@register("top_k_features", sql=f"""SELECT position, feature, round(variance, 6) AS importance
FROM ({_VAR_SQL}) ORDER BY variance DESC, position LIMIT 3""")
def top_k_features(spark, sf_dir):
    """top 3 columns of a ranking (here the variance ranking), ties in input order."""
    tr = connection_log(spark, sf_dir).where(F.col("split") == "train")
    ranked = sel.column_variances(tr, _VAR_COLS).withColumnRenamed("variance", "importance")
    top = sel.top_k(ranked, 3)
    return top.select("position", "feature", rounded(F.col("importance")).alias("importance"))


_LOGITS = "list_transform(embedding, lambda v: CAST(v AS DOUBLE))"


@register("argmax_predict", sql=f"""SELECT vec_id, label AS y_true,
  CAST(list_position({_LOGITS}, list_max({_LOGITS})) - 1 AS INTEGER) AS y_pred FROM embeddings""")
def argmax_predict(spark, sf_dir):
    """Predicted class = argmax of a score row (the 64 embedding values as class scores)."""
    e = table(spark, sf_dir, "embeddings")
    logits = F.transform("embedding", lambda v: v.cast("double"))
    return e.select("vec_id", F.col("label").alias("y_true"), argmax(logits).alias("y_pred"))


@register("softmax_rows", sql=f"""WITH l AS (SELECT vec_id, {_LOGITS} AS z FROM embeddings),
e AS (SELECT vec_id, list_transform(z, lambda v: exp(v - list_max(z))) AS ez FROM l)
SELECT vec_id, CAST(unnest(range(len(ez))) AS INTEGER) AS class_id,
       round(unnest(list_transform(ez, lambda v: v / list_sum(ez))), 6) AS prob FROM e""")
def softmax_rows(spark, sf_dir):
    """Softmax of each score row, one output row per class."""
    e = table(spark, sf_dir, "embeddings")
    logits = F.transform("embedding", lambda v: v.cast("double"))
    p = e.select("vec_id", F.posexplode(softmax(logits)).alias("class_id", "prob"))
    return p.select("vec_id", F.col("class_id").cast("int").alias("class_id"), rounded(F.col("prob")).alias("prob"))
