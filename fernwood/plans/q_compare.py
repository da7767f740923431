"""Model comparison queries (J18-J25) over a long metrics table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwood.functions import rounded
from fernwood.operators import compare as C, metrics as M
from fernwood.plans.q_metrics import BM_CTE, F1_CAT_SQL, _r
from fernwood.plans.registry import register
from fernwood.plans.standins import CONNECTION_SQL, binary_scores, connection_log, multiclass_scores
from fernwood.schema import LABELS

BINARY_METRICS = ["accuracy", "precision", "recall", "f1", "auc"]
LONG_SQL = f"""{BM_CTE},
lng AS (SELECT model, 'binary' AS task, metric, -1 AS class_id, value
        FROM bm UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1, auc)))"""


def metrics_table(spark, sf_dir) -> DataFrame:
    """Long metrics of the stand-in binary scores (rounded as reported)."""
    wide = _r(M.binary_metrics(binary_scores(spark, sf_dir), ["model"]), BINARY_METRICS)
    return C.metrics_long(wide, "binary", BINARY_METRICS)


@register("model_comparison", sql=f"WITH {LONG_SQL} SELECT model, 'binary' AS task, accuracy, precision, "
                                  f"recall, f1, auc FROM bm")
def model_comparison(spark, sf_dir):
    """Model x metric table."""
    return C.model_comparison(metrics_table(spark, sf_dir), BINARY_METRICS)


@register("best_model", sql=f"""WITH {LONG_SQL}
SELECT task, model, metric, value FROM (
  SELECT *, row_number() OVER (PARTITION BY task ORDER BY value DESC, model) AS r FROM lng WHERE metric = 'auc')
WHERE r = 1""")
def best_model(spark, sf_dir):
    """The model with the highest AUC per task."""
    return C.best_model(metrics_table(spark, sf_dir), "auc")


@register("metric_compare", sql=f"""WITH {LONG_SQL}
SELECT a.task, a.model AS model_a, b.model AS model_b, 'recall' AS metric,
       CASE WHEN a.value > b.value THEN 'better' WHEN a.value < b.value THEN 'worse' ELSE 'equal' END AS verdict
FROM lng a JOIN lng b ON a.task = b.task AND a.metric = b.metric AND a.model <> b.model
WHERE a.metric = 'recall'""")
def metric_compare(spark, sf_dir):
    """Every ordered model pair compared on recall."""
    return C.metric_compare(metrics_table(spark, sf_dir), "recall")


@register("metric_delta", sql=f"""WITH {LONG_SQL}
SELECT a.task, a.metric, a.value AS baseline, b.value AS tuned, round(b.value - a.value, 6) AS delta
FROM lng a JOIN lng b ON a.task = b.task AND a.metric = b.metric
WHERE a.model = 'len_1000' AND b.model = 'len_300'""")
def metric_delta(spark, sf_dir):
    """Change of every metric from a baseline model to a tuned one."""
    d = C.metric_delta(metrics_table(spark, sf_dir), "len_1000", "len_300")
    return d.withColumn("delta", rounded(F.col("delta")))


_GAP_METRICS = ["accuracy", "precision", "recall", "f1"]


def _detector_long(c: DataFrame) -> DataFrame:
    s = c.select(F.lit("value_gt_20").alias("model"), (F.col("label") != "view").cast("int").alias("y_true"),
                 (F.col("value") > 20).cast("int").alias("y_pred"))
    c2 = M.binary_counts(s, ["model"])
    from fernwood.functions import safe_div
    wide = c2.select("model",
                     safe_div(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
                     safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                     safe_div(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                     safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))
    return C.metrics_long(_r(wide, _GAP_METRICS), "binary", _GAP_METRICS)


def _det_sql(split):
    return f"""SELECT 'value_gt_20' AS model, metric, value FROM (
  SELECT round((tp + tn) / n, 6) AS accuracy,
         round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
         round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
         round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1
  FROM (SELECT count(*) FILTER (WHERE label <> 'view' AND value > 20) AS tp,
               count(*) FILTER (WHERE label = 'view' AND value > 20) AS fp,
               count(*) FILTER (WHERE label <> 'view' AND NOT value > 20) AS fn,
               count(*) FILTER (WHERE label = 'view' AND NOT value > 20) AS tn, count(*) AS n
        FROM conn WHERE split = '{split}'))
UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1))"""


@register("generalization_gap", sql=f"""WITH {CONNECTION_SQL},
tr AS ({_det_sql('train')}), te AS ({_det_sql('test')})
SELECT tr.model, tr.metric, tr.value AS train, te.value AS test, round((tr.value - te.value) * 100, 6) AS gap_points
FROM tr JOIN te ON tr.model = te.model AND tr.metric = te.metric""")
def generalization_gap(spark, sf_dir):
    """Train-split minus test-split score of a detector, in points."""
    c = connection_log(spark, sf_dir)
    g = C.generalization_gap(_detector_long(c.where(F.col("split") == "train")),
                             _detector_long(c.where(F.col("split") == "test")))
    return g.withColumn("gap_points", rounded(F.col("gap_points")))


def _cat_f1(spark, sf_dir) -> DataFrame:
    dim = spark.createDataFrame([(i, c) for i, _, c in LABELS], "label_id int, category string")
    return _r(M.f1_by_category(multiclass_scores(spark, sf_dir), dim, ["model"]), ["f1"])


@register("category_spread", sql=f"""SELECT category, round(avg(f1), 6) AS mean_f1, min(f1) AS min_f1,
  max(f1) AS max_f1, count(*) AS n_models FROM ({F1_CAT_SQL}) GROUP BY category""")
def category_spread(spark, sf_dir):
    """Mean, min and max category F1 over models."""
    s = C.category_spread(_cat_f1(spark, sf_dir))
    return _r(s, ["mean_f1", "min_f1", "max_f1"])


@register("key_metric_series", sql=f"""WITH {LONG_SQL},
g AS (SELECT DISTINCT model, unnest(['accuracy', 'f1', 'auc', 'log_loss']) AS metric FROM lng)
SELECT g.model, regexp_replace(g.model, 'len_', 'length ') AS label, g.metric, coalesce(l.value, 0.0) AS value
FROM g LEFT JOIN lng l ON g.model = l.model AND g.metric = l.metric""")
def key_metric_series(spark, sf_dir):
    """Per model, accuracy / F1 / AUC / log loss for a grouped chart; missing metric -> 0."""
    return C.key_metric_series(metrics_table(spark, sf_dir), ["accuracy", "f1", "auc", "log_loss"],
                               ("len_", "length "))


@register("category_series", sql=f"""SELECT g.model, g.category, coalesce(f.f1, 0.0) AS f1
FROM (SELECT DISTINCT model, unnest(['DoS', 'Probe', 'R2L', 'U2R']) AS category FROM ({F1_CAT_SQL})) g
LEFT JOIN ({F1_CAT_SQL}) f ON g.model = f.model AND g.category = f.category""")
def category_series(spark, sf_dir):
    """F1 of four fixed attack categories per model; missing -> 0."""
    return C.category_series(_cat_f1(spark, sf_dir), ["DoS", "Probe", "R2L", "U2R"])
