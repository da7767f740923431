"""Metric queries (J1-J17, B6, B9) over deterministic stand-in scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwood.functions import rounded
from fernwood.operators import metrics as M
from fernwood.operators.sample import balanced_weights
from fernwood.plans.registry import register
from fernwood.plans.standins import (BINARY_SCORES_SQL, CONNECTION_SQL, EVENT_LABELS_SQL,
                                     MULTI_SCORES_SQL, binary_scores, connection_log,
                                     event_label_frames, multiclass_scores)
from fernwood.schema import FIVE_CATEGORIES, LABELS, compose_label_dim
from fernwood.sources.tables import table


def _r(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c)) for c in cols})


_AUC_SQL = """bs AS (SELECT model, y_prob, sum(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS pos,
                       sum(CASE WHEN y_true <> 1 THEN 1 ELSE 0 END) AS neg
             FROM scores GROUP BY model, y_prob),
cb AS (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY y_prob ROWS UNBOUNDED PRECEDING) AS neg_cum FROM bs),
auc AS (SELECT model, CASE WHEN sum(pos) = 0 OR sum(neg) = 0 THEN NULL ELSE
          sum(pos * ((neg_cum - neg) + neg / 2.0))::DOUBLE / (sum(pos)::DOUBLE * sum(neg)::DOUBLE) END AS auc
        FROM cb GROUP BY model)"""


@register("confusion_matrix", sql=f"""WITH {MULTI_SCORES_SQL},
lab AS (SELECT model, y_true AS l FROM mscores UNION SELECT model, y_pred FROM mscores),
pc AS (SELECT model, y_true, y_pred, count(*) AS n FROM mscores GROUP BY ALL)
SELECT a.model, a.l AS y_true, b.l AS y_pred, CAST(coalesce(pc.n, 0) AS BIGINT) AS n
FROM lab a JOIN lab b ON a.model = b.model
LEFT JOIN pc ON pc.model = a.model AND pc.y_true = a.l AND pc.y_pred = b.l""")
def confusion_matrix(spark, sf_dir):
    """Dense confusion matrix per model, zero cells present."""
    return M.confusion_matrix(multiclass_scores(spark, sf_dir), ["model"])


_COUNTS_SQL = """c AS (SELECT model, sum(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN y_true <> 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN y_true = 1 AND y_pred <> 1 THEN 1 ELSE 0 END) AS fn,
             sum(CASE WHEN y_true <> 1 AND y_pred <> 1 THEN 1 ELSE 0 END) AS tn, count(*) AS n
      FROM scores GROUP BY model)"""
BM_SELECT = """SELECT c.model, round((tp + tn) / n, 6) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1,
       round(auc, 6) AS auc
FROM c JOIN auc ON c.model = auc.model"""
# the binary metrics of the stand-in scores as a CTE named ``bm``
BM_CTE = f"{BINARY_SCORES_SQL}, {_AUC_SQL}, {_COUNTS_SQL}, bm AS ({BM_SELECT})"


@register("binary_metrics", sql=f"WITH {BINARY_SCORES_SQL}, {_AUC_SQL}, {_COUNTS_SQL} {BM_SELECT}")
def binary_metrics(spark, sf_dir):
    """Accuracy, precision, recall, F1 and AUC per model."""
    m = M.binary_metrics(binary_scores(spark, sf_dir), ["model"])
    return _r(m, ["accuracy", "precision", "recall", "f1", "auc"])


@register("roc_auc", sql=f"WITH {BINARY_SCORES_SQL}, {_AUC_SQL} SELECT model, round(auc, 6) AS auc FROM auc")
def roc_auc(spark, sf_dir):
    """Tie-aware AUC per model."""
    return _r(M.roc_auc(binary_scores(spark, sf_dir), ["model"]), ["auc"])


@register("roc_curve", sql=f"""WITH {BINARY_SCORES_SQL},
bs AS (SELECT model, y_prob, sum(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS pos,
              sum(CASE WHEN y_true <> 1 THEN 1 ELSE 0 END) AS neg FROM scores GROUP BY model, y_prob),
c AS (SELECT model, y_prob, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, row_number() OVER w AS idx
      FROM bs WINDOW w AS (PARTITION BY model ORDER BY y_prob DESC ROWS UNBOUNDED PRECEDING)),
d AS (SELECT *, lag(tps) OVER w2 AS tp_prev, lag(fps) OVER w2 AS fp_prev,
             lead(tps) OVER w2 AS tp_next, lead(fps) OVER w2 AS fp_next
      FROM c WINDOW w2 AS (PARTITION BY model ORDER BY idx)),
tot AS (SELECT model, sum(pos) AS P, sum(neg) AS N FROM bs GROUP BY model),
k AS (SELECT model, idx, y_prob AS threshold, tps, fps FROM d
      WHERE tp_prev IS NULL OR tp_next IS NULL OR fp_next - 2 * fps + fp_prev <> 0
         OR tp_next - 2 * tps + tp_prev <> 0
      UNION ALL SELECT model, 0, 'inf'::DOUBLE, 0, 0 FROM tot)
SELECT k.model, CAST(k.idx AS BIGINT) AS idx, k.threshold, round(fps / N, 6) AS fpr, round(tps / P, 6) AS tpr
FROM k JOIN tot ON k.model = tot.model""")
def roc_curve(spark, sf_dir):
    """ROC points per model, collinear points dropped, leading (0, 0)."""
    return _r(M.roc_curve(binary_scores(spark, sf_dir), ["model"]), ["fpr", "tpr"])


_MARG_SQL = """pc AS (SELECT model, y_true, y_pred, count(*) AS n FROM mscores GROUP BY ALL),
t AS (SELECT model, y_true AS class_id, sum(n) AS n_true,
             sum(CASE WHEN y_true = y_pred THEN n ELSE 0 END) AS tp FROM pc GROUP BY ALL),
p AS (SELECT model, y_pred AS class_id, sum(n) AS n_pred FROM pc GROUP BY ALL),
m AS (SELECT coalesce(t.model, p.model) AS model, coalesce(t.class_id, p.class_id) AS class_id,
             coalesce(tp, 0) AS tp, coalesce(n_true, 0) AS n_true, coalesce(n_pred, 0) AS n_pred
      FROM t FULL OUTER JOIN p ON t.model = p.model AND t.class_id = p.class_id)"""


@register("macro_prf", sql=f"""WITH {MULTI_SCORES_SQL}, {_MARG_SQL}
SELECT model, round(avg(CASE WHEN n_pred = 0 THEN 0 ELSE tp / n_pred END), 6) AS precision_macro,
       round(avg(CASE WHEN n_true = 0 THEN 0 ELSE tp / n_true END), 6) AS recall_macro,
       round(avg(CASE WHEN n_true + n_pred = 0 THEN 0 ELSE 2 * tp / (n_true + n_pred) END), 6) AS f1_macro
FROM m GROUP BY model""")
def macro_prf(spark, sf_dir):
    """Macro precision / recall / F1 over the union of labels."""
    return _r(M.macro_prf(multiclass_scores(spark, sf_dir), ["model"]),
              ["precision_macro", "recall_macro", "f1_macro"])


_K_LABELS = list(range(12))
_PER_CLASS_SQL = f"""WITH {MULTI_SCORES_SQL}, {_MARG_SQL},
g AS (SELECT DISTINCT model, CAST(c.range AS INTEGER) AS class_id FROM mscores, range({len(_K_LABELS)}) c),
j AS (SELECT g.model, g.class_id, coalesce(tp, 0) AS tp, coalesce(n_true, 0) AS n_true,
             coalesce(n_pred, 0) AS n_pred
      FROM g LEFT JOIN m ON g.model = m.model AND g.class_id = m.class_id)"""


@register("per_class_recall", sql=_PER_CLASS_SQL + """
SELECT model, class_id, round(CASE WHEN n_true = 0 THEN 0 ELSE tp / n_true END, 6) AS recall FROM j""")
def per_class_recall(spark, sf_dir):
    """Recall of each class of a fixed 12-label list (absent classes give 0)."""
    pc = M.per_class(multiclass_scores(spark, sf_dir), _K_LABELS, ["model"])
    return _r(pc.select("model", "class_id", "recall"), ["recall"])


@register("per_class_f1", sql=_PER_CLASS_SQL + """
SELECT model, class_id, round(CASE WHEN n_true + n_pred = 0 THEN 0 ELSE 2 * tp / (n_true + n_pred) END, 6) AS f1
FROM j""")
def per_class_f1(spark, sf_dir):
    """One-vs-rest F1 of each class of a fixed label list."""
    pc = M.per_class(multiclass_scores(spark, sf_dir), _K_LABELS, ["model"])
    return _r(pc.select("model", "class_id", "f1"), ["f1"])


@register("multiclass_metrics", sql=f"""WITH {MULTI_SCORES_SQL}, {_MARG_SQL},
a AS (SELECT model, avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) AS accuracy,
             avg(CASE WHEN y_true = 9 THEN NULL WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) AS known_class_accuracy
      FROM mscores GROUP BY model),
f AS (SELECT model, avg(CASE WHEN n_true + n_pred = 0 THEN 0 ELSE 2 * tp / (n_true + n_pred) END) AS f1_macro
      FROM m GROUP BY model)
SELECT a.model, round(accuracy, 6) AS accuracy, round(known_class_accuracy, 6) AS known_class_accuracy,
       round(f1_macro, 6) AS f1_macro FROM a JOIN f ON a.model = f.model""")
def multiclass_metrics(spark, sf_dir):
    """Accuracy, known-class accuracy (class 9 treated as unseen) and macro F1."""
    m = M.multiclass_metrics(multiclass_scores(spark, sf_dir), ["model"], unseen_ids=[9])
    return _r(m, ["accuracy", "known_class_accuracy", "f1_macro"])


@register("known_class_accuracy", sql=f"""WITH {MULTI_SCORES_SQL}
SELECT model, round(avg(CASE WHEN y_true IN (0, 1) THEN NULL WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END), 6)
       AS known_class_accuracy FROM mscores GROUP BY model""")
def known_class_accuracy(spark, sf_dir):
    """Accuracy without rows whose true class is unseen (0 and 1 here)."""
    k = M.known_class_accuracy(multiclass_scores(spark, sf_dir), [0, 1], ["model"])
    return _r(k, ["known_class_accuracy"])


@register("known_class_accuracy_or_zero", sql=f"""WITH {MULTI_SCORES_SQL}
SELECT model || ', ' || declared AS model, round(coalesce(avg(CASE WHEN y_true < unseen THEN NULL
                                  WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END), 0.0), 6)
       AS known_class_accuracy
FROM mscores, (VALUES ('half unseen', 5), ('all unseen', 10)) d(declared, unseen) GROUP BY model, declared""")
def known_class_accuracy_or_zero(spark, sf_dir):
    """Same, but 0.0 when no known row is left: half the classes declared unseen, then all of them."""
    scores = multiclass_scores(spark, sf_dir)
    out = [M.known_class_accuracy(scores, list(range(n)), ["model"], empty_value=0.0).withColumn(
        "model", F.concat("model", F.lit(f", {declared} unseen"))) for declared, n in (("half", 5), ("all", 10))]
    return _r(out[0].unionByName(out[1]), ["known_class_accuracy"])


_DIGITS_SQL = """ds AS (SELECT 'digits' AS model, doc_id AS row_id,
                CAST(length(CAST(n_chars AS VARCHAR)) AS INTEGER) AS y_true,
                CAST(length(CAST(n_chars + doc_id % 50 AS VARCHAR)) AS INTEGER) AS y_pred FROM documents)"""


def _digit_scores(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.lit("digits").alias("model"), F.col("doc_id").alias("row_id"),
                    F.length(F.col("n_chars").cast("string")).cast("int").alias("y_true"),
                    F.length((F.col("n_chars") + F.pmod("doc_id", F.lit(50))).cast("string"))
                    .cast("int").alias("y_pred"))


@register("rare_class_accuracy", sql=f"""WITH {_DIGITS_SQL},
rare AS (SELECT model, y_true FROM ds GROUP BY model, y_true HAVING count(*) < 5),
full_acc AS (SELECT model, avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) AS full_accuracy FROM ds GROUP BY model),
kept AS (SELECT model, avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) AS known_class_accuracy, count(*) AS n_scored
         FROM ds WHERE (model, y_true) NOT IN (SELECT (model, y_true) FROM rare) GROUP BY model),
dr AS (SELECT model, count(*) AS n_rare FROM rare GROUP BY model)
SELECT f.model, round(full_accuracy, 6) AS full_accuracy, round(known_class_accuracy, 6) AS known_class_accuracy,
       coalesce(n_scored, 0) AS n_scored, coalesce(n_rare, 0) AS n_rare
FROM full_acc f LEFT JOIN kept k ON f.model = k.model LEFT JOIN dr ON f.model = dr.model""")
def rare_class_accuracy(spark, sf_dir):
    """Accuracy without true classes that have fewer than 5 rows (listed by ``rare_classes``)."""
    r = M.rare_class_accuracy(_digit_scores(spark, sf_dir), ["model"], min_count=5)
    return _r(r, ["full_accuracy", "known_class_accuracy"])


@register("rare_classes", sql=f"""WITH {_DIGITS_SQL}
SELECT model, y_true, count(*) AS n FROM ds GROUP BY model, y_true HAVING count(*) < 5""")
def rare_classes(spark, sf_dir):
    """The true classes with fewer than 5 rows."""
    return M.rare_classes(_digit_scores(spark, sf_dir), ["model"], min_count=5)


_DICTIONARY_SQL = "label_dictionary(label_id, name, category) AS (VALUES " + ", ".join(
    f"({i}, '{n}', '{c}')" for i, n, c in LABELS) + ")"


def _label_dictionary(spark) -> DataFrame:
    return spark.createDataFrame([(i, n, c) for i, n, c in LABELS], "label_id int, name string, category string")


F1_CAT_SQL = f"""WITH {MULTI_SCORES_SQL}, {_DICTIONARY_SQL},
s AS (SELECT model, t.category AS true_cat, coalesce(p.category, 'unknown') AS pred_cat
      FROM mscores JOIN label_dictionary t ON mscores.y_true = t.label_id LEFT JOIN label_dictionary p ON mscores.y_pred = p.label_id),
cats AS (SELECT DISTINCT category FROM label_dictionary),
g AS (SELECT DISTINCT model, category FROM mscores, cats),
c AS (SELECT g.model, g.category,
             count(*) FILTER (WHERE s.true_cat = g.category AND s.pred_cat = g.category) AS tp,
             count(*) FILTER (WHERE s.true_cat = g.category) AS n_true,
             count(*) FILTER (WHERE s.pred_cat = g.category) AS n_pred
      FROM g JOIN s ON g.model = s.model GROUP BY g.model, g.category)
SELECT model, category, round(CASE WHEN n_true + n_pred = 0 THEN 0 ELSE 2 * tp / (n_true + n_pred) END, 6) AS f1
FROM c"""


@register("f1_by_category", sql=F1_CAT_SQL)
def f1_by_category(spark, sf_dir):
    """F1 per attack category of fine-grained predictions (all dictionary categories)."""
    dim = _label_dictionary(spark).select("label_id", "category")
    return _r(M.f1_by_category(multiclass_scores(spark, sf_dir), dim, ["model"]), ["f1"])


@register("f1_by_label_map", sql=f"""WITH {MULTI_SCORES_SQL}, {_DICTIONARY_SQL},
mp AS (SELECT label_id, category FROM (
         SELECT label_id, category, row_number() OVER (PARTITION BY category ORDER BY label_id DESC) AS r
         FROM label_dictionary) WHERE r = 1),
g AS (SELECT DISTINCT model, label_id, category FROM mscores, mp),
c AS (SELECT g.model, g.category,
             count(*) FILTER (WHERE s.y_true = g.label_id AND s.y_pred = g.label_id) AS tp,
             count(*) FILTER (WHERE s.y_true = g.label_id) AS n_true,
             count(*) FILTER (WHERE s.y_pred = g.label_id) AS n_pred
      FROM g JOIN mscores s ON g.model = s.model GROUP BY g.model, g.category)
SELECT model, category, round(CASE WHEN n_true + n_pred = 0 THEN 0 ELSE 2 * tp / (n_true + n_pred) END, 6) AS f1
FROM c""")
def f1_by_label_map(spark, sf_dir):
    """One-vs-rest F1 per mapped label keyed by category; the last label of a category wins.

    The mapping is the whole dictionary.
    """
    dim = _label_dictionary(spark).select(F.col("label_id").alias("position"), "label_id", "category")
    return _r(M.f1_by_label_map(multiclass_scores(spark, sf_dir), dim, ["model"]), ["f1"])


def _conn_detector(spark, sf_dir) -> DataFrame:
    """Connection test split with a fixed detector (``value > 20``) and the 5-class truth."""
    names, cats = event_label_frames(spark)
    dim = compose_label_dim(names, cats)
    c = connection_log(spark, sf_dir).where(F.col("split") == "test")
    return c.join(F.broadcast(dim.select(F.col("name").alias("label"), "category", "category_id")),
                  "label", "inner").select(
        F.lit("value_gt_20").alias("model"), "key", "category",
        F.col("category_id").alias("y_true"), (F.col("value") > 20).cast("int").alias("y_pred"))


_CONN_DET_SQL = f"""{CONNECTION_SQL}, {EVENT_LABELS_SQL},
cats(category_id, category) AS (VALUES """ + ", ".join(
    f"({i}, '{c}')" for i, c in enumerate(FIVE_CATEGORIES)) + """),
det AS (SELECT 'value_gt_20' AS model, key, e.category, cats.category_id AS y_true,
               CAST(value > 20 AS INTEGER) AS y_pred
        FROM conn JOIN event_labels e ON conn.label = e.name JOIN cats ON e.category = cats.category
        WHERE split = 'test')"""


@register("f1_binary_vs_category", sql=f"""WITH {_CONN_DET_SQL}
SELECT det.model, cats.category,
  round(CASE WHEN count(*) FILTER (WHERE y_true = cats.category_id) + count(*) FILTER (WHERE y_pred = 1) = 0 THEN 0
        ELSE 2 * count(*) FILTER (WHERE y_true = cats.category_id AND y_pred = 1)
             / (count(*) FILTER (WHERE y_true = cats.category_id) + count(*) FILTER (WHERE y_pred = 1)) END, 6) AS f1
FROM det, cats GROUP BY det.model, cats.category""")
def f1_binary_vs_category(spark, sf_dir):
    """Binary detector F1 against each category (parity; see detection_rate)."""
    return _r(M.f1_binary_vs_category(_conn_detector(spark, sf_dir), FIVE_CATEGORIES, ["model"]), ["f1"])


@register("detection_rate", sql=f"""WITH {_CONN_DET_SQL}
SELECT model, category, round(avg(y_pred), 6) AS detection_rate, count(*) AS n FROM det GROUP BY model, category""")
def detection_rate(spark, sf_dir):
    """Share of rows flagged by the detector within each true category."""
    return _r(M.detection_rate(_conn_detector(spark, sf_dir), "category", ["model"]), ["detection_rate"])


_LL = "-ln(greatest(CASE WHEN y_true = 1 THEN y_prob ELSE 1 - y_prob END, 1e-15))"


@register("log_loss", sql=f"""WITH {BINARY_SCORES_SQL}
SELECT model, round(avg({_LL}), 6) AS log_loss FROM scores GROUP BY model""")
def log_loss(spark, sf_dir):
    """Mean cross-entropy per model."""
    return _r(M.log_loss(binary_scores(spark, sf_dir), ["model"]), ["log_loss"])


@register("weighted_log_loss", sql=f"""WITH {BINARY_SCORES_SQL},
base AS (SELECT l.toxic AS y FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
cw AS (SELECT y AS class_id, (SELECT count(*) FROM base) / ((SELECT count(DISTINCT y) FROM base) * count(*)) AS weight
       FROM base GROUP BY y)
SELECT model, round(sum(coalesce(weight, 1.0) * {_LL}) / sum(coalesce(weight, 1.0)), 6) AS weighted_log_loss
FROM scores LEFT JOIN cw ON scores.y_true = cw.class_id GROUP BY model""")
def weighted_log_loss(spark, sf_dir):
    """Class-weighted cross-entropy with balanced weights from the truth column."""
    s = binary_scores(spark, sf_dir)
    base = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id") \
        .select(F.col("toxic").alias("y"))
    w = balanced_weights(base, "y")
    return _r(M.weighted_log_loss(s, w, ["model"]), ["weighted_log_loss"])
