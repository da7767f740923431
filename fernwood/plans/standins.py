"""Stand-in inputs built from the driver tables (shape only, no job work).

The reference runs on a labelled connection log that is not part of the test
data.  These helpers give the jobs rows of the schema they expect:

* ``connection_log``: ``events`` as a labelled log.  ``event_type`` is the
  label (``view`` plays ``normal``), ``value`` and the JSON counter ``k`` are
  long-tailed numbers, ``user_id`` is a high-cardinality category and the
  weekday a low-cardinality one.  ``event_id % 5 = 0`` is the fixed test split.
  ``unseen_case`` drops one label from the training split, for the queries about
  labels that are unseen at fit time.
* ``binary_scores``: ``documents`` joined to ``labels``; three fixed scoring
  rules on the text length stand in for model outputs against ``toxic``.
* ``multiclass_scores``: ``embeddings`` with a fixed rule as prediction.

Every value each SQL oracle needs is rebuilt by the matching SQL text below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernwood.sources.tables import table

# Fixed stand-in dictionary: event type -> (label id, category)
EVENT_LABELS = [
    (0, "click", "DoS"),
    (1, "error", "Probe"),
    (2, "purchase", "R2L"),
    (3, "signup", "U2R"),
    (4, "view", "Normal"),
]
NORMAL_LABEL = "view"
UNSEEN_IN_TRAIN = "signup"
CONN_NUMERIC = ["value", "k", "hour", "user_id"]
CONN_CATEGORICAL = ["service", "flag"]


def event_label_frames(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    names = spark.createDataFrame([(i, n) for i, n, _ in EVENT_LABELS], "label_id int, name string")
    cats = spark.createDataFrame([(i, c) for i, _, c in EVENT_LABELS], "label_id int, category string")
    return names, cats


def connection_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_connection(table(spark, sf_dir, "events"))


def shape_connection(ev: DataFrame) -> DataFrame:
    """Rename/cast ``events`` columns into the connection-log shape (batch or stream)."""
    return ev.select(
        F.col("event_id").alias("key"),
        F.when(F.col("event_id") % 5 == 0, "test").otherwise("train").alias("split"),
        F.col("value"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.hour("ts").alias("hour"),
        F.col("user_id"),
        F.col("user_id").cast("string").alias("service"),
        F.date_format("ts", "EEE").alias("flag"),
        F.col("event_type").alias("label"),
    )


def unseen_case(c: DataFrame) -> DataFrame:
    """The log of the two queries on labels unseen at fit time: no training row has ``UNSEEN_IN_TRAIN``."""
    return c.where(~((F.col("split") == "train") & (F.col("label") == UNSEEN_IN_TRAIN)))


CONNECTION_SQL = """conn AS (
  SELECT event_id AS key,
         CASE WHEN event_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
         value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(hour(ts) AS INTEGER) AS hour,
         user_id,
         CAST(user_id AS VARCHAR) AS service,
         strftime(ts, '%a') AS flag,
         event_type AS label
  FROM events
)"""
# the log of the two queries on labels unseen at fit time
UNSEEN_SQL = CONNECTION_SQL.replace(
    "FROM events\n", f"FROM events WHERE NOT (event_id % 5 <> 0 AND event_type = '{UNSEEN_IN_TRAIN}')\n")

EVENT_LABELS_SQL = "event_labels(label_id, name, category) AS (VALUES " + ", ".join(
    f"({i}, '{n}', '{c}')" for i, n, c in EVENT_LABELS) + ")"

# Fixed stand-in scoring rules: model -> text-length scale of the score
SCORE_RULES = [("len_1000", 1000.0), ("len_3000", 3000.0), ("len_300", 300.0)]


def binary_scores(spark: SparkSession, sf_dir: str, truth: str = "toxic") -> DataFrame:
    """``(model, row_id, y_true, y_pred, y_prob)``; ``y_prob = n/(n+s)``, ``y_pred = y_prob >= 0.5``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col(truth).alias("toxic"))
    base = docs.join(labels, "doc_id", "inner")
    rules = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(s).alias("scale"))
                      for m, s in SCORE_RULES])
    out = base.select("doc_id", "toxic", "n_chars", F.explode(rules).alias("r"))
    prob = F.col("n_chars").cast("double") / (F.col("n_chars").cast("double") + F.col("r.scale"))
    return out.select(
        F.col("r.model").alias("model"),
        F.col("doc_id").alias("row_id"),
        F.col("toxic").alias("y_true"),
        (prob >= 0.5).cast("int").alias("y_pred"),
        prob.alias("y_prob"),
    )


def binary_scores_sql(truth: str = "toxic") -> str:
    return BINARY_SCORES_SQL.replace("l.toxic AS y_true", f"l.{truth} AS y_true")


BINARY_SCORES_SQL = """rules(model, scale) AS (VALUES """ + ", ".join(
    f"('{m}', CAST({s} AS DOUBLE))" for m, s in SCORE_RULES) + """),
scores AS (
  SELECT r.model, d.doc_id AS row_id, l.toxic AS y_true,
         CAST(CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + r.scale) >= 0.5 AS INTEGER) AS y_pred,
         CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + r.scale) AS y_prob
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id, rules r
)"""

# Fixed stand-in rules for 10-class predictions
MULTI_RULES = [("shift_7", 7), ("shift_3", 3)]


def multiclass_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(model, row_id, y_true, y_pred)``: ``y_pred = (label + (vec_id mod m) div 5) mod 10``."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    rules = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(s).alias("m")) for m, s in MULTI_RULES])
    out = emb.select("vec_id", "label", F.explode(rules).alias("r"))
    return out.select(
        F.col("r.model").alias("model"),
        F.col("vec_id").alias("row_id"),
        F.col("label").alias("y_true"),
        F.pmod(F.col("label") + F.floor(F.pmod(F.col("vec_id"), F.col("r.m")) / 5), F.lit(10))
        .cast("int").alias("y_pred"),
    )


MULTI_SCORES_SQL = """mrules(model, m) AS (VALUES """ + ", ".join(
    f"('{m}', {s})" for m, s in MULTI_RULES) + """),
mscores AS (
  SELECT r.model, e.vec_id AS row_id, e.label AS y_true,
         CAST((e.label + (e.vec_id % r.m) // 5) % 10 AS INTEGER) AS y_pred
  FROM embeddings e, mrules r
)"""
