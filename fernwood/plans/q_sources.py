"""Source and sink queries (A1-A18) and the streaming transform."""

from __future__ import annotations

from pyspark.sql import functions as F

from fernwood.functions import rounded
from fernwood.operators import encode, learn, outlier
from fernwood.plans.q_compare import LONG_SQL, metrics_table
from fernwood.plans.q_metrics import _r
from fernwood.plans.registry import register
from fernwood.plans.standins import (CONNECTION_SQL, EVENT_LABELS_SQL, NORMAL_LABEL, UNSEEN_SQL, binary_scores,
                                     binary_scores_sql, connection_log, event_label_frames,
                                     shape_connection, unseen_case)
from fernwood.schema import compose_label_dim
from fernwood.session import scratch_path
from fernwood.sources import datasets as D
from fernwood.sources.csv_scan import scan_headerless_csv
from fernwood.sources.tables import table
from fernwood.streaming.fitted_stream import encode_stream, transform_stream

_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@register("scan_headerless_csv", sql="SELECT * FROM events")
def scan_headerless_csv_q(spark, sf_dir):
    """A1-A5: events written as headerless CSV, scanned back with an explicit positional schema."""
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-csv")
    ev.write.mode("overwrite").option("header", "false").option("timestampFormat", _TS_FORMAT) \
        .option("timestampNTZFormat", _TS_FORMAT).csv(path)
    return scan_headerless_csv(spark, path, ev.schema, timestamp_format=_TS_FORMAT)


@register("label_dim_compose", sql=f"""WITH {EVENT_LABELS_SQL},
cats(category_id, category) AS (VALUES (0, 'DoS'), (1, 'Normal'), (2, 'Probe'), (3, 'R2L'), (4, 'U2R'))
SELECT d.label_id, d.name, d.category, c.category_id, count(*) AS n
FROM events e JOIN event_labels d ON e.event_type = d.name JOIN cats c ON c.category = d.category
GROUP BY d.label_id, d.name, d.category, c.category_id""")
def label_dim_compose(spark, sf_dir):
    """Names and categories composed on the shared id, then joined to the events it labels."""
    names, cats = event_label_frames(spark)
    dim = compose_label_dim(names, cats)
    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("name"))
    return ev.join(dim, "name", "inner").groupBy("label_id", "name", "category", "category_id") \
        .agg(F.count(F.lit(1)).alias("n"))


@register("dataset_roundtrip", sql=f"WITH {CONNECTION_SQL} SELECT * FROM conn")
def dataset_roundtrip(spark, sf_dir):
    """A prepared frame saved as Parquet and loaded back unchanged."""
    path = scratch_path(spark, "dataset")
    D.save_dataset(connection_log(spark, sf_dir), path)
    return D.load_dataset(spark, path)


@register("dataset_partitioned_save", sql=f"""WITH {CONNECTION_SQL}, {EVENT_LABELS_SQL}
SELECT key, CAST(label <> '{NORMAL_LABEL}' AS INTEGER) AS y, 'binary' AS task, split FROM conn
UNION ALL
SELECT key, label_id AS y, 'multiclass' AS task, split FROM conn JOIN event_labels ON conn.label = event_labels.name""")
def dataset_partitioned_save(spark, sf_dir):
    """Binary and multiclass targets of both splits in one set partitioned by (task, split)."""
    c = connection_log(spark, sf_dir)
    names, cats = event_label_frames(spark)
    dim = compose_label_dim(names, cats)
    path = scratch_path(spark, "prepared")
    for task, task_name in [("binary", "binary"), ("multiclass", "multiclass")]:
        y = encode.make_labels(c, task, label_dim=dim, normal=NORMAL_LABEL).select(
            "key", F.col("y").cast("int").alias("y"), "split")
        D.save_prepared({s: y.where(F.col("split") == s).drop("split") for s in ("train", "test")},
                        path, task_name)
    return D.load_dataset(spark, path).select("key", "y", "task", "split")


@register("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """A fitted pipeline saved, loaded, and scored; predictions must agree."""
    from pyspark.ml import Pipeline
    from fernwood.plans.q_learn import prepared
    train, test, _ = prepared(spark, sf_dir)
    model = Pipeline(stages=[learn.decision_tree(max_depth=8)]).fit(train)
    path = scratch_path(spark, "model")
    D.save_model(model, path)
    loaded = D.load_model(path)
    a = model.transform(test).select("key", F.col("prediction").alias("before"))
    b = loaded.transform(test).select("key", F.col("prediction").alias("after"))
    return a.join(b, "key").select("key", "before", "after", (F.col("before") == F.col("after")).alias("same"))


@register("metrics_long", sql=f"WITH {LONG_SQL} SELECT * FROM lng")
def metrics_long(spark, sf_dir):
    """Long metrics written as JSON, one folder per model, read back."""
    path = scratch_path(spark, "metrics")
    D.write_metrics(metrics_table(spark, sf_dir), path)
    return D.read_metrics(spark, path)


_NEW_SQL = (binary_scores_sql("quality").replace("rules(", "qrules(").replace("scores AS (", "qscores AS (")
            .replace(", rules r", ", qrules r"))


@register("metrics_upsert", sql=f"""WITH {LONG_SQL}, {_NEW_SQL},
qn AS (SELECT model, sum(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS tp,
              sum(CASE WHEN y_true <> 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS fp,
              sum(CASE WHEN y_true = 1 AND y_pred <> 1 THEN 1 ELSE 0 END) AS fn
       FROM qscores WHERE model = 'len_300' GROUP BY model),
newm AS (SELECT model, 'binary' AS task, 'f1' AS metric, -1 AS class_id,
                round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS value FROM qn)
SELECT * FROM lng WHERE model NOT IN (SELECT model FROM newm) UNION ALL SELECT * FROM newm""")
def metrics_upsert(spark, sf_dir):
    """A metrics store on disk in which one model's rows are replaced by a new evaluation."""
    path = scratch_path(spark, "metrics-store")
    D.write_metrics(metrics_table(spark, sf_dir), path, "parquet")
    from fernwood.operators import metrics as M
    from fernwood.operators.compare import metrics_long as to_long
    s = binary_scores(spark, sf_dir, truth="quality").where(F.col("model") == "len_300")
    c = M.binary_counts(s, ["model"])
    f1 = c.select("model", rounded(F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") == 0, 0.0)
                                   .otherwise(2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))))
                  .alias("f1"))
    D.upsert_stored_metrics(spark, path, to_long(f1, "binary", ["f1"]))
    return D.read_metrics(spark, path, "parquet")


_S_COLS = ["value", "k", "hour"]


@register("stream_standardize", sql=f"""WITH {CONNECTION_SQL},
s AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _S_COLS)
    + " FROM conn WHERE split = 'train') SELECT key, "
    + ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}" for c in _S_COLS)
    + " FROM conn, s WHERE split = 'test'")
def stream_standardize(spark, sf_dir):
    """Streaming: scaler fitted in batch on train, applied to the event files read as a stream."""
    c = connection_log(spark, sf_dir)
    scaler = encode.fit_scaler(c.where(F.col("split") == "train"), _S_COLS)
    schema = table(spark, sf_dir, "events").schema

    def job(ev):
        t = shape_connection(ev).where(F.col("split") == "test").select("key", *_S_COLS)
        z = scaler.transform(t)
        return z.select("key", *[rounded(F.col(x)).alias(x) for x in _S_COLS])

    return transform_stream(spark, sf_dir, schema, "events.parquet", job)


@register("stream_encode", sql=f"""WITH {UNSEEN_SQL},
tv AS (SELECT label AS value, row_number() OVER (ORDER BY label) - 1 AS id
       FROM (SELECT DISTINCT label FROM conn WHERE split = 'train')),
nv AS (SELECT value, (SELECT count(*) FROM tv) + row_number() OVER (ORDER BY value) - 1 AS id
       FROM (SELECT DISTINCT label AS value FROM conn WHERE split = 'test' AND label NOT IN (SELECT value FROM tv))),
v AS (SELECT * FROM tv UNION ALL SELECT * FROM nv)
SELECT key, CAST(id AS INTEGER) AS label_id, round(ln(1 + conn.value), 6) AS value_log1p
FROM conn JOIN v ON conn.label = v.value WHERE split = 'test'""")
def stream_encode(spark, sf_dir):
    """Streaming D2/E3: the event files as a stream, values unseen at fit time appended to the vocabulary."""
    c = unseen_case(connection_log(spark, sf_dir))
    vocab = encode.fit_vocabulary(c.where(F.col("split") == "train"), ["label"])

    def prepare(events):
        return unseen_case(shape_connection(events)).where(F.col("split") == "test").select("key", "label", "value")

    def finish(rows):
        return outlier.log1p_append(rows, ["value"]).select(
            "key", F.col("label").alias("label_id"), rounded(F.col("value_log1p")).alias("value_log1p"))
    out, _ = encode_stream(spark, sf_dir, table(spark, sf_dir, "events").schema, "events.parquet", vocab, ["label"], prepare, finish)
    return out
