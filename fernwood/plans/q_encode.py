"""Encoding, scaling and label queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwood.functions import rounded
from fernwood.operators import audit, encode, outlier
from fernwood.operators import select as sel
from fernwood.plans.registry import register
from fernwood.plans.standins import (CONN_CATEGORICAL, CONNECTION_SQL, EVENT_LABELS_SQL, NORMAL_LABEL, UNSEEN_SQL,
                                     connection_log, event_label_frames, unseen_case)
from fernwood.schema import FIVE_CATEGORIES, compose_label_dim
from fernwood.sources.tables import table

_WEEKDAYS = sorted(["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"])


@register("ordinal_encode_fit", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS value, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS id "
    f"FROM (SELECT DISTINCT {c} FROM documents)" for c in ["source", "lang"]))
def ordinal_encode_fit(spark, sf_dir):
    """Vocabulary of sorted distinct values, id = rank - 1."""
    v = encode.fit_vocabulary(table(spark, sf_dir, "documents"), ["source", "lang"])
    return v.table


@register("ordinal_encode_unseen", sql=f"""WITH {UNSEEN_SQL},
tv AS (SELECT label AS value, row_number() OVER (ORDER BY label) - 1 AS id
       FROM (SELECT DISTINCT label FROM conn WHERE split = 'train')),
nv AS (SELECT value, (SELECT count(*) FROM tv) + row_number() OVER (ORDER BY value) - 1 AS id
       FROM (SELECT DISTINCT label AS value FROM conn WHERE split = 'test'
             AND label NOT IN (SELECT value FROM tv))),
v AS (SELECT * FROM tv UNION ALL SELECT * FROM nv)
SELECT key, CAST(id AS INTEGER) AS label_id FROM conn JOIN v ON conn.label = v.value WHERE split = 'test'""")
def ordinal_encode_unseen(spark, sf_dir):
    """Fit on train, transform test; the unseen value gets the next id (new vocabulary returned)."""
    c = unseen_case(connection_log(spark, sf_dir))
    vocab = encode.fit_vocabulary(c.where(F.col("split") == "train"), ["label"])
    out, _ = encode.ordinal_transform(c.where(F.col("split") == "test").select("key", "label"), vocab, ["label"])
    return out.select("key", F.col("label").alias("label_id"))


_LEVELS = {"l_returnflag": ["A", "N", "R"], "l_linestatus": ["F", "O"]}


@register("one_hot_encode", sql="SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"CAST({c} = '{v}' AS TINYINT) AS {c}_{v}" for c, vs in _LEVELS.items() for v in vs) + " FROM lineitem")
def one_hot_encode(spark, sf_dir):
    """D3: pinned levels, ``{col}_{level}`` tinyint columns in one select, originals dropped."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_LEVELS)
    levels = encode.fit_one_hot(li, list(_LEVELS))
    return encode.one_hot(li, levels)


_Z_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("standardize_fit", sql="WITH s AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _Z_COLS) + " FROM lineitem) SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}" for c in _Z_COLS)
    + " FROM lineitem, s")
def standardize_fit(spark, sf_dir):
    """Fit mean / population std and scale the same frame."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_Z_COLS)
    z = encode.fit_scaler(li, _Z_COLS).transform(li)
    return z.select("l_orderkey", "l_linenumber", *[rounded(F.col(c)).alias(c) for c in _Z_COLS])


_S_COLS = ["value", "k", "hour"]


@register("standardize_transform", sql=f"""WITH {CONNECTION_SQL},
s AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _S_COLS)
    + " FROM conn WHERE split = 'train') SELECT key, "
    + ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}" for c in _S_COLS)
    + " FROM conn, s WHERE split = 'test'")
def standardize_transform(spark, sf_dir):
    """Statistics fitted on train applied to test."""
    c = connection_log(spark, sf_dir)
    scaler = encode.fit_scaler(c.where(F.col("split") == "train"), _S_COLS)
    z = scaler.transform(c.where(F.col("split") == "test").select("key", *_S_COLS))
    return z.select("key", *[rounded(F.col(x)).alias(x) for x in _S_COLS])


@register("label_binary", sql=f"""WITH {CONNECTION_SQL}
SELECT key, CAST(label <> '{NORMAL_LABEL}' AS TINYINT) AS y FROM conn""")
def label_binary(spark, sf_dir):
    """0 for the normal label, 1 otherwise."""
    c = connection_log(spark, sf_dir).select("key", "label")
    return encode.make_labels(c, "binary", normal=NORMAL_LABEL).select("key", "y")


def _event_dim(spark):
    names, cats = event_label_frames(spark)
    return compose_label_dim(names, cats)


@register("label_multiclass", sql=f"""WITH {CONNECTION_SQL}, {EVENT_LABELS_SQL}
SELECT key, CAST(label_id AS INTEGER) AS y FROM conn JOIN event_labels ON conn.label = event_labels.name""")
def label_multiclass(spark, sf_dir):
    """Fine label ids from one shared dictionary (same ids in every split)."""
    c = connection_log(spark, sf_dir).select("key", "label")
    return encode.make_labels(c, "multiclass", label_dim=_event_dim(spark)).select("key", "y")


_CATS_SQL = "cats(category_id, category) AS (VALUES " + ", ".join(
    f"({i}, '{c}')" for i, c in enumerate(FIVE_CATEGORIES)) + ")"


@register("label_category", sql=f"""WITH {CONNECTION_SQL}, {EVENT_LABELS_SQL}, {_CATS_SQL}
SELECT key, CAST(category_id AS INTEGER) AS y FROM conn JOIN event_labels ON conn.label = event_labels.name
JOIN cats ON cats.category = event_labels.category""")
def label_category(spark, sf_dir):
    """5-category ids in the fixed order DoS, Normal, Probe, R2L, U2R."""
    c = connection_log(spark, sf_dir).select("key", "label")
    return encode.make_labels(c, "multiclass_5cat", label_dim=_event_dim(spark)).select("key", "y")


# preprocess pipeline: ordinal service, one-hot flag, every feature scaled with train statistics
_PP_FEATURES = ["value", "k", "hour", "user_id", "service"] + [f"flag_{d}" for d in _WEEKDAYS]


def _pp_sql() -> str:
    enc_cols = ", ".join(["value", "k", "hour", "user_id", "CAST(sv.id AS DOUBLE) AS service"]
                         + [f"CAST(CAST(flag = '{d}' AS TINYINT) AS DOUBLE) AS flag_{d}" for d in _WEEKDAYS])
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _PP_FEATURES)
    scaled = ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}"
                       for c in _PP_FEATURES)
    return f"""WITH {CONNECTION_SQL},
tv AS (SELECT service AS sval, row_number() OVER (ORDER BY service) - 1 AS id
       FROM (SELECT DISTINCT service FROM conn WHERE split = 'train')),
nv AS (SELECT sval, (SELECT count(*) FROM tv) + row_number() OVER (ORDER BY sval) - 1 AS id
       FROM (SELECT DISTINCT service AS sval FROM conn WHERE service NOT IN (SELECT sval FROM tv))),
sv AS (SELECT * FROM tv UNION ALL SELECT * FROM nv),
enc AS (SELECT key, split, CAST(label <> '{NORMAL_LABEL}' AS TINYINT) AS y, {enc_cols}
        FROM conn JOIN sv ON conn.service = sv.sval),
st AS (SELECT {stats} FROM enc WHERE split = 'train')
SELECT key, split, y, {scaled} FROM enc, st"""


@register("preprocess_pipeline", sql=_pp_sql())
def preprocess_pipeline(spark, sf_dir):
    """Fit labels, ordinal ids, one-hot levels and scaling on train; transform both splits."""
    c = connection_log(spark, sf_dir)
    model = encode.preprocess_fit(c.where(F.col("split") == "train"), "binary", ["service"], ["flag"])
    out, _ = model.transform(c, normal=NORMAL_LABEL)
    return out.select("key", "split", "y", *[rounded(F.col(x)).alias(x) for x in model.feature_cols])


@register("drop_columns", sql=f"WITH {CONNECTION_SQL} SELECT key, value, k, hour, user_id, service, flag FROM conn")
def drop_columns(spark, sf_dir):
    """B1: label and split dropped from the frame."""
    return connection_log(spark, sf_dir).drop("label", "split")


_FIT_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("select_fitted_columns", sql=" UNION ALL ".join(
    f"""SELECT l_orderkey, l_linenumber, '{c}' AS feature, {c} AS value FROM lineitem WHERE l_linenumber = 1
        AND (SELECT var_pop({c}) FROM lineitem WHERE l_linenumber <> 1) > 0.01""" for c in _FIT_COLS))
def select_fitted_columns(spark, sf_dir):
    """B2: columns chosen on one part of the rows (variance filter), projected onto the other part."""
    rows = table(spark, sf_dir, "lineitem")
    cols = sel.variance_filter(rows.where(F.col("l_linenumber") != 1), _FIT_COLS)
    keys = ["l_orderkey", "l_linenumber"]
    return rows.where(F.col("l_linenumber") == 1).select(*keys, *cols).unpivot(keys, cols, "feature", "value")


def _dim_sql() -> str:
    num = ["value", "k", "hour", "user_id", "service_id"]
    onehot = [f"flag_{d}" for d in _WEEKDAYS]
    logs = ["value_log1p", "k_log1p"]
    allc = num + onehot + logs
    var_terms = " + ".join(f"CAST(var_pop({c}) > 0.01 AS INTEGER)" for c in allc)
    return f"""WITH {CONNECTION_SQL},
tv AS (SELECT service AS sval, row_number() OVER (ORDER BY service) - 1 AS id
       FROM (SELECT DISTINCT service FROM conn WHERE split = 'train')),
tr AS (SELECT value, k, hour, user_id, CAST(tv.id AS DOUBLE) AS service_id, """ + ", ".join(
        f"CAST(flag = '{d}' AS DOUBLE) AS flag_{d}" for d in _WEEKDAYS) + """,
       ln(1 + value) AS value_log1p, ln(1 + k) AS k_log1p
       FROM conn JOIN tv ON conn.service = tv.sval WHERE split = 'train'),
kept AS (SELECT """ + var_terms + """ AS n FROM tr)
SELECT * FROM (VALUES (0, 'raw', 6), (1, 'one_hot', """ + str(len(num) + len(onehot)) + """),
                      (2, 'log1p', """ + str(len(allc)) + """)) t(step, stage, n_columns)
UNION ALL SELECT 3, 'variance_filter', n FROM kept
UNION ALL SELECT 4, 'top_k', least(n, 10) FROM kept"""


@register("dimension_path", sql=_dim_sql())
def dimension_path(spark, sf_dir):
    """C14: number of features after each preparation stage (schemas of the real stage outputs)."""
    c = connection_log(spark, sf_dir).where(F.col("split") == "train")
    raw = c.select("value", "k", "hour", "user_id", *CONN_CATEGORICAL)
    vocab = encode.fit_vocabulary(raw, ["service"])
    enc, _ = encode.ordinal_transform(raw, vocab, ["service"], extend=False)
    enc = enc.withColumnRenamed("service", "service_id")
    oh = encode.one_hot(enc, encode.fit_one_hot(enc, ["flag"]))
    logged = outlier.log1p_append(oh, ["value", "k"])
    kept = sel.variance_filter(logged)
    ranked = sel.column_variances(logged.select(*kept)).withColumnRenamed("variance", "importance")
    top = [r["feature"] for r in sel.top_k(ranked, 10).collect()]
    return audit.dimension_path([("raw", raw), ("one_hot", oh), ("log1p", logged),
                                 ("variance_filter", logged.select(*kept)), ("top_k", logged.select(*top))])
