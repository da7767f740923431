"""Audit and exploration queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwood.functions import rounded
from fernwood.operators import audit, outlier
from fernwood.plans.registry import register
from fernwood.plans.standins import (CONNECTION_SQL, EVENT_LABELS_SQL, UNSEEN_SQL, connection_log,
                                     event_label_frames, unseen_case)
from fernwood.schema import compose_label_dim
from fernwood.sources.tables import table

_NULL_TABLES = {
    "events": (["event_id", "ts", "user_id", "event_type", "props"], ["value"]),
    "documents": (["doc_id", "text", "lang", "source", "n_chars"], []),
    "lineitem": (["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"],
                 ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
}


def _null_sql():
    parts = []
    for t, (plain, floats) in _NULL_TABLES.items():
        for c in plain:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS feature, "
                         f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null FROM {t}")
        for c in floats:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS feature, "
                         f"CAST(count(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS BIGINT) AS n_null FROM {t}")
    return " UNION ALL ".join(parts)


@register("null_audit", sql=_null_sql())
def null_audit(spark, sf_dir):
    """Missing cells per column (NaN counts on float columns), one pass per table."""
    parts = []
    for t, (plain, floats) in _NULL_TABLES.items():
        df = table(spark, sf_dir, t)
        parts.append(audit.null_counts(df, plain + floats).select(
            F.lit(t).alias("table_name"), "feature", "n_null"))
    return reduce(DataFrame.unionByName, parts)


@register("split_shapes", sql=f"""WITH {CONNECTION_SQL}
SELECT split, count(*) AS n_rows, 8 AS n_cols FROM conn GROUP BY split""")
def split_shapes(spark, sf_dir):
    """Rows and columns per official split."""
    return audit.shape(connection_log(spark, sf_dir), "split")


_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _describe_sql(tbl, cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6)::DOUBLE AS min, "
        f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
        f"round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6)::DOUBLE AS max FROM {tbl}"
        for c in cols)


def _round_desc(d: DataFrame) -> DataFrame:
    return d.select("feature", "count", *[rounded(F.col(c)).alias(c) for c in
                                         ["mean", "std", "min", "q25", "q50", "q75", "max"]])


@register("describe_columns", sql=_describe_sql("lineitem", _DESC_COLS))
def describe_columns(spark, sf_dir):
    """Count, mean, std, min, quartiles, max of every numeric column."""
    return _round_desc(audit.describe(table(spark, sf_dir, "lineitem"), _DESC_COLS))


@register("label_distribution", sql=f"""WITH {CONNECTION_SQL}
SELECT split, label, n, round(n / sum(n) OVER (PARTITION BY split), 6) AS share
FROM (SELECT split, label, count(*) AS n FROM conn GROUP BY split, label)""")
def label_distribution(spark, sf_dir):
    """Class counts and shares per split."""
    d = audit.label_distribution(connection_log(spark, sf_dir))
    return d.withColumn("share", rounded(F.col("share")))


@register("category_distribution", sql=f"""WITH {CONNECTION_SQL}, {EVENT_LABELS_SQL}
SELECT category,
       count(*) FILTER (WHERE split = 'train') AS n_train,
       count(*) FILTER (WHERE split = 'test') AS n_test
FROM conn JOIN event_labels ON conn.label = event_labels.name
GROUP BY category""")
def category_distribution(spark, sf_dir):
    """Category counts, train and test side by side."""
    names, cats = event_label_frames(spark)
    dim = compose_label_dim(names, cats)
    return audit.category_distribution(connection_log(spark, sf_dir), dim)


@register("label_top_k", sql="""SELECT p_brand AS value, count(*) AS n FROM part
GROUP BY p_brand ORDER BY n DESC, value LIMIT 15""")
def label_top_k(spark, sf_dir):
    """The 15 most frequent values of a label-like column (ties by name)."""
    return audit.top_k_frequency(table(spark, sf_dir, "part"), "p_brand", 15)


@register("unseen_labels", sql=f"""WITH {UNSEEN_SQL}
SELECT DISTINCT label FROM conn WHERE split = 'test'
  AND label NOT IN (SELECT label FROM conn WHERE split = 'train')""")
def unseen_labels(spark, sf_dir):
    """Labels in the test split and never seen in training."""
    c = unseen_case(connection_log(spark, sf_dir))
    return audit.unseen_labels(c.where(F.col("split") == "train"), c.where(F.col("split") == "test"))


def _hist_sql(tbl, cols, bins=10):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS feature, g.bin,
  round(m.lo + (m.hi - m.lo) * g.bin / {bins}, 6) AS lo,
  round(m.lo + (m.hi - m.lo) * (g.bin + 1) / {bins}, 6) AS hi,
  CAST(count(t.{c}) AS BIGINT) AS n
FROM (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM {tbl}) m
CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) g
LEFT JOIN {tbl} t ON LEAST(CAST(floor((t.{c}::DOUBLE - m.lo) /
    (CASE WHEN m.hi > m.lo THEN m.hi - m.lo ELSE 1.0 END) * {bins}) AS INTEGER), {bins - 1}) = g.bin
GROUP BY g.bin, m.lo, m.hi""")
    return " UNION ALL ".join(parts)


@register("numeric_histogram", sql=_hist_sql("lineitem", _DESC_COLS))
def numeric_histogram(spark, sf_dir):
    """10 equal-width bins per numeric column, empty bins present."""
    h = audit.histogram(table(spark, sf_dir, "lineitem"), _DESC_COLS, 10)
    return h.select("feature", "bin", rounded(F.col("lo")).alias("lo"),
                    rounded(F.col("hi")).alias("hi"), "n")


_CAT_COLS = ["p_brand", "p_type", "p_size"]


@register("categorical_top_k", sql=" UNION ALL ".join(f"""SELECT * FROM (
  SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n,
         CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS INTEGER) AS rank
  FROM part GROUP BY {c}) WHERE rank <= 10""" for c in _CAT_COLS))
def categorical_top_k(spark, sf_dir):
    """Top 10 values of several categorical columns."""
    return audit.categorical_top_k(table(spark, sf_dir, "part"), _CAT_COLS, 10)


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
_CORR_PAIRS = [(a, b) for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]]
_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS r FROM lineitem"
    for a, b in _CORR_PAIRS)


@register("correlation_matrix", sql=_CORR_SQL)
def correlation_matrix(spark, sf_dir):
    """Pearson correlation of every column pair, one aggregate pass."""
    c = audit.correlation_matrix(table(spark, sf_dir, "lineitem"), _CORR_COLS)
    return c.withColumn("r", rounded(F.col("r")))


@register("correlated_pairs", sql=f"SELECT * FROM ({_CORR_SQL}) WHERE abs(r) >= 0.003")
def correlated_pairs(spark, sf_dir):
    """C11: pairs whose absolute correlation reaches the threshold (0.003 here)."""
    c = audit.correlation_matrix(table(spark, sf_dir, "lineitem"), _CORR_COLS)
    return audit.correlated_pairs(c, 0.003).withColumn("r", rounded(F.col("r")))


_BA_SQL = f"""WITH {CONNECTION_SQL},
q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM conn),
t AS (SELECT least(greatest(value, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) AS value FROM conn, q),
t2 AS (SELECT value, ln(1 + value) AS value_log1p FROM t)
SELECT 'before' AS stage, 'value' AS feature, count(value) AS count, round(avg(value), 6) AS mean,
  round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
  round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
  round(quantile_cont(value, 0.75), 6) AS q75, round(max(value), 6) AS max FROM conn
UNION ALL
SELECT 'after', 'value', count(value), round(avg(value), 6), round(stddev_samp(value), 6),
  round(min(value), 6), round(quantile_cont(value, 0.25), 6), round(quantile_cont(value, 0.5), 6),
  round(quantile_cont(value, 0.75), 6), round(max(value), 6) FROM t2
UNION ALL
SELECT 'after', 'value_log1p', count(value_log1p), round(avg(value_log1p), 6),
  round(stddev_samp(value_log1p), 6), round(min(value_log1p), 6),
  round(quantile_cont(value_log1p, 0.25), 6), round(quantile_cont(value_log1p, 0.5), 6),
  round(quantile_cont(value_log1p, 0.75), 6), round(max(value_log1p), 6) FROM t2"""


@register("transform_before_after", sql=_BA_SQL)
def transform_before_after(spark, sf_dir):
    """Distribution of a long-tail column before and after clip + log1p."""
    raw = connection_log(spark, sf_dir).select("value")
    after, _, _ = outlier.outlier_pipeline(raw, ["value"], ["value"])
    ba = audit.before_after(raw, after, ["value"])
    return ba.select("stage", *_round_desc(ba.drop("stage")).columns[:0], "feature", "count",
                     *[rounded(F.col(c)).alias(c) for c in
                       ["mean", "std", "min", "q25", "q50", "q75", "max"]])


@register("cumulative_share", sql="""SELECT user_id, n, round(n / sum(n) OVER (), 6) AS share,
  round(sum(n) OVER (ORDER BY n DESC, user_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        / sum(n) OVER (), 6) AS cumulative_share
FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)""")
def cumulative_share(spark, sf_dir):
    """Share and running share of a ranked count (running sum without one big task)."""
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    cs = audit.cumulative_share(counts, "user_id", "n")
    return cs.select("user_id", "n", rounded(F.col("share")).alias("share"),
                     rounded(F.col("cumulative_share")).alias("cumulative_share"))
