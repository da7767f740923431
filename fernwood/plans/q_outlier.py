"""Outlier and long-tail queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwood.functions import rounded
from fernwood.operators import outlier
from fernwood.operators.quantiles import quantiles_long
from fernwood.plans.registry import register
from fernwood.plans.standins import CONNECTION_SQL, connection_log
from fernwood.sources.tables import table

# table -> numeric columns used by the outlier queries
OUTLIER_COLUMNS = {
    "lineitem": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    "events": ["value", "user_id"],
    "documents": ["n_chars"],
    "part": ["p_size", "p_retailprice"],
}


def _fence_sql(tbl: str, col: str, select_tail: str) -> str:
    return (f"SELECT '{tbl}' AS table_name, '{col}' AS feature, {select_tail} FROM {tbl}, "
            f"(SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM {tbl}) q")


_OUT = ("CAST(count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS BIGINT)"
        " AS n_outliers, CAST(count(*) AS BIGINT) AS n_rows")


def _report(spark, sf_dir) -> DataFrame:
    parts = []
    for tbl, cols in OUTLIER_COLUMNS.items():
        df = table(spark, sf_dir, tbl)
        rep = outlier.detect_outliers_iqr(df, cols)
        parts.append(rep.select(F.lit(tbl).alias("table_name"), "feature", "n_outliers", "n_rows"))
    return reduce(DataFrame.unionByName, parts)


@register("iqr_outlier_report", sql=" UNION ALL ".join(
    _fence_sql(t, c, _OUT.format(c=c)) for t, cols in OUTLIER_COLUMNS.items() for c in cols))
def iqr_outlier_report(spark, sf_dir):
    """Per column, values strictly outside the 1.5 IQR fences (exact quantiles)."""
    return _report(spark, sf_dir)


@register("iqr_outlier_top_k", sql=(
    "SELECT table_name, feature, n_outliers, round(100.0 * n_outliers / n_rows, 6)::DOUBLE AS pct FROM ("
    + " UNION ALL ".join(_fence_sql(t, c, _OUT.format(c=c)) for t, cols in OUTLIER_COLUMNS.items() for c in cols)
    + ") ORDER BY n_outliers DESC, table_name, feature LIMIT 10"))
def iqr_outlier_top_k(spark, sf_dir):
    """The 10 columns with most outliers and their share in percent."""
    rep = _report(spark, sf_dir)
    return (rep.select("table_name", "feature", "n_outliers",
                       rounded(F.lit(100.0) * F.col("n_outliers") / F.col("n_rows")).alias("pct"))
            .orderBy(F.desc("n_outliers"), "table_name", "feature").limit(10))


_Q_PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


@register("exact_quantiles", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS feature, CAST({p} AS DOUBLE) AS prob, "
    f"round(quantile_cont({c}, {p}), 6) AS quantile FROM {t}"
    for t, cols in OUTLIER_COLUMNS.items() for c in cols for p in _Q_PROBS))
def exact_quantiles(spark, sf_dir):
    """E5: exact linear-interpolated quantiles, all columns of a table in one job."""
    parts = []
    for tbl, cols in OUTLIER_COLUMNS.items():
        q = quantiles_long(table(spark, sf_dir, tbl), cols, _Q_PROBS)
        parts.append(q.select(F.lit(tbl).alias("table_name"), "feature", "prob",
                              rounded(F.col("quantile")).alias("quantile")))
    return reduce(DataFrame.unionByName, parts)


_CLIP_COLS = ["value", "k"]
_CLIP_SQL = f"""WITH {CONNECTION_SQL},
q AS (SELECT quantile_cont(value, 0.25) AS vq1, quantile_cont(value, 0.75) AS vq3,
             quantile_cont(k, 0.25) AS kq1, quantile_cont(k, 0.75) AS kq3 FROM conn)
SELECT key,
       round(least(greatest(value, vq1 - 1.5 * (vq3 - vq1)), vq3 + 1.5 * (vq3 - vq1)), 6) AS value,
       round(least(greatest(CAST(k AS DOUBLE), kq1 - 1.5 * (kq3 - kq1)), kq3 + 1.5 * (kq3 - kq1)), 6) AS k
FROM conn, q"""


@register("iqr_clip", sql=_CLIP_SQL)
def iqr_clip(spark, sf_dir):
    """Clip to the fences; every row kept, no new nulls."""
    df = connection_log(spark, sf_dir)
    b = outlier.fit_bounds(df, _CLIP_COLS)
    out = outlier.clip(df, b)
    return out.select("key", *[rounded(F.col(c)).alias(c) for c in _CLIP_COLS])


@register("log1p_append", sql=(
    "SELECT doc_id, n_chars, round(ln(1 + n_chars), 6) AS n_chars_log1p FROM documents"))
def log1p_append(spark, sf_dir):
    """``{col}_log1p`` appended, original kept."""
    df = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    out = outlier.log1p_append(df, ["n_chars"])
    return out.withColumn("n_chars_log1p", rounded(F.col("n_chars_log1p")))


_PIPE_SQL = f"""WITH {CONNECTION_SQL},
tr AS (SELECT * FROM conn WHERE split = 'train'),
q AS (SELECT quantile_cont(value, 0.25) AS vq1, quantile_cont(value, 0.75) AS vq3,
             quantile_cont(k, 0.25) AS kq1, quantile_cont(k, 0.75) AS kq3 FROM tr),
f AS (SELECT vq1 - 1.5 * (vq3 - vq1) AS vlo, vq3 + 1.5 * (vq3 - vq1) AS vhi,
             kq1 - 1.5 * (kq3 - kq1) AS klo, kq3 + 1.5 * (kq3 - kq1) AS khi FROM q),
c AS (SELECT key, split, least(greatest(value, vlo), vhi) AS value,
             least(greatest(CAST(k AS DOUBLE), klo), khi) AS k FROM conn, f)
SELECT key, split, round(value, 6) AS value, round(k, 6) AS k,
       round(ln(1 + value), 6) AS value_log1p
FROM c"""


@register("outlier_pipeline", sql=_PIPE_SQL)
def outlier_pipeline_q(spark, sf_dir):
    """Fences fitted on the training split, applied to both splits; clip, then log1p of the clipped value."""
    df = connection_log(spark, sf_dir).select("key", "split", "value", "k")
    bounds = outlier.fit_bounds(df.where(F.col("split") == "train"), _CLIP_COLS)
    out, _, _ = outlier.outlier_pipeline(df, _CLIP_COLS, ["value"], bounds=bounds)
    return out.select("key", "split", rounded(F.col("value")).alias("value"),
                      rounded(F.col("k")).alias("k"),
                      rounded(F.col("value_log1p")).alias("value_log1p"))
