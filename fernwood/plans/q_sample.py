"""Split, fold, weight, kNN and SMOTE queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwood.functions import rounded
from fernwood.operators import sample as S
from fernwood.plans.registry import register
from fernwood.plans.standins import CONNECTION_SQL, connection_log
from fernwood.sources.tables import table


def _h(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 8))::BIGINT"


_SPLIT_BASE = f"""WITH {CONNECTION_SQL},
t AS (SELECT key, label FROM conn WHERE split = 'train'),
h AS (SELECT key, label, {_h("CAST(key AS VARCHAR) || '|42'")} AS hv FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY hv, key) AS rk FROM h)"""


@register("stratified_split", sql=_SPLIT_BASE + """,
cnt AS (SELECT label, count(*) AS n FROM t GROUP BY label),
tot AS (SELECT CAST(sum(n) AS DOUBLE) AS n_all, ceil(CAST(0.2 AS DOUBLE) * CAST(sum(n) AS DOUBLE)) AS n_draw FROM cnt),
fl AS (SELECT label, n_draw * CAST(n AS DOUBLE) / n_all AS ex, floor(n_draw * CAST(n AS DOUBLE) / n_all) AS f
       FROM cnt, tot),
lf AS (SELECT (SELECT n_draw FROM tot) - sum(f) AS k FROM fl),
q AS (SELECT label, f + CASE WHEN row_number() OVER (ORDER BY ex - f DESC, label) <= (SELECT k FROM lf)
                       THEN 1 ELSE 0 END AS quota FROM fl)
SELECT r.key, r.label, CASE WHEN rk <= quota THEN 'holdout' ELSE 'train' END AS split
FROM r JOIN q ON r.label = q.label""")
def stratified_split(spark, sf_dir):
    """Stratified 80/20 hold-out of the training split, seed 42, exact class quotas."""
    tr = connection_log(spark, sf_dir).where(F.col("split") == "train").select("key", "label")
    return S.stratified_split(tr, "label", "key", 0.2, 42)


@register("stratified_folds", sql=_SPLIT_BASE + """
SELECT key, label, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM r""")
def stratified_folds(spark, sf_dir):
    """5 stratified folds in hash order, seed 42."""
    tr = connection_log(spark, sf_dir).where(F.col("split") == "train").select("key", "label")
    return S.stratified_folds(tr, "label", "key", 5, 42)


_DIGITS = "CAST(length(CAST(n_chars AS VARCHAR)) AS INTEGER)"


def _digit_classes(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.length(F.col("n_chars").cast("string")).cast("int").alias("y"))


@register("minority_classes", sql=f"""SELECT {_DIGITS} AS class_id, count(*) AS n FROM documents
GROUP BY 1 HAVING count(*) > 0 AND count(*) < 100""")
def minority_classes(spark, sf_dir):
    """Classes with fewer than 100 rows (digit length of ``n_chars`` as class)."""
    return S.minority_classes(_digit_classes(spark, sf_dir), "y", 100)


@register("minority_eligible", sql=f"""SELECT {_DIGITS} AS class_id, count(*) AS n, count(*) >= 3 AS eligible
FROM documents GROUP BY 1 HAVING count(*) > 0 AND count(*) < 100""")
def minority_eligible(spark, sf_dir):
    """Minority classes flagged eligible when they have at least 3 rows."""
    return S.eligible_minority(_digit_classes(spark, sf_dir), "y", 100, 3)


def _embeddings(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")


def _targets(df: DataFrame) -> list[int]:
    counts = S.class_counts(df, "label")
    top = max(counts.values())
    return sorted(c for c, n in counts.items() if n < top)


_TARGETS_SQL = """cnt AS (SELECT label, count(*) AS have FROM embeddings GROUP BY label),
plan AS (SELECT label AS class_id, have, (SELECT max(have) FROM cnt) AS want,
                greatest((SELECT max(have) FROM cnt) - have, 0) AS to_make
         FROM cnt WHERE have < (SELECT max(have) FROM cnt))"""


@register("smote_plan", sql=f"WITH {_TARGETS_SQL} SELECT * FROM plan")
def smote_plan(spark, sf_dir):
    """Rows to synthesise per class under ``auto`` (every non-majority class grows to the majority)."""
    e = _embeddings(spark, sf_dir)
    return S.smote_plan(e, "label", _targets(e), "auto")


_D2 = ("list_sum(list_transform(list_zip(a.embedding, b.embedding), "
       "lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) * (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE))))")
_KNN_SQL = f"""knn AS (SELECT * FROM (
  SELECT a.label, a.vec_id, b.vec_id AS nbr_key, {_D2} AS d2,
         row_number() OVER (PARTITION BY a.label, a.vec_id ORDER BY {_D2}, b.vec_id) AS nbr_rank
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id) WHERE nbr_rank <= 5)"""


@register("knn_within_class", sql=f"""WITH {_KNN_SQL}
SELECT label, vec_id, CAST(nbr_rank AS INTEGER) AS nbr_rank, nbr_key, round(sqrt(d2), 6) AS dist FROM knn""")
def knn_within_class(spark, sf_dir):
    """Exact 5 nearest same-class neighbours of every embedding (projection-pruned band join)."""
    k = S.knn_within_class(_embeddings(spark, sf_dir), "vec_id", "label", "embedding", 5)
    return k.select("label", "vec_id", F.col("nbr_rank").cast("int").alias("nbr_rank"), "nbr_key",
                    rounded(F.col("dist")).alias("dist"))


_SMOTE_SQL = f"""WITH {_TARGETS_SQL}, {_KNN_SQL},
br AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS br,
              list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings
       WHERE label IN (SELECT class_id FROM plan)),
syn AS (SELECT class_id AS cls, have, off, unnest(range(to_make)) AS i FROM (
          SELECT *, coalesce(sum(to_make) OVER (ORDER BY class_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                    AS off FROM plan) WHERE to_make > 0),
draws AS (SELECT cls, off, i,
   {_h("CAST(cls AS VARCHAR) || '|' || CAST(i AS VARCHAR) || '|42|base'")} % have + 1 AS br,
   {_h("CAST(cls AS VARCHAR) || '|' || CAST(i AS VARCHAR) || '|42|nbr'")} % 5 + 1 AS nbr_rank,
   CAST({_h("CAST(cls AS VARCHAR) || '|' || CAST(i AS VARCHAR) || '|42|gap'")} AS DOUBLE) / 4294967296.0 AS u
   FROM syn),
made AS (SELECT d.cls AS label, -(d.off + d.i + 1) AS sample_id, TRUE AS is_synthetic,
   list_transform(list_zip(b.x, n.x), lambda z: z[1] + d.u * (z[2] - z[1])) AS x
   FROM draws d JOIN br b ON b.label = d.cls AND b.br = d.br
   JOIN knn k ON k.label = d.cls AND k.vec_id = b.vec_id AND k.nbr_rank = d.nbr_rank
   JOIN br n ON n.vec_id = k.nbr_key),
allrows AS (SELECT label, vec_id AS sample_id, FALSE AS is_synthetic,
                   list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings
            UNION ALL SELECT * FROM made)
SELECT label, CAST(sample_id AS BIGINT) AS sample_id, is_synthetic,
       CAST(unnest(range(len(x))) AS INTEGER) AS dim, round(unnest(x), 6) AS value FROM allrows"""


@register("smote", sql=_SMOTE_SQL)
def smote(spark, sf_dir):
    """SMOTE (k=5, seed 42) of every non-majority embedding class; long output per dimension."""
    e = _embeddings(spark, sf_dir)
    out = S.smote(e, "vec_id", "label", "embedding", _targets(e), "auto", k=5, seed=42)
    return out.select("label", "sample_id", "is_synthetic",
                      F.posexplode("embedding").alias("dim", "value")) \
        .select("label", "sample_id", "is_synthetic", F.col("dim").cast("int").alias("dim"),
                rounded(F.col("value")).alias("value"))


@register("balanced_weights", sql=f"""WITH {CONNECTION_SQL},
t AS (SELECT label FROM conn WHERE split = 'train')
SELECT label AS class_id, round((SELECT count(*) FROM t) / ((SELECT count(DISTINCT label) FROM t) * count(*)), 6)
       AS weight FROM t GROUP BY label""")
def balanced_weights(spark, sf_dir):
    """Balanced class weights ``N / (K n_c)`` of the training split."""
    tr = connection_log(spark, sf_dir).where(F.col("split") == "train")
    return S.balanced_weights(tr, "label").withColumn("weight", rounded(F.col("weight")))


@register("balanced_weights_fixed_k", sql="""SELECT CAST(c.range AS INTEGER) AS class_id,
  round((SELECT count(*) FROM embeddings) / (12 * greatest(coalesce(n, 0), 1)), 6) AS weight
FROM range(12) c LEFT JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY label) e ON e.label = c.range""")
def balanced_weights_fixed_k(spark, sf_dir):
    """Balanced weights over a fixed 12-class list; empty classes count as one row."""
    w = S.balanced_weights_fixed_k(_embeddings(spark, sf_dir), "label", 12)
    return w.withColumn("weight", rounded(F.col("weight")))


@register("explicit_weights", sql="""SELECT DISTINCT label AS class_id,
  CASE label WHEN 0 THEN 2.0 WHEN 3 THEN 0.5 ELSE 1.0 END::DOUBLE AS weight FROM embeddings""")
def explicit_weights(spark, sf_dir):
    """Explicit weights ``{0: 2.0, 3: 0.5}``, 1.0 for the rest."""
    return S.explicit_weights(_embeddings(spark, sf_dir), "label", {0: 2.0, 3: 0.5})
