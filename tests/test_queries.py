"""Registered queries: SQL answers agree at sf0.001; model queries keep their invariants."""

import pytest

from oracle_check import digest, duck

from conftest import SF_SMALL

_FAST_ORACLE = [
    "iqr_outlier_report", "exact_quantiles", "describe_columns", "null_audit", "label_distribution",
    "categorical_top_k", "correlation_matrix", "cumulative_share", "numeric_histogram",
    "ordinal_encode_unseen", "preprocess_pipeline", "one_hot_encode", "stratified_split",
    "binary_metrics", "roc_curve", "macro_prf", "f1_by_category", "rare_class_accuracy",
    "knn_within_class", "smote", "model_comparison", "metric_compare", "metrics_upsert",
    "scan_headerless_csv", "stream_standardize", "dimension_path",
]


@pytest.fixture(scope="module")
def registry():
    from __spark_entry__ import oracle_sql, queries
    return queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", _FAST_ORACLE)
def test_oracle_agrees(spark, registry, con, name):
    qs, sq = registry
    df = qs[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sq[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, rows)[0] == digest(rel.columns, drows)[0]


def test_every_sql_key_is_a_query(registry):
    qs, sq = registry
    assert set(sq) <= set(qs)
    assert len(qs) >= 90


def test_entry_runs(spark):
    from __spark_entry__ import entry
    rows = entry(spark).collect()
    assert {r["metric"] for r in rows} == {"accuracy", "precision", "recall", "f1", "auc"}


def test_model_queries_invariants(spark, registry):
    qs, _ = registry
    imp = qs["rf_importance"](spark, SF_SMALL).collect()
    assert abs(sum(r["importance"] for r in imp) - 1.0) < 1e-3
    rt = qs["model_roundtrip"](spark, SF_SMALL).collect()
    assert rt and all(r["same"] for r in rt)
    s = qs["dt_binary"](spark, SF_SMALL).collect()
    assert all(0.0 <= r["y_prob"] <= 1.0 for r in s)


def test_softmax_rows_sum_to_one(spark, registry):
    from pyspark.sql import functions as F
    qs, _ = registry
    sums = qs["softmax_rows"](spark, SF_SMALL).groupBy("vec_id").agg(F.sum("prob").alias("s")).collect()
    assert all(abs(r["s"] - 1.0) < 1e-4 for r in sums)
