"""Hand-computed metric fixtures, sampling invariants and the bucketed ranking path."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fernwood.operators import metrics as M, sample as S
from fernwood.operators.ranking import global_rank, running_total


def _scores(spark, yt, yp, prob=None):
    if prob is None:
        return spark.createDataFrame(list(zip(yt, yp)), "y_true int, y_pred int")
    return spark.createDataFrame(list(zip(yt, yp, prob)), "y_true int, y_pred int, y_prob double")


def test_binary_perfect(spark):
    m = M.binary_metrics(_scores(spark, [0, 0, 1, 1], [0, 0, 1, 1], [0.1, 0.2, 0.9, 0.8])).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"], m["auc"]) == (1.0, 1.0, 1.0, 1.0, 1.0)


def test_binary_all_wrong(spark):
    m = M.binary_metrics(_scores(spark, [0, 0, 1, 1], [1, 1, 0, 0], [0.9, 0.8, 0.1, 0.2])).first()
    assert m["accuracy"] == 0.0 and m["f1"] == 0.0 and m["auc"] == 0.0


def test_auc_ties_and_single_class(spark):
    s = _scores(spark, [0, 1, 0, 1], [0, 1, 0, 1], [0.5, 0.5, 0.2, 0.9])
    assert M.roc_auc(s).first()["auc"] == pytest.approx(0.875)
    one = _scores(spark, [1, 1], [1, 1], [0.2, 0.3])
    assert M.roc_auc(one).first()["auc"] is None


def test_multiclass_mixed(spark):
    s = _scores(spark, [0, 0, 1, 1, 2], [0, 1, 1, 1, 2])
    m = M.multiclass_metrics(s, unseen_ids=[2]).first()
    assert m["accuracy"] == pytest.approx(0.8) and m["known_class_accuracy"] == pytest.approx(0.75)
    full = M.known_class_accuracy(s, []).first()[0]
    assert full == pytest.approx(0.8)
    none_left = M.known_class_accuracy(s, [0, 1, 2], empty_value=0.0).first()[0]
    assert none_left == 0.0


def test_f1_by_category(spark):
    dim = spark.createDataFrame([(0, "DoS"), (1, "DoS"), (2, "Probe"), (3, "Probe")], "label_id int, category string")
    f = {r["category"]: r["f1"] for r in M.f1_by_category(_scores(spark, [0, 1, 2, 3], [0, 1, 2, 3]), dim).collect()}
    assert f == {"DoS": 1.0, "Probe": 1.0}
    dim2 = spark.createDataFrame([(0, "Normal"), (1, "Attack")], "label_id int, category string")
    f2 = {r["category"]: r["f1"] for r in M.f1_by_category(_scores(spark, [0, 0, 1, 1], [0, 1, 0, 1]), dim2).collect()}
    assert f2["Normal"] == pytest.approx(0.5) and f2["Attack"] == pytest.approx(0.5)


def test_confusion_dense(spark):
    cm = M.confusion_matrix(_scores(spark, [0, 1, 2], [0, 0, 2])).collect()
    assert len(cm) == 9 and sum(r["n"] for r in cm) == 3


def test_roc_curve_endpoints(spark):
    s = _scores(spark, [0, 1, 0, 1, 1], [0, 1, 0, 1, 1], [0.1, 0.4, 0.35, 0.8, 0.8])
    pts = M.roc_curve(s).orderBy("idx").collect()
    assert (pts[0]["fpr"], pts[0]["tpr"]) == (0.0, 0.0)
    assert (pts[-1]["fpr"], pts[-1]["tpr"]) == (1.0, 1.0)


def test_minority_and_smote_sizes(spark):
    counts = [0] * 800 + [1] * 100 + [2] * 30 + [3] * 70
    rows = [(i, [float((i * 7 + d) % 13) for d in range(4)], y) for i, y in enumerate(counts)]
    df = spark.createDataFrame(rows, "key long, features array<float>, y int")
    minority = sorted(r["class_id"] for r in S.minority_classes(df, "y", 200).collect())
    assert minority == [1, 2, 3]
    out = S.smote(df, "key", "y", "features", minority, "auto", k=3, seed=42)
    sizes = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert sizes == {0: 800, 1: 800, 2: 800, 3: 800}


def test_smote_too_few_rows(spark):
    rows = [(i, [float(i)], 0) for i in range(45)] + [(100 + i, [float(i)], 1) for i in range(5)]
    df = spark.createDataFrame(rows, "key long, features array<float>, y int")
    with pytest.raises(ValueError):
        S.smote(df, "key", "y", "features", [1], "auto", k=5)


def test_knn_exact_against_brute_force(spark):
    import random
    rnd = random.Random(7)
    rows = [(i, [rnd.random() for _ in range(3)], i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "key long, x array<double>, c int")
    got = {(r["key"], r["nbr_rank"]): r["nbr_key"] for r in S.knn_within_class(df, "key", "c", "x", 4).collect()}
    for i, xi, ci in rows:
        d = sorted((sum((a - b) ** 2 for a, b in zip(xi, xj)), j) for j, xj, cj in rows if cj == ci and j != i)
        for rank, (_, j) in enumerate(d[:4], start=1):
            assert got[(i, rank)] == j


def test_stratified_split_quotas(spark):
    rows = [(i, "a" if i % 10 < 7 else "b") for i in range(1000)]
    df = spark.createDataFrame(rows, "key long, label string")
    out = S.stratified_split(df, "label", "key", 0.2, 42)
    hold = {r["label"]: r["count"] for r in out.where("split = 'holdout'").groupBy("label").count().collect()}
    assert hold == {"a": 140, "b": 60}


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    w = {r["class_id"]: r["weight"] for r in S.balanced_weights(df, "y").collect()}
    assert w[0] == pytest.approx(8 / 12) and w[1] == pytest.approx(2.0)
    wf = {r["class_id"]: r["weight"] for r in S.balanced_weights_fixed_k(df, "y", 3).collect()}
    assert wf[2] == pytest.approx(8 / 3)


@pytest.mark.parametrize("buckets", [1, 4, 1000])
def test_running_total_equals_a_plain_window(spark, buckets):
    nan = float("nan")
    rows = ([(i, float((i * 37) % 101), f"https://example.org/a/long/common/prefix/{i % 7}", i % 3 or None)
             for i in range(600)]
            + [(1000 + i, 5.0, "same", 0) for i in range(300)]
            + [(2000 + i, nan if i % 2 else None, None, 1) for i in range(60)])
    df = spark.createDataFrame(rows, "key long, v double, s string, g int")
    df = df.withColumn("one", F.lit(1).cast("long"))
    orders = [("v", True), ("v", False), ("s", True), ("s", False)]
    for column, up in orders if buckets < 100 else orders[1:2]:
        got = running_total(df, [(column, up), ("key", True)], {"cum": "one"}, ["g"], n_buckets=buckets)
        by = F.col(column).asc() if up else F.col(column).desc()
        w = Window.partitionBy("g").orderBy(by, "key").rowsBetween(Window.unboundedPreceding, 0)
        want = df.withColumn("want", F.sum("one").over(w)).select("key", "want")
        joined = got.join(want, "key")
        assert joined.count() == len(rows)
        assert joined.where(F.col("cum") != F.col("want")).count() == 0
    ranks = global_rank(df, [("v", False), ("key", True)], out="rk", n_buckets=buckets)
    assert sorted(x["rk"] for x in ranks.collect()) == list(range(1, len(rows) + 1))


def test_partition_invariance(spark):
    rows = [(i, float((i * 13) % 17), i % 4) for i in range(500)]
    df = spark.createDataFrame(rows, "key long, v double, y int")
    a = sorted(tuple(r) for r in S.stratified_folds(df.repartition(1), "y", "key", 5).collect())
    b = sorted(tuple(r) for r in S.stratified_folds(df.repartition(7), "y", "key", 5).collect())
    assert a == b
