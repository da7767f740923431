"""Plans and paths that must hold at any size: quantile brackets, neighbours, grids, correlations,
null labels, the committed metrics store and the streaming vocabulary."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from fernwood.operators import (audit, encode, gram, learn, metrics as M, minibatch, neighbours, outlier, quantiles, ranking, sample,
                                select as sel, tree_path)
from fernwood.plans import q_learn
from fernwood.schema import columns_except, columns_with_prefix
from fernwood.sources import datasets
from fernwood.streaming.fitted_stream import encode_stream

NAN = float("nan")


@pytest.fixture(scope="module")
def prepared(spark):
    return q_learn.prepared(spark, SF_SMALL)


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# ------------------------------------------------------------------ quantiles and quotas

def linear(values, p):
    v = sorted(values)
    h = (len(v) - 1) * p
    return v[math.floor(h)] + (v[math.ceil(h)] - v[math.floor(h)]) * (h - math.floor(h))


def test_ungrouped_quantiles_neither_join_nor_unpivot(spark, monkeypatch, no_broadcast):
    seen = []
    real = quantiles.running_total
    monkeypatch.setattr(quantiles, "write_scratch", lambda df, name: seen.append(plan_of(df)) or ranking.write_scratch(df, name))
    df = spark.range(20000).select((F.col("id") % 977).cast("double").alias("a"), F.rand(3).alias("b"))
    quantiles.quantile_table(df, ["a", "b"], [0.25, 0.5])
    assert real is quantiles.running_total and len(seen) == 1
    assert "Join" not in seen[0] and "unpivot" not in seen[0].lower() and "Expand" not in seen[0]
    assert re.findall(r"Exchange hashpartitioning\((.*?)#", seen[0])[:1] == ["c"]


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    # edges that ask the sketch for the wrong places
    monkeypatch.setattr(quantiles, "_edges", lambda probs: [x for _ in probs for x in (0.9, 0.95)])
    rows = [(g, float(v)) for g in ("a", "b") for v in range(400)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert quantiles.quantile_table(df, ["v"], [0.1, 0.5]) == {"v": [linear([v for _, v in rows], p) for p in (0.1, 0.5)]}
    got = {(r["g"], r["prob"]): r["quantile"] for r in quantiles.quantiles_long(df, ["v"], [0.1, 0.5], group_cols=["g"]).collect()}
    assert got == {(g, p): pytest.approx(linear(range(400), p)) for g in "ab" for p in (0.1, 0.5)}


def test_a_thousand_groups_without_a_collect(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(None if g == 7 else g, rng.choice([rng.random(), 0.5, NAN]), float(rng.randint(0, 9))) for g in range(1000) for _ in range(rng.randint(1, 6))]
    rows += [(3, rng.random(), 1.0) for _ in range(4000)]  # a hot group
    df = spark.createDataFrame(rows, "g int, v double, w double")
    out = quantiles.quantiles_long(df, ["v", "w"], [0.0, 0.3, 1.0], group_cols=["g"])
    values = {}
    for g, v, w in rows:
        values.setdefault((g, "w"), []).append(w)
        if not math.isnan(v):
            values.setdefault((g, "v"), []).append(v)
    got = {(r["g"], r["feature"], r["prob"]): r["quantile"] for r in out.collect()}
    assert got == {(g, f, p): pytest.approx(linear(v, p)) for (g, f), v in values.items() for p in (0.0, 0.3, 1.0)}
    source = open(quantiles.__file__).read()
    assert ".collect()" not in source[source.index("def _grouped("):source.index("def _empty(")]


def test_quotas_move_no_row_by_its_class(spark, no_broadcast):
    df = spark.range(500).select(F.col("id").alias("key"), (F.col("id") % 3).alias("y"))
    plan = plan_of(sample.stratified_split(df, "y", "key", 0.2))
    last = plan[plan.index("== Physical Plan =="):].splitlines()
    assert any("BroadcastHashJoin" in line for line in last)
    # what goes by the class alone are the totals of a class and bucket, not rows
    by_class = [i for i, line in enumerate(last) if re.search(r"hashpartitioning\(y#\d+L?, \d+\)", line)]
    assert all("HashAggregate" in last[i + 1] for i in by_class)


# ------------------------------------------------------------------ neighbours

def brute_neighbours(rows, k):
    out = {}
    for key, c, x in rows:
        near = sorted((sum((a - b) ** 2 for a, b in zip(x, y)), other) for other, d, y in rows if d == c and other != key)
        out[key] = [other for _, other in near[:k]]
    return out


@pytest.mark.parametrize("rows_per_block", [7, 512])
def test_neighbours_equal_brute_force(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(neighbours, "ROWS", rows_per_block)
    rng = random.Random(2)
    rows = [(i, rng.randint(0, 1), [rng.gauss(0, 1), rng.gauss(0, 1), float(rng.randint(0, 2))]) for i in range(160)]
    rows += [(1000 + i, 1, [1.0, 2.0, 3.0]) for i in range(40)]  # one vector many times
    rows += [(2000 + i, 5, [float(i), 0.0, 0.0]) for i in range(3)] + [(3000, 6, [0.0, 0.0, 0.0])]  # k rows and one row
    df = spark.createDataFrame(rows, "id long, c int, x array<double>")
    got = {r["id"]: [] for r in df.collect()}
    for r in neighbours.knn_within_class(df, "id", "c", "x", 4).orderBy("id", "nbr_rank").collect():
        got[r["id"]].append(r["nbr_key"])
    assert got == brute_neighbours(rows, 4)
    assert len(got[2000]) == 2 and got[3000] == []


def test_far_blocks_are_not_compared(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS", 20)
    calls = spark.sparkContext.accumulator(0)
    real = neighbours.nearest

    rows = [(i, 0, [float(i % 10 * 1000) + i / 100.0, float(i % 7)]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, c int, x array<double>")

    def counted(*args):
        calls.add(1)
        return real(*args)
    monkeypatch.setattr(neighbours, "nearest", counted)
    got = neighbours.knn_within_class(df, "id", "c", "x", 3).count()
    assert got == 1200
    blocks = 400 // 20
    assert calls.value < 2 * blocks * blocks // 2  # own blocks and near ones, not every pair


@pytest.mark.parametrize("tile, tiles", [(1, 1), (3, 1), (32, 2)])
def test_neighbours_in_tiles_equal_brute_force(spark, monkeypatch, tile, tiles):
    monkeypatch.setattr(neighbours, "ROWS", 16)
    monkeypatch.setattr(neighbours, "TILE", tile)
    monkeypatch.setattr(neighbours, "TILES", tiles)
    written = {}
    monkeypatch.setattr(neighbours, "write_scratch", lambda df, name, real=neighbours.write_scratch: written.setdefault(name, real(df, name)))
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(300, 5)), 1).astype(np.float32)  # some equal distances
    cls = rng.integers(0, 2, 300)
    df = spark.createDataFrame([(i, int(c), v.tolist()) for i, (c, v) in enumerate(zip(cls, x))], "id long, c int, x array<float>")
    got = {}
    for r in neighbours.knn_within_class(df, "id", "c", "x", 4).orderBy("id", "nbr_rank").collect():
        got.setdefault(r["id"], []).append((r["nbr_key"], pytest.approx(r["dist"], abs=1e-9)))
    x = x.astype(float)
    for i in range(300):
        near = sorted((((x[i] - x[j]) ** 2).sum(), j) for j in range(300) if j != i and cls[i] == cls[j])[:4]
        assert got[i] == [(j, d ** 0.5) for d, j in near]
    # vectors travel once per tile, not once per pair of blocks
    pairs = written["knn-pairs"]
    assert pairs.select("cls", "down", "across").distinct().count() <= (pairs.count() if tile == 1 else pairs.count() / 3)
    assert written["knn-blocks"].first()["x"].__len__() == 4 * 5 * len(written["knn-blocks"].first()["keys"])


def test_neighbours_of_string_keys_and_no_rows(spark):
    rows = [(f"k{i:02d}", "c", [float(i % 4)]) for i in range(30)]
    df = spark.createDataFrame(rows, "id string, c string, x array<float>")
    got = {}
    for r in neighbours.knn_within_class(df, "id", "c", "x", 3).orderBy("id", "nbr_rank").collect():
        got.setdefault(r["id"], []).append(r["nbr_key"])
    assert got == brute_neighbours(rows, 3)
    assert neighbours.knn_within_class(df.limit(0), "id", "c", "x", 3).count() == 0


# ------------------------------------------------------------------ grids

def test_cut_trees_equal_trees_of_that_depth(spark, prepared):
    """Every depth of the grid against a fit of its own, on the same folds."""
    folds = sample.stratified_folds(prepared[0], "y", "key", 2)
    spec = {"max_depth": [2, 5, None], "min_samples_split": [2, 10], "criterion": ["gini", "entropy"]}
    tree = learn.decision_tree()  # whole counts: with fractional weights equal sums may round either way
    _, params, best, table = learn.tree_grid_search(tree, folds, spec, positive_only=True)
    grid = learn.dt_grid(tree, spec)
    _, plain_params, plain_best, scores = learn.grid_search(tree, grid, folds, learn.MacroF1Evaluator(positive_only=True))
    plain = {learn.params_key({k.name: v for k, v in g.items()}): s for g, s in zip(grid, scores)}
    assert {learn.params_key(p): pytest.approx(s) for p, s in table} == plain
    assert best == pytest.approx(plain_best) and len(table) == 12


def test_forest_path_is_the_forest_itself_at_full_size(spark, prepared):
    train, test, _ = prepared
    model = learn.forest(6, max_depth=8, weight_col="weight").fit(train)
    nodes = tree_path.nodes_of(model, spark)
    x = np.array([r["x"] for r in test.select(M_vector("features")).collect()])
    found = tree_path.predictions(nodes, x, [2, 6], [1, 8, 30])
    want = [int(r["prediction"]) for r in model.transform(test).collect()]
    assert found[:, 4].tolist() == want and found[:, 5].tolist() == want
    # two trees cut at depth 1, by hand
    probs = np.zeros((len(x), nodes.shares.shape[1]))
    for root in nodes.roots[:2]:
        to = np.where(x[:, nodes.feature[root]] <= nodes.threshold[root], nodes.left[root], nodes.right[root])
        probs += nodes.shares[to]
    assert found[:, 0].tolist() == probs.argmax(axis=1).tolist()


def M_vector(name):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(name).alias("x")


@pytest.mark.parametrize("activation, masked", [("relu", False), ("tanh", False), ("relu", True), ("tanh", True)])
def test_gradient_equals_differences(activation, masked):
    rng = np.random.default_rng(1)
    sizes = [4, 5, 3, 3]
    flat = minibatch.MinibatchPerceptron(sizes, activation).start() + 0.05
    x, y, w = rng.normal(size=(12, 4)), rng.integers(0, 3, 12), rng.random(12) + 0.2
    masks = {5: np.where(np.arange(60).reshape(12, 5) % 3 > 0, 1.5, 0.0), 3: np.where(np.arange(36).reshape(12, 3) % 4 > 0, 1.25, 0.0)}
    drop = (lambda h: masks[h.shape[1]]) if masked else None
    g, _ = minibatch.gradient(flat, sizes, activation, x, y, w, drop)
    for i in range(0, len(flat), 3):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        slope = (minibatch.gradient(up, sizes, activation, x, y, w, drop)[1] - minibatch.gradient(down, sizes, activation, x, y, w, drop)[1]) / 2e-6
        assert g[i] == pytest.approx(slope, abs=1e-6)


def test_minibatch_perceptron_learns_and_weighs_rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    df = spark.createDataFrame([(i, [float(a), float(b)], float(c)) for i, ((a, b), c) in enumerate(zip(x, y))],
                               "key long, features array<double>, y double").repartition(4, "key").persist()
    fit = minibatch.MinibatchPerceptron([2, 16, 2], "tanh", rate=1e-2, batch=64, epochs=15)
    model = fit.fit(df)
    assert model.losses[-1] < 0.5 * model.losses[0]
    scored = model.transform(df)
    assert scored.where("prediction = y").count() > 0.93 * 3000
    assert all(sum(r["probability"]) == pytest.approx(1.0) for r in scored.limit(20).collect())
    assert (fit.fit(df).flat == model.flat).all()  # the same rows in the same partitions give the same fit
    # a class of weight 0 is never learned
    one = minibatch.MinibatchPerceptron([2, 8, 2], epochs=5, batch=64, rate=1e-2, weight_col="w").fit(df.withColumn("w", 1 - F.col("y")))
    assert one.transform(df).where("prediction = 0").count() > 0.95 * 3000
    stopped = minibatch.MinibatchPerceptron([2, 4, 2], epochs=40, batch=64, rate=0.0, patience=2).fit(df)
    assert len(stopped.losses) < 6
    assert minibatch.MinibatchPerceptron([2, 4, 2], epochs=3).fit(df.limit(0)).losses == []
    with pytest.raises(ValueError, match="activation"):
        minibatch.MinibatchPerceptron([2, 2], "step").fit(df)


def test_several_models_on_one_scan(spark, prepared):
    train, test, feats = prepared
    models = {"dt": learn.decision_tree(max_depth=4).fit(train), "rf": learn.forest(3, max_depth=3).fit(train),
              "mlp": minibatch.MinibatchPerceptron([len(feats), 4, 2], epochs=1).fit(train)}
    together = learn.score_models(models, test)
    assert plan_of(together).split("== Physical Plan ==")[1].count("FileScan") == 1
    rows = {(r["model"], r["row_id"]): (r["y_true"], r["y_pred"], r["y_prob"], r["probability"]) for r in together.collect()}
    for name, model in models.items():
        for r in learn.score(model, test, name).collect():
            assert rows.pop((name, r["row_id"])) == (r["y_true"], r["y_pred"], r["y_prob"], r["probability"])
    assert not rows


def test_smote_comparison(spark):
    rows = q_learn.compare_smote(spark, SF_SMALL).collect()
    assert len(rows) == 22 and {r["variant"] for r in rows} == {"baseline", "smote"}
    assert {r["class_id"] for r in rows} == {-1, *range(10)} and all(0 <= r["value"] <= 1 for r in rows)


# ------------------------------------------------------------------ correlations and missing values

def test_correlations_leave_missing_cells_out_by_pair(spark, monkeypatch):
    monkeypatch.setattr(gram, "BAND", 3)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 8)) + [0, 1e6, 0, -5, 0, 0, 0, 0]
    x[:, 3] += x[:, 0]
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 6] = 2.5
    x[1:, 7] = np.nan
    cells = [[None if math.isnan(v) and i % 2 else float(v) for v in row] for i, row in enumerate(x)]
    df = spark.createDataFrame(cells, ", ".join(f"c{i} double" for i in range(8))).repartition(40)
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in audit.correlation_matrix(df, df.columns).collect()}
    assert len(got) == 28
    for i, j in itertools.combinations(range(8), 2):
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        if 6 in (i, j) or 7 in (i, j):
            assert got[f"c{i}", f"c{j}"] is None
        else:
            assert got[f"c{i}", f"c{j}"] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    assert audit.correlation_matrix(df, ["c1"]).count() == 0


def test_nan_is_missing_in_scaling_variance_and_histogram(spark):
    df = spark.createDataFrame([(float(i), 0.0, None) for i in range(1, 10)] + [(NAN, NAN, None)], "v double, flat double, none double")
    model = encode.fit_scaler(df, ["v", "flat", "none"])
    assert model.stats["v"] == (5.0, pytest.approx(math.sqrt(60 / 9))) and model.stats["none"] == (0.0, 1.0)
    out = [r["v"] for r in model.transform(df).collect()]
    assert sum(out[:9]) == pytest.approx(0) and math.isnan(out[9])
    assert sel.variance_filter(df, ["v", "flat", "none"]) == ["v"]
    bins = [(r["lo"], r["n"]) for r in audit.histogram(df, ["v"], 4).orderBy("bin").collect()]
    assert [n for _, n in bins] == [2, 2, 2, 3] and bins[0][0] == 1.0


def test_shares_are_of_their_own_split(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), (None, "x")], "split string, label string")
    got = {(r["split"], r["label"]): r["share"] for r in audit.label_distribution(df).collect()}
    assert got == {("a", "x"): pytest.approx(2 / 3), ("a", "y"): pytest.approx(1 / 3), (None, "x"): 1.0}


def test_columns_by_exclusion_and_prefix(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "key int, flag_a int, flag_b int, flags int")
    assert columns_except(df, ["key", "gone"]) == ["flag_a", "flag_b", "flags"]
    assert columns_with_prefix(df, ["flag_"]) == ["flag_a", "flag_b"] and columns_with_prefix(df, []) == []


# ------------------------------------------------------------------ metrics

def test_null_labels_are_misses_everywhere(spark):
    rows = [("m", 0, 0), ("m", 0, None), ("m", None, 1), ("m", 1, 1), ("m", None, None)]
    s = spark.createDataFrame(rows, "model string, y_true int, y_pred int")
    assert M.accuracy(s, ["model"]).first()["accuracy"] == pytest.approx(2 / 5)
    marginals = {r["class_id"]: (r["tp"], r["n_true"], r["n_pred"]) for r in M.class_marginals(s).collect()}
    assert marginals == {0: (1, 2, 1), 1: (1, 1, 2)}
    macro = M.macro_prf(s).first()
    assert (macro["precision_macro"], macro["recall_macro"]) == (pytest.approx(0.75), pytest.approx(0.75))
    both = M.multiclass_metrics(s, ["model"], unseen_ids=[0]).first()
    assert both["accuracy"] == pytest.approx(0.4) and both["known_class_accuracy"] == pytest.approx(1 / 3)
    cells = {(r["y_true"], r["y_pred"]): r["n"] for r in M.confusion_matrix(s, ["model"]).collect()}
    assert len(cells) == 9 and cells[None, None] == cells[0, None] == cells[None, 1] == 1 and cells[1, 0] == 0


def test_rows_without_a_score_have_no_rank(spark):
    rows = [(0, 0, 0.1), (1, 1, 0.9), (0, 1, NAN), (1, 0, None), (None, 1, 0.95), (0, 0, 0.2)]
    s = spark.createDataFrame(rows, "y_true int, y_pred int, y_prob double")
    assert M.roc_auc(s).first()["auc"] == 1.0
    m = M.binary_metrics(s).first()
    assert m["auc"] == 1.0 and m["accuracy"] == pytest.approx(3 / 6) and m["precision"] == pytest.approx(1 / 3)
    points = [(r["fpr"], r["tpr"]) for r in M.roc_curve(s).orderBy("idx").collect()]
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0) and (0.0, 1.0) in points


@pytest.mark.parametrize("buckets", [1, 5, 50])
def test_following_rows_and_totals_across_buckets(spark, buckets):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), i, rng.randint(0, 5)) for i in range(200)] + [("one", 1, 7)]
    df = spark.createDataFrame(rows, "g string, o int, v long")
    out = ranking.running_total(df, [("o", False)], {"cum": "v"}, ["g"], buckets, following={"nxt": "v"}, group_totals={"all": "v"})
    got = {(r["g"], r["o"]): (r["cum"], r["nxt"], r["all"]) for r in out.collect()}
    for g in ("a", "b", None, "one"):
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: -r[1])
        for i, (_, o, _) in enumerate(mine):
            assert got[g, o] == (sum(r[2] for r in mine[:i + 1]), mine[i + 1][2] if i + 1 < len(mine) else None, sum(r[2] for r in mine))


def test_roc_reads_the_scores_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "scores")
    spark.range(500).select((F.col("id") % 2).cast("int").alias("y_true"), (F.col("id") % 40 / 40.0).alias("y_prob")).write.parquet(path)
    plans = []
    monkeypatch.setattr(ranking, "write_scratch", lambda df, name, real=ranking.write_scratch: plans.append(plan_of(df)) or real(df, name))
    curve = M.roc_curve(spark.read.parquet(path))
    physical = [p.split("== Physical Plan ==")[1] for p in [*plans, plan_of(curve)]]
    assert sum(p.count(f"{path}") for p in physical) == 1


# ------------------------------------------------------------------ store and stream

def test_a_failed_writer_leaves_the_store_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    long = spark.createDataFrame([("a", "binary", "f1", -1, 0.1), ("b", "binary", "f1", -1, 0.2)], datasets.METRICS_SCHEMA)
    datasets.write_metrics(long, path, "parquet")
    before = sorted(map(tuple, datasets.read_metrics(spark, path, "parquet").collect()))
    broken = long.where("model = 'a'").withColumn("value", F.when(F.col("value") > 0, F.raise_error(F.lit("lost"))).cast("double"))
    with pytest.raises(Exception, match="lost"):
        datasets.upsert_stored_metrics(spark, path, broken)
    assert sorted(map(tuple, datasets.read_metrics(spark, path, "parquet").collect())) == before
    # written whole, but never committed
    monkeypatch.setattr(datasets, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        datasets.upsert_stored_metrics(spark, path, long.withColumn("value", F.lit(0.9)))
    assert sorted(map(tuple, datasets.read_metrics(spark, path, "parquet").collect())) == before


def test_versions_are_merged_and_a_slower_writer_fails(spark, tmp_path):
    path = str(tmp_path / "store")
    for i, model in enumerate("abcd"):
        new = spark.createDataFrame([(model, "binary", "f1", -1, float(i))], datasets.METRICS_SCHEMA)
        datasets.upsert_stored_metrics(spark, path, new, most_versions=2)
    assert {(r["model"], r["value"]) for r in datasets.read_metrics(spark, path, "parquet").collect()} == {
        ("a", 0.0), ("b", 1.0), ("c", 2.0), ("d", 3.0)}
    number, content = datasets._last_commit(spark, path)
    assert len(set(content["models"].values())) <= 2
    with pytest.raises(Exception):
        datasets._commit(spark, path, number, {"models": {}})
    assert datasets._last_commit(spark, path) == (number, content)
    with pytest.raises(ValueError, match="no metrics store"):
        datasets.read_metrics(spark, str(tmp_path / "none"))


def test_stream_batches_extend_the_vocabulary_in_turn(spark, tmp_path):
    files = [[("k1", "b", 1.0), ("k2", "z", 2.0), ("k3", "m", NAN)], [("k4", "y", 100.0), ("k5", "m", 3.0), ("k6", "c", None)]]
    schema = "key string, s string, v double"
    import os
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in{i}"))
        part = next((tmp_path / f"in{i}").glob("part-*.parquet"))
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"f{i}.parquet").write_bytes(part.read_bytes())
        os.utime(tmp_path / "in" / f"f{i}.parquet", (1000 + i, 1000 + i))
    fitted = encode.fit_vocabulary(spark.createDataFrame([("b",), ("c",)], "s string"), ["s"])
    bounds = outlier.Bounds({"v": (1.0, 2.0, 0.0, 10.0)}, ["v"])
    out, vocab = encode_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, "f*.parquet", fitted, ["s"],
                               finish=lambda df: outlier.log1p_append(outlier.clip(df, bounds), ["v"]), max_files=1)
    want, known = [], fitted
    for rows in files:
        part, known = encode.ordinal_transform(spark.createDataFrame(rows, schema), known, ["s"])
        want += outlier.log1p_append(outlier.clip(part, bounds), ["v"]).collect()
    assert sorted(map(repr, map(tuple, out.select(*want[0].__fields__).collect()))) == sorted(repr(tuple(r)) for r in want)
    ids = {r["value"]: r["id"] for r in vocab.table.collect()}
    assert ids == {"b": 0, "c": 1, "m": 2, "z": 3, "y": 4} == {r["value"]: r["id"] for r in known.table.collect()}
