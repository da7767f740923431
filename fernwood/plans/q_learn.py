"""Training, tuning and scoring queries.

Model outputs are not SQL-expressible, so these keys have no SQL answer;
their invariants (row counts, probability sums, importances summing to 1,
round-trip equality) are checked in the tests.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwood.functions import rounded
from fernwood.operators import encode, learn, metrics as M, sample as S, select as sel
from fernwood.operators.minibatch import spread
from fernwood.plans.registry import register
from fernwood.plans.standins import NORMAL_LABEL, connection_log, event_label_frames
from fernwood.schema import FIVE_CATEGORIES, compose_label_dim
from fernwood.session import write_scratch
from fernwood.sources.tables import table


def prepared(spark, sf_dir, task: str = "binary"):
    """Preprocessed connection log: ``(train, test, features)`` with target ``y``, written once.

    Training reads its input many times; ``weight`` is the balanced class weight of a row.
    """
    c = connection_log(spark, sf_dir)
    names, cats = event_label_frames(spark)
    dim = compose_label_dim(names, cats)
    model = encode.preprocess_fit(c.where(F.col("split") == "train"), task, ["service"], ["flag"],
                                  label_dim=dim)
    out, _ = model.transform(c, normal=NORMAL_LABEL)
    feats = model.feature_cols
    rows = write_scratch(learn.assemble(out, feats, "y", keep=["key", "split"]), "assembled")
    train = rows.where(F.col("split") == "train").drop("split")
    train = write_scratch(S.with_weights(train, "y", S.balanced_weights(train, "y")), "train")
    return train, rows.where(F.col("split") == "test").drop("split"), feats


def _scores_out(s: DataFrame) -> DataFrame:
    return s.select("model", "row_id", "y_true", "y_pred", rounded(F.col("y_prob")).alias("y_prob"))


@register("dt_binary")
def dt_binary(spark, sf_dir):
    """H1: balanced-weight decision tree (deepest tree), scored on the test split."""
    train, test, _ = prepared(spark, sf_dir)
    return _scores_out(learn.score(learn.decision_tree(weight_col="weight").fit(train), test, "dt_binary"))


@register("dt_multiclass")
def dt_multiclass(spark, sf_dir):
    """H2: decision tree on 5-category targets."""
    train, test, _ = prepared(spark, sf_dir, "multiclass_5cat")
    return _scores_out(learn.score(learn.decision_tree(weight_col="weight").fit(train), test, "dt_multiclass"))


@register("rf_binary")
def rf_binary(spark, sf_dir):
    """H3: 100-tree balanced forest of unlimited depth."""
    train, test, _ = prepared(spark, sf_dir)
    return _scores_out(learn.score(learn.forest(100, weight_col="weight").fit(train), test, "rf_binary"))


@register("rf_multiclass")
def rf_multiclass(spark, sf_dir):
    """H4: 100-tree balanced forest of unlimited depth on 5-category targets."""
    train, test, _ = prepared(spark, sf_dir, "multiclass_5cat")
    return _scores_out(learn.score(learn.forest(100, weight_col="weight").fit(train), test, "rf_multiclass"))


@register("mlp_binary")
def mlp_binary(spark, sf_dir):
    """H7: perceptron with hidden layers (128, 64), 50 epochs of mini-batches."""
    train, test, feats = prepared(spark, sf_dir)
    m = learn.minibatch_perceptron(len(feats), learn.MLP_PARAMS, 2, learn.MLP_EPOCHS).fit(train)
    return _scores_out(learn.score(m, test, "mlp_binary"))


@register("mlp_multiclass")
def mlp_multiclass(spark, sf_dir):
    """H8: perceptron on 5 categories, class weights in the loss."""
    train, test, feats = prepared(spark, sf_dir, "multiclass_5cat")
    m = learn.minibatch_perceptron(len(feats), learn.MLP_PARAMS, len(FIVE_CATEGORIES), learn.MLP_EPOCHS, "weight").fit(train)
    return _scores_out(learn.score(m, test, "mlp_multiclass"))


def _cv_rows(spark, table, best_params):
    return spark.createDataFrame([(learn.params_key(p), float(s), p == best_params) for p, s in table],
                                 "params string, cv_score double, best boolean")


def _folds(rows: DataFrame, k: int) -> DataFrame:
    """The rows with their fold, kept for the many fits that read them."""
    return S.stratified_folds(rows, "y", "key", k, 42).persist(StorageLevel.MEMORY_AND_DISK)


@register("grid_search_dt")
def grid_search_dt(spark, sf_dir):
    """30 balanced trees, 5 stratified folds, F1 of the positive class."""
    train, _, _ = prepared(spark, sf_dir)
    folds = _folds(train, 5)
    try:
        _, params, _, rows = learn.tree_grid_search(learn.decision_tree(weight_col="weight"), folds, learn.DT_PARAM_GRID, True)
    finally:
        folds.unpersist()
    return _cv_rows(spark, rows, params)


@register("grid_search_rf")
def grid_search_rf(spark, sf_dir):
    """H6: the 24 balanced forests of the whole grid, 5 stratified folds, macro F1."""
    train, _, _ = prepared(spark, sf_dir, "multiclass_5cat")
    folds = _folds(train, 5)
    try:
        _, params, _, rows = learn.tree_grid_search(learn.forest(weight_col="weight"), folds, learn.RF_PARAM_GRID)
    finally:
        folds.unpersist()
    return _cv_rows(spark, rows, params)


@register("grid_search_mlp")
def grid_search_mlp(spark, sf_dir):
    """Perceptron shapes x activations, by hold-out F1; the winner is refitted with twice the epochs.

    ``cv_f1`` is the mean over 3 folds, ``val_f1`` the hold-out F1 of the model fitted on all folds,
    ``refit_f1`` the test F1 of the refitted winner (null for the others).
    """
    train, test, feats = prepared(spark, sf_dir)
    parts = S.stratified_split(train, "y", "key", 0.2, 42).persist(StorageLevel.MEMORY_AND_DISK)
    folds = _folds(parts.where(F.col("split") == "train").drop("split"), 3)
    try:
        rows = learn.perceptron_grid_search(folds, parts.where(F.col("split") == "holdout"), len(feats))
        for r in rows:
            shown = {"hidden": "x".join(map(str, r["params"]["hidden_dims"])), "activation": r["params"]["activation"]}
            r["key"] = learn.params_key(shown)
        best = max(rows, key=lambda r: (r["val_f1"], r["key"]))
        winner = learn.minibatch_perceptron(len(feats), best["params"], epochs=2 * learn.MLP_GRID_EPOCHS).fit(
            parts.where(F.col("split") == "train"))
    finally:
        folds.unpersist()
        parts.unpersist()
    refit = float(learn.MacroF1Evaluator(positive_only=True).evaluate(winner.transform(test)))
    return spark.createDataFrame([(r["key"], r["cv_f1"], r["val_f1"], r is best, refit if r is best else None) for r in rows],
                                 "params string, cv_f1 double, val_f1 double, chosen boolean, refit_f1 double")


@register("rf_importance")
def rf_importance(spark, sf_dir):
    """forest importances (100 trees, seed 42), one row per feature, summing to 1."""
    df = _unassembled(spark, sf_dir)
    feats = [c for c in df.columns if c not in ("key", "y", "split")]
    imp, _ = sel.rf_importance(df, feats, "y", trees=100, seed=42)
    return imp.withColumn("importance", rounded(F.col("importance")))


def _unassembled(spark, sf_dir) -> DataFrame:
    c = connection_log(spark, sf_dir)
    model = encode.preprocess_fit(c.where(F.col("split") == "train"), "binary", ["service"], ["flag"])
    out, _ = model.transform(c.where(F.col("split") == "train"), normal=NORMAL_LABEL)
    return write_scratch(out, "features")


@register("feature_selection")
def feature_selection(spark, sf_dir):
    """variance filter -> forest -> top 10; the selected columns in importance order."""
    df = _unassembled(spark, sf_dir)
    feats = [c for c in df.columns if c not in ("key", "y", "split")]
    cols, _ = sel.feature_selection(df, feats, "y", k=10, trees=100)
    return spark.createDataFrame(list(enumerate(cols)), "rank int, feature string")


@register("model_top_k")
def model_top_k(spark, sf_dir):
    """the top 5 features of a fitted forest, named, descending."""
    df = _unassembled(spark, sf_dir)
    feats = [c for c in df.columns if c not in ("key", "y", "split")]
    imp, _ = sel.rf_importance(df, feats, "y", trees=100, seed=42)
    return sel.top_k(imp, 5)


@register("positive_probability")
def positive_probability(spark, sf_dir):
    """One positive-class probability column for any model (tree, perceptron)."""
    train, test, feats = prepared(spark, sf_dir)
    models = {"dt": learn.decision_tree(weight_col="weight").fit(train),
              "mlp": learn.perceptron(len(feats), (128, 64), 2).fit(spread(train, train.count()))}
    s = learn.score_models(models, test)
    return s.select("model", "row_id", rounded(F.col("y_prob")).alias("y_prob"))


@register("score_models")
def score_models(spark, sf_dir):
    """Several models scored once on the same test set, one long table."""
    train, test, _ = prepared(spark, sf_dir)
    models = {"dt": learn.decision_tree(weight_col="weight").fit(train),
              "rf": learn.forest(100, weight_col="weight").fit(train)}
    return _scores_out(learn.score_models(models, test))


@register("evaluate_model")
def evaluate_model(spark, sf_dir):
    """A tree per task on the test split: five binary metrics, four macro metrics."""
    out = []
    for task in ("binary", "multiclass_5cat"):
        train, test, _ = prepared(spark, sf_dir, task)
        out.append(learn.evaluate(learn.decision_tree(weight_col="weight").fit(train), test, "dt", task))
    return reduce(DataFrame.unionByName, out).withColumn("value", rounded(F.col("value")))


@register("compare_smote")
def compare_smote(spark, sf_dir):
    """The same learner with and without SMOTE; accuracy and per-class recall on a hold-out."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    parts = S.stratified_split(e, "label", "vec_id", 0.2, 42).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tr = parts.where(F.col("split") == "train").drop("split")
        ho = parts.where(F.col("split") == "holdout").drop("split")
        counts = S.class_counts(tr, "label")
        targets = sorted(c for c, n in counts.items() if n < max(counts.values()))
        smoted = S.smote(tr, "vec_id", "label", "embedding", targets, "auto", k=3, seed=42)

        def vec(df, key):
            from pyspark.ml.functions import array_to_vector
            return df.select(F.col(key).alias("key"), F.col("label").cast("double").alias("y"),
                             array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("features"))

        test = vec(ho, "vec_id")
        out = []
        for variant, data in [("baseline", vec(tr, "vec_id")), ("smote", vec(smoted, "sample_id"))]:
            m = learn.decision_tree().fit(data)
            s = learn.score(m, test, variant)
            acc = M.accuracy(s, ["model"]).select("model", F.lit(-1).alias("class_id"),
                                                  F.col("accuracy").alias("value"))
            rec = M.per_class(s, list(range(10)), ["model"]).select("model", "class_id",
                                                                     F.col("recall").alias("value"))
            out.append(acc.unionByName(rec))
        res = reduce(DataFrame.unionByName, out).withColumnRenamed("model", "variant")
        res = res.withColumn("value", rounded(F.col("value")))
        # 2 variants x 11 rows: materialised before the cached split is released
        return spark.createDataFrame(res.collect(), res.schema)
    finally:
        parts.unpersist()


@register("importance_compare")
def importance_compare(spark, sf_dir):
    """Tree and forest importances side by side, top 15 of each, full outer join on the feature."""
    df = _unassembled(spark, sf_dir)
    feats = [c for c in df.columns if c not in ("key", "y", "split")]
    data = learn.assemble(df, feats, "y")
    dt = learn.decision_tree().fit(data)
    rf = learn.forest(100).fit(data)
    a = sel.top_k(sel.importances_frame(spark, feats, dt.featureImportances), 15) \
        .select("feature", F.col("importance").alias("dt"))
    b = sel.top_k(sel.importances_frame(spark, feats, rf.featureImportances), 15) \
        .select("feature", F.col("importance").alias("rf"))
    return a.join(b, "feature", "full_outer").select("feature", rounded(F.col("dt")).alias("dt"),
                                                     rounded(F.col("rf")).alias("rf"))
