"""Distributed training, tuning and scoring through Spark ML.

Differences from the single-machine learners, stated once:

* ``maxDepth`` is at most 30 and stands for "unlimited";
  ``min_samples_split`` has no twin, ``minInstancesPerNode`` is used and named so;
* trees are binned (``maxBins``), forests are seeded but not
  partition-invariant, so results are checked by invariants;
* Spark ML's perceptron is sigmoid hidden layers + softmax output trained by L-BFGS
  and has no ``weightCol``: class weights become resampling.  The grid trains relu and tanh
  perceptrons in mini-batches (:mod:`fernwood.operators.minibatch`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (DecisionTreeClassifier, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwood.operators.deep_trees import DeepForestClassifier, DeepTreeClassifier
from fernwood.operators.minibatch import MinibatchPerceptron
from fernwood.operators.tree_path import deep_path, in_parallel, nodes_of, rows_to_score, score_path

MAX_DEPTH = 30
SEED = 42

# Tuning grids
DT_PARAM_GRID = {"max_depth": [5, 10, 15, 20, None], "min_samples_split": [2, 5, 10],
                 "criterion": ["gini", "entropy"]}
RF_PARAM_GRID = {"n_estimators": [100, 200, 300], "max_depth": [10, 15, 20, None],
                 "min_samples_split": [2, 5]}
MLP_PARAM_GRID = {"hidden_dims": [(64,), (128, 64), (256, 128, 64)], "activation": ["relu", "tanh"],
                  "dropout": [0.3], "lr": [1e-3]}
MLP_GRID_EPOCHS = 20
MLP_PARAMS = {"hidden_dims": (128, 64), "activation": "relu", "dropout": 0.3, "lr": 1e-3}
MLP_EPOCHS = 50


def assemble(df: DataFrame, features: Sequence[str], label: str = "y",
             keep: Sequence[str] = (), out: str = "features") -> DataFrame:
    """Feature columns -> one vector column (the MLlib border); label as double."""
    va = VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error")
    cols = [*keep, out, F.col(label).cast("double").alias(label)]
    extra = [c for c in ("weight", "fold") if c in df.columns and c not in keep]
    return va.transform(df).select(*cols, *extra)


def _depth(d):
    return MAX_DEPTH if d is None else min(int(d), MAX_DEPTH)


def decision_tree(max_depth=None, min_instances_per_node=1, impurity="gini", label="y",
                  weight_col: str | None = None, seed=SEED, max_bins=64) -> DecisionTreeClassifier:
    """H1/H2: a tree; ``max_depth=None`` means the deepest tree MLlib grows (30)."""
    dt = DeepTreeClassifier(labelCol=label, featuresCol="features", maxDepth=_depth(max_depth),
                            minInstancesPerNode=min_instances_per_node, impurity=impurity,
                            seed=seed, maxBins=max_bins)
    if weight_col:
        dt.setWeightCol(weight_col)
    return dt


def forest(trees=100, max_depth=None, min_instances_per_node=1, label="y",
           weight_col: str | None = None, seed=SEED, max_bins=64) -> RandomForestClassifier:
    """H3/H4: a seeded forest.

    Deep trees have many open nodes: with room for their statistics a level takes few passes,
    and cached node ids spare walking every tree from its root for each row.
    """
    rf = DeepForestClassifier(labelCol=label, featuresCol="features", numTrees=trees,
                              maxDepth=_depth(max_depth), minInstancesPerNode=min_instances_per_node,
                              seed=seed, maxBins=max_bins, maxMemoryInMB=1024, cacheNodeIds=True)
    if weight_col:
        rf.setWeightCol(weight_col)
    return rf


def perceptron(n_inputs: int, hidden: Sequence[int], n_classes: int, label="y", max_iter=100,
               seed=SEED, solver="l-bfgs", step=0.03, block_size=128) -> MultilayerPerceptronClassifier:
    """H7/H8: ``layers = [inputs, *hidden, classes]``."""
    return MultilayerPerceptronClassifier(
        labelCol=label, featuresCol="features", layers=[n_inputs, *hidden, n_classes],
        maxIter=max_iter, seed=seed, solver=solver, stepSize=step, blockSize=block_size)


def score(model: Model, df: DataFrame, name: str, key: str = "key", label: str = "y") -> DataFrame:
    """``(model, row_id, y_true, y_pred, y_prob, probability)``.

    ``y_prob`` is the positive-class probability when the model gives one,
    else the hard prediction.
    """
    out = model.transform(df)
    has_prob = "probability" in out.columns
    prob = vector_to_array("probability") if has_prob else F.array(F.col("prediction"))
    pos = F.when(F.size(prob) >= 2, F.element_at(prob, 2)).otherwise(F.col("prediction"))
    return out.select(
        F.lit(name).alias("model"),
        F.col(key).alias("row_id"),
        F.col(label).cast("int").alias("y_true"),
        F.col("prediction").cast("int").alias("y_pred"),
        pos.cast("double").alias("y_prob"),
        prob.alias("probability"),
    )


def score_models(models: dict[str, Model], df: DataFrame, key: str = "key", label: str = "y") -> DataFrame:
    """Every model scored on one scan of the test set, as one long table.

    The models are chained on the frame, each with output columns of its own; a row is then
    turned into one row per model.
    """
    out, cells = df, []
    for i, (name, model) in enumerate(models.items()):
        out = model.transform(out)
        prob = vector_to_array("probability") if "probability" in out.columns else F.array(F.col("prediction"))
        out = out.withColumns({f"_prob{i}": prob, f"_pred{i}": F.col("prediction")}).drop(
            "rawPrediction", "probability", "prediction")
        p, hard = F.col(f"_prob{i}"), F.col(f"_pred{i}")
        pos = F.when(F.size(p) >= 2, F.element_at(p, 2)).otherwise(hard)
        cells.append(F.struct(F.lit(name).alias("model"), hard.cast("int").alias("y_pred"), pos.cast("double").alias("y_prob"),
                              p.alias("probability")))
    rows = out.select(F.col(key).alias("row_id"), F.col(label).cast("int").alias("y_true"), F.explode(F.array(*cells)).alias("s"))
    return rows.select("s.model", "row_id", "y_true", "s.y_pred", "s.y_prob", "s.probability")


class MacroF1Evaluator(Evaluator):
    """Macro F1 over the union of true and predicted labels, as a distributed aggregate."""

    def __init__(self, label: str = "y", prediction: str = "prediction", positive_only: bool = False):
        super().__init__()
        self.label = label
        self.prediction = prediction
        self.positive_only = positive_only

    def _evaluate(self, dataset: DataFrame) -> float:
        from fernwood.operators.metrics import binary_counts, macro_prf
        pairs = dataset.select(F.col(self.label).cast("int").alias("y_true"),
                               F.col(self.prediction).cast("int").alias("y_pred"))
        if self.positive_only:
            c = binary_counts(pairs).first()
            den = 2 * c["tp"] + c["fp"] + c["fn"]
            return 0.0 if den == 0 else 2.0 * c["tp"] / den
        return float(macro_prf(pairs).first()["f1_macro"])

    def isLargerBetter(self) -> bool:
        return True


def grid_search(estimator: Estimator, grid: list, train: DataFrame, evaluator: Evaluator,
                parallelism: int = 4):
    """H5/H6: cross-validation over a ``fold`` column (from :func:`stratified_folds`), refit on all.

    Returns ``(best model, best params as dict, best mean score, all scores)``.
    """
    n_folds = int(train.agg(F.max("fold")).first()[0]) + 1
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator,
                        foldCol="fold", numFolds=n_folds, parallelism=parallelism, seed=SEED)
    cvm = cv.fit(train)
    scores = list(cvm.avgMetrics)
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    params = {p.name: v for p, v in grid[best].items()}
    return cvm.bestModel, params, scores[best], scores


def evaluate(model: Model, df: DataFrame, name: str, task: str = "binary", key: str = "key",
             label: str = "y") -> DataFrame:
    """Long metrics ``(model, task, metric, class_id, value)`` of a model on a test set.

    Binary: accuracy, precision, recall, f1 and auc; otherwise accuracy and the macro
    averages over the union of true and predicted classes.
    """
    from fernwood.operators import metrics as M
    from fernwood.operators.compare import metrics_long

    s = score(model, df, name, key, label)
    if task == "binary":
        return metrics_long(M.binary_metrics(s, ["model"]), task, ["accuracy", "precision", "recall", "f1", "auc"])
    macro = M.accuracy_and_macro(s, ["model"])
    return metrics_long(macro, task, ["accuracy", "precision_macro", "recall_macro", "f1_macro"])


def f1_scores(pairs: DataFrame, positive_only: bool = False) -> dict[int, float]:
    """F1 per ``model`` of ``(model, y_true, y_pred)``: of class 1, or the macro average."""
    from fernwood.operators.metrics import binary_counts, macro_prf
    if not positive_only:
        return {r["model"]: r["f1_macro"] for r in macro_prf(pairs, ["model"]).collect()}
    found = {}
    for c in binary_counts(pairs, ["model"]).collect():
        den = 2 * c["tp"] + c["fp"] + c["fn"]
        found[c["model"]] = 0.0 if den == 0 else 2.0 * c["tp"] / den
    return found


def tree_grid_search(estimator, train: DataFrame, spec: dict, positive_only: bool = False, parallelism: int = 4):
    """H5/H6: a grid over depths (and forest sizes) from the deepest (and widest) fits.

    One fit per fold and remaining combination (split size, criterion), run from a bounded pool;
    all depths and sizes are scored by one walk (see :mod:`fernwood.operators.tree_path`).  Deep trees
    of a fold are grown from the same written rows and score the same written rows.
    Returns ``(best model refitted on all rows, best params, best mean score, [(params, score)])``.
    """
    from itertools import product

    spark = train.sparkSession
    depths = [_depth(d) for d in spec["max_depth"]]
    sizes = list(spec.get("n_estimators", [1]))
    rest = [dict(zip(("minInstancesPerNode", "impurity"), v)) for v in product(
        spec["min_samples_split"], spec.get("criterion", [estimator.getImpurity()]))]
    widest = {"maxDepth": max(depths)} | ({"numTrees": max(sizes)} if "n_estimators" in spec else {})
    n_folds = int(train.agg(F.max("fold")).first()[0]) + 1

    def with_params(params: dict):
        return estimator.copy({estimator.getParam(k): v for k, v in params.items()})
    deep = isinstance(estimator, (DeepTreeClassifier, DeepForestClassifier)) and not with_params(widest).is_plain()

    def parted(fold: int) -> Callable:
        def run():
            rows, test = train.where(F.col("fold") != fold), train.where(F.col("fold") == fold)
            return (with_params(widest).binned(rows), rows_to_score(test)) if deep else (rows, test)
        return run

    def one(params: dict, fold: int) -> Callable:
        def run():
            rows, test = parts[fold]
            if deep:
                return f1_scores(deep_path(test, with_params(params | widest).grown(rows), sizes, depths), positive_only)
            return f1_scores(score_path(test, nodes_of(with_params(params | widest).fit(rows), spark), sizes, depths), positive_only)
        return run
    parts = in_parallel(spark, [parted(f) for f in range(n_folds)], parallelism)
    jobs = [one(p, f) for p in rest for f in range(n_folds)]
    found = in_parallel(spark, jobs, parallelism)
    table = []
    for i, p in enumerate(rest):
        folds = found[i * n_folds:(i + 1) * n_folds]
        for at, (size, depth) in enumerate(product(sizes, depths)):
            params = {"maxDepth": depth, **p} | ({"numTrees": size} if "n_estimators" in spec else {})
            if "criterion" not in spec:
                params.pop("impurity")
            table.append((params, sum(f.get(at, 0.0) for f in folds) / n_folds))
    best = max(range(len(table)), key=lambda i: (table[i][1], -i))
    return with_params(table[best][0]).fit(train), *table[best], table


def perceptron_grid_search(train: DataFrame, holdout: DataFrame, n_inputs: int, n_classes: int = 2, spec: dict | None = None,
                           epochs: int | None = None, positive_only: bool = True, parallelism: int = 4) -> list[dict]:
    """H9: every combination on every fold and on all of ``train``, from one bounded pool of fits.

    Gives for each combination its params, ``cv_f1`` (mean over the folds of column ``fold``) and
    ``val_f1`` (on ``holdout``, of the model fitted on all folds).
    """
    from itertools import product

    spec, epochs = spec or MLP_PARAM_GRID, epochs or MLP_GRID_EPOCHS
    combos = [dict(zip(spec, v)) for v in product(*spec.values())]
    f1 = MacroF1Evaluator(positive_only=positive_only)
    n_folds = int(train.agg(F.max("fold")).first()[0]) + 1

    def one(params: dict, fold: int | None) -> Callable:
        def run():
            rows = train if fold is None else train.where(F.col("fold") != fold)
            test = holdout if fold is None else train.where(F.col("fold") == fold)
            return f1.evaluate(minibatch_perceptron(n_inputs, params, n_classes, epochs).fit(rows).transform(test))
        return run
    # the largest first, so that no long fit is left over at the end
    jobs = sorted(((i, f) for i in range(len(combos)) for f in [None, *range(n_folds)]),
                  key=lambda x: -sum(combos[x[0]]["hidden_dims"]))
    found = dict(zip(jobs, in_parallel(train.sparkSession, [one(combos[i], f) for i, f in jobs], parallelism)))
    return [{"params": c, "cv_f1": sum(found[i, f] for f in range(n_folds)) / n_folds, "val_f1": found[i, None]}
            for i, c in enumerate(combos)]


def minibatch_perceptron(n_inputs: int, params: dict, n_classes: int = 2, epochs: int = MLP_GRID_EPOCHS,
                         weight_col: str | None = None) -> MinibatchPerceptron:
    """A perceptron of a combination of ``MLP_PARAM_GRID``."""
    return MinibatchPerceptron([n_inputs, *params["hidden_dims"], n_classes], activation=params["activation"],
                               dropout=params["dropout"], rate=params["lr"], epochs=epochs, seed=SEED, weight_col=weight_col)


def dt_grid(dt: DecisionTreeClassifier, spec: dict = DT_PARAM_GRID) -> list:
    return (ParamGridBuilder()
            .addGrid(dt.maxDepth, [_depth(d) for d in spec["max_depth"]])
            .addGrid(dt.minInstancesPerNode, list(spec["min_samples_split"]))
            .addGrid(dt.impurity, list(spec["criterion"]))
            .build())


def rf_grid(rf: RandomForestClassifier, spec: dict = RF_PARAM_GRID) -> list:
    return (ParamGridBuilder()
            .addGrid(rf.numTrees, list(spec["n_estimators"]))
            .addGrid(rf.maxDepth, [_depth(d) for d in spec["max_depth"]])
            .addGrid(rf.minInstancesPerNode, list(spec["min_samples_split"]))
            .build())


def params_key(params: dict) -> str:
    """A readable, stable key for a parameter combination."""
    return "_".join(f"{k}={params[k]}" for k in sorted(params))
