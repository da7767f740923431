"""Classification metrics as distributed aggregates.

Input is a scores table with ``y_true``, ``y_pred`` and, for ranking
metrics, ``y_prob``; ``group`` columns (usually ``model``) score many models
in one pass.  The heavy step is always one aggregate to a small table (pair
counts: classes^2 rows per model; distinct scores for AUC/ROC); everything
after that works on the small table.  Divisions follow the 0/0 -> 0 rule; an
AUC with one class present is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fernwood.functions import safe_div
from fernwood.operators.ranking import running_total
from fernwood.session import write_scratch


def pair_counts(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``(group..., y_true, y_pred, n)``: the sparse confusion counts; null labels are a bucket."""
    return scores.groupBy(*group, "y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))


def stored_counts(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """:func:`pair_counts` as a written table: the scores are read once, whatever is derived from it."""
    return write_scratch(pair_counts(scores, group), "pairs")


def _hit() -> F.Column:
    """Truth and prediction agree; a null label agrees with nothing."""
    return F.coalesce(F.col("y_true") == F.col("y_pred"), F.lit(False))


def confusion_matrix(scores: DataFrame, group: Sequence[str] = (),
                     labels: Sequence[int] | None = None) -> DataFrame:
    """Dense confusion matrix, zero cells present, labels sorted.

    Labels are the given list or the union of true and predicted labels per
    group, null being one where it occurs.  The grid is built by exploding the (small) label
    array twice.
    """
    pc = stored_counts(scores, group)
    if labels is not None:
        lab = pc.select(*group).distinct().withColumn("_labels", F.array(*[F.struct(F.lit(int(x)).alias("l")) for x in labels]))
    else:
        # in structs, as collect_set leaves nulls out
        lab = pc.groupBy(*group).agg(F.array_sort(F.array_union(
            F.collect_set(F.struct(F.col("y_true").alias("l"))), F.collect_set(F.struct(F.col("y_pred").alias("l"))))).alias("_labels"))
    grid = lab.select(*group, F.explode("_labels").alias("_t"), "_labels") \
        .select(*group, F.col("_t.l").alias("y_true"), F.explode("_labels").alias("_p")) \
        .select(*group, "y_true", F.col("_p.l").alias("y_pred"))
    same = F.lit(True)
    for c in (*group, "y_true", "y_pred"):
        same = same & F.col(c).eqNullSafe(F.col(f"_c_{c}"))
    return grid.join(pc.withColumnsRenamed({c: f"_c_{c}" for c in (*group, "y_true", "y_pred")}), same, "left").select(
        *group, "y_true", "y_pred", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def binary_counts(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``tp, fp, fn, tn, n`` per group (positive class = 1; a null label is not positive)."""
    return scores.groupBy(*group).agg(*_binary_sums(), F.count(F.lit(1)).alias("n"))


def _binary_sums() -> list[F.Column]:
    t, p = F.col("y_true").eqNullSafe(F.lit(1)), F.col("y_pred").eqNullSafe(F.lit(1))
    return [F.sum(c.cast("long")).alias(name) for name, c in (("tp", t & p), ("fp", ~t & p), ("fn", t & ~p), ("tn", ~t & ~p))]


def score_counts(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``(group..., y_prob, pos, neg)`` per distinct score.  Rows without a truth or a score (null
    or NaN) have no place in a ranking and are left out."""
    ranked = F.col("y_true").isNotNull() & F.col("y_prob").isNotNull() & ~F.isnan("y_prob")
    return scores.where(ranked).groupBy(*group, "y_prob").agg(
        F.sum((F.col("y_true") == 1).cast("long")).alias("pos"),
        F.sum((F.col("y_true") != 1).cast("long")).alias("neg"))


def roc_auc(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Tie-aware ROC AUC per group: ``sum pos*(neg_below + neg_tied/2) / (P*N)``.

    Scores are grouped first (one row per distinct score), and the running
    count of negatives uses :func:`running_total`, never a one-task window.
    """
    return _auc(score_counts(scores, group), group)


def _auc(by_score: DataFrame, group: Sequence[str]) -> DataFrame:
    cum = running_total(by_score, [("y_prob", True)], {"neg_cum": "neg"}, group)
    part = cum.select(*group, (F.col("pos").cast("double") *
                               ((F.col("neg_cum") - F.col("neg")).cast("double") +
                                F.col("neg").cast("double") / F.lit(2.0))).alias("s"),
                      "pos", "neg")
    agg = part.groupBy(*group).agg(F.sum("s").alias("s"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return agg.select(*group, F.when((F.col("P") == 0) | (F.col("N") == 0), F.lit(None).cast("double"))
                      .otherwise(F.col("s") / (F.col("P").cast("double") * F.col("N").cast("double")))
                      .alias("auc"))


def binary_metrics(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, f1 (0/0 -> 0) and AUC per group.

    Counts per distinct score are written once; every metric follows from that table.
    """
    stored = write_scratch(scores.groupBy(*group, "y_prob").agg(
        *_binary_sums(), F.count(F.lit(1)).alias("n"), F.count_if(F.col("y_true") == 1).alias("pos"),
        F.count_if(F.col("y_true") != 1).alias("neg")), "binary")
    c = stored.groupBy(*group).agg(*[F.sum(x).alias(x) for x in ("tp", "fp", "fn", "tn", "n")])
    m = c.select(
        *group,
        safe_div(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
        safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_div(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )
    ranked = stored.where(F.col("y_prob").isNotNull() & ~F.isnan("y_prob") & (F.col("pos") + F.col("neg") > 0))
    auc = _auc(ranked.select(*group, "y_prob", "pos", "neg"), group)
    if not group:
        return m.withColumn("_g", F.lit(0)).join(auc.withColumn("_g", F.lit(0)), "_g").drop("_g")
    return m.join(auc, list(group), "left")


def roc_curve(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """ROC points ``(group..., idx, threshold, fpr, tpr)``.

    Thresholds are the distinct scores in descending order; a point between two others on one
    straight line is dropped, that is where the next score has as many positives and as many
    negatives as its own; a leading ``(0, 0)`` point with an infinite threshold is added.
    Running counts, the next score's counts and the group's totals come from one pass over the
    counts per score (:func:`running_total`).
    """
    by_score = score_counts(scores, group).withColumn("one", F.lit(1).cast("long"))
    pts = running_total(by_score, [("y_prob", False)], {"tps": "pos", "fps": "neg", "idx": "one"}, group,
                        following={"pos_next": "pos", "neg_next": "neg"}, group_totals={"P": "pos", "N": "neg"})
    keep = (F.col("idx") == 1) | F.col("pos_next").isNull() | (F.col("pos_next") != F.col("pos")) | (
        F.col("neg_next") != F.col("neg"))
    here = F.struct("idx", F.col("y_prob").cast("double").alias("threshold"), "tps", "fps")
    zero = F.lit(0).cast("long")
    origin = F.struct(zero.alias("idx"), F.lit(float("inf")).alias("threshold"), zero.alias("tps"), zero.alias("fps"))
    # the group's first point brings the origin along
    shown = pts.where(keep).select(*group, "P", "N", F.explode(
        F.when(F.col("idx") == 1, F.array(origin, here)).otherwise(F.array(here))).alias("pt"))
    none = F.lit(None).cast("double")
    return shown.select(
        *group, "pt.idx", "pt.threshold",
        F.when(F.col("N") == 0, none).otherwise(F.col("pt.fps").cast("double") / F.col("N").cast("double")).alias("fpr"),
        F.when(F.col("P") == 0, none).otherwise(F.col("pt.tps").cast("double") / F.col("P").cast("double")).alias("tpr"))


def class_marginals(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``(group..., class_id, tp, n_true, n_pred)`` over the union of true and predicted labels.

    Null is no class: a row without truth only counts as predicted, one without a prediction only
    as true, so both are misses here as they are in the accuracy.
    """
    return _marginals(pair_counts(scores, group), group)


def _marginals(pc: DataFrame, group: Sequence[str]) -> DataFrame:
    """Each pair counts once for its true and once for its predicted class: one pass over the pairs."""
    sides = F.array(
        F.struct(F.col("y_true").alias("class_id"), F.when(_hit(), F.col("n")).otherwise(0).alias("tp"),
                 F.col("n").alias("n_true"), F.lit(0).cast("long").alias("n_pred")),
        F.struct(F.col("y_pred").alias("class_id"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("n_true"),
                 F.col("n").alias("n_pred")))
    return pc.select(*group, F.explode(sides).alias("s")).select(*group, "s.*").where(F.col("class_id").isNotNull()).groupBy(
        *group, "class_id").agg(*[F.sum(c).cast("long").alias(c) for c in ("tp", "n_true", "n_pred")])


def _prf(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "precision": safe_div(F.col("tp"), F.col("n_pred")),
        "recall": safe_div(F.col("tp"), F.col("n_true")),
        "f1": safe_div(2 * F.col("tp"), F.col("n_true") + F.col("n_pred")),
    })


def macro_prf(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Macro precision, recall and F1 over the union of true and predicted labels."""
    return _macro(pair_counts(scores, group), group)


def _macro(pc: DataFrame, group: Sequence[str]) -> DataFrame:
    return _prf(_marginals(pc, group)).groupBy(*group).agg(
        *[F.avg(c).alias(f"{c}_macro") for c in ("precision", "recall", "f1")])


def accuracy(scores: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose prediction is the truth; a row without either is a miss."""
    return _accuracy(pair_counts(scores, group), group)


def _accuracy(pc: DataFrame, group: Sequence[str]) -> DataFrame:
    return pc.groupBy(*group).agg((F.sum(F.when(_hit(), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))


def accuracy_and_macro(scores: DataFrame, group: Sequence[str]) -> DataFrame:
    """Accuracy and the macro averages from one written table of pair counts."""
    pc = stored_counts(scores, group)
    return _accuracy(pc, group).join(_macro(pc, group), list(group))


def per_class(scores: DataFrame, labels: Sequence[int], group: Sequence[str] = ()) -> DataFrame:
    """Recall, precision and F1 for a fixed label list; an absent class gets 0."""
    marg = class_marginals(scores, group)
    spark = scores.sparkSession
    dim = spark.createDataFrame([(int(x),) for x in labels], "class_id int")
    if group:
        groups = scores.select(*group).distinct()
        # groups x labels: exploded from a literal array, not joined
        grid = groups.withColumn("class_id", F.explode(F.array(*[F.lit(int(x)) for x in labels])))
    else:
        grid = dim
    j = grid.join(marg, [*group, "class_id"], "left").fillna(0, ["tp", "n_true", "n_pred"])
    return _prf(j).select(*group, "class_id", "precision", "recall", "f1")


def multiclass_metrics(scores: DataFrame, group: Sequence[str] = (),
                       unseen_ids: Sequence[int] = ()) -> DataFrame:
    """Accuracy, known-class accuracy (unseen true labels removed) and macro F1."""
    pc = stored_counts(scores, group)
    acc, known = _accuracy(pc, group), _known(pc, unseen_ids, group)
    mac = _macro(pc, group).select(*group, "f1_macro")
    if not group:
        z = F.lit(0)
        return acc.withColumn("_g", z).join(known.withColumn("_g", z), "_g") \
            .join(mac.withColumn("_g", z), "_g").drop("_g")
    return acc.join(known, list(group), "left").join(mac, list(group), "left")


def known_class_accuracy(scores: DataFrame, unseen_ids: Sequence[int] = (),
                         group: Sequence[str] = (), empty_value: float | None = None) -> DataFrame:
    """Accuracy on rows whose true label is not unseen.

    No unseen ids -> the full accuracy.  When nothing is left the value is
    ``empty_value`` (NULL for J9, 0.0 for J10).
    """
    out = _known(pair_counts(scores, group), unseen_ids, group)
    if empty_value is not None:
        out = out.withColumn("known_class_accuracy",
                             F.coalesce(F.col("known_class_accuracy"), F.lit(float(empty_value))))
    return out


def _known(pc: DataFrame, unseen_ids: Sequence[int], group: Sequence[str]) -> DataFrame:
    known = ~F.col("y_true").isin([int(x) for x in unseen_ids]) if unseen_ids else F.lit(True)
    kept = F.coalesce(known, F.lit(True))  # a null truth is not one of the unseen
    return pc.groupBy(*group).agg(
        (F.sum(F.when(kept & _hit(), F.col("n")).when(kept, 0)) / F.sum(F.when(kept, F.col("n")))).alias("known_class_accuracy"))


def rare_classes(scores: DataFrame, group: Sequence[str] = (), min_count: int = 5) -> DataFrame:
    """``(group..., y_true, n)`` of the true classes with fewer than ``min_count`` rows."""
    return scores.groupBy(*group, "y_true").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < min_count)


def rare_class_accuracy(scores: DataFrame, group: Sequence[str] = (), min_count: int = 5) -> DataFrame:
    """Accuracy after dropping true classes with fewer than ``min_count`` rows.

    Also returns the number of rows scored and of classes dropped (:func:`rare_classes`
    lists them).  Everything follows from the counts per class.
    """
    per = scores.groupBy(*group, "y_true").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(_hit().cast("long")).alias("_hit"))
    kept = F.col("_n") >= min_count
    return per.groupBy(*group).agg(
        (F.sum("_hit") / F.sum("_n")).alias("full_accuracy"),
        (F.sum(F.when(kept, F.col("_hit"))) / F.sum(F.when(kept, F.col("_n")))).alias("known_class_accuracy"),
        F.coalesce(F.sum(F.when(kept, F.col("_n"))), F.lit(0)).alias("n_scored"),
        F.count_if(~kept).alias("n_rare"))


def f1_by_category(scores: DataFrame, label_to_category: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """F1 per category after mapping fine labels to categories.

    Truth must map (inner join, missing truth raises); an unmapped prediction
    becomes ``unknown``; every category of the dictionary is reported.
    """
    dim = label_to_category.select(F.col("label_id").cast("int").alias("_id"), F.col("category"))
    t = scores.join(dim.withColumnRenamed("category", "true_cat"),
                    F.col("y_true") == F.col("_id"), "left").drop("_id")
    t = t.withColumn("true_cat", F.when(F.col("true_cat").isNull(), F.raise_error(
        F.concat(F.lit("true label without category: "), F.col("y_true").cast("string"))))
        .otherwise(F.col("true_cat")))
    p = t.join(dim.withColumnRenamed("category", "pred_cat"),
               F.col("y_pred") == F.col("_id"), "left").drop("_id") \
        .withColumn("pred_cat", F.coalesce("pred_cat", F.lit("unknown")))
    cats = [r["category"] for r in dim.select("category").distinct().collect()]
    per = p.groupBy(*group).agg(*[
        F.struct(
            F.sum(((F.col("true_cat") == c) & (F.col("pred_cat") == c)).cast("long")).alias("tp"),
            F.sum((F.col("true_cat") == c).cast("long")).alias("n_true"),
            F.sum((F.col("pred_cat") == c).cast("long")).alias("n_pred")).alias(f"c{i}")
        for i, c in enumerate(cats)])
    long = per.select(*group, F.explode(F.array(*[
        F.struct(F.lit(c).alias("category"), F.col(f"c{i}.tp").alias("tp"),
                 F.col(f"c{i}.n_true").alias("n_true"), F.col(f"c{i}.n_pred").alias("n_pred"))
        for i, c in enumerate(cats)])).alias("s")).select(*group, "s.*")
    return long.select(*group, "category",
                       safe_div(2 * F.col("tp"), F.col("n_true") + F.col("n_pred")).alias("f1"))


def f1_by_label_map(scores: DataFrame, mapping: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """One-vs-rest F1 of each mapped label, keyed by its category; the last row wins.

    ``mapping`` is ``(position, label_id, category)``.
    """
    w = Window.partitionBy("category").orderBy(F.desc("position"))
    # the mapping is a dictionary: a handful of rows
    last = mapping.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1) \
        .select(F.col("label_id").cast("int").alias("class_id"), "category")
    labels = [r["class_id"] for r in last.collect()]
    pc = per_class(scores, labels, group)
    return pc.join(F.broadcast(last), "class_id", "inner").select(*group, "category", "f1")


def f1_binary_vs_category(scores: DataFrame, categories: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """F1 of a binary prediction against ``y_true == category id`` for each category.

    Kept for parity; the detection rate (J15) is the meaningful reading.
    """
    per = scores.groupBy(*group).agg(*[
        F.struct(
            F.sum(((F.col("y_true") == i) & (F.col("y_pred") == 1)).cast("long")).alias("tp"),
            F.sum((F.col("y_true") == i).cast("long")).alias("n_true"),
            F.sum((F.col("y_pred") == 1).cast("long")).alias("n_pred")).alias(f"c{i}")
        for i in range(len(categories))])
    long = per.select(*group, F.explode(F.array(*[
        F.struct(F.lit(c).alias("category"), F.col(f"c{i}.tp").alias("tp"),
                 F.col(f"c{i}.n_true").alias("n_true"), F.col(f"c{i}.n_pred").alias("n_pred"))
        for i, c in enumerate(categories)])).alias("s")).select(*group, "s.*")
    return long.select(*group, "category",
                       safe_div(2 * F.col("tp"), F.col("n_true") + F.col("n_pred")).alias("f1"))


def detection_rate(scores: DataFrame, category_col: str = "category", group: Sequence[str] = ()) -> DataFrame:
    """Share of rows flagged (``y_pred = 1``) within each true category."""
    return scores.groupBy(*group, category_col).agg(
        F.avg((F.col("y_pred") == 1).cast("double")).alias("detection_rate"),
        F.count(F.lit(1)).alias("n"))


def _p_true(scores: DataFrame) -> F.Column:
    if "probability" in scores.columns:
        return F.element_at(F.col("probability"), F.col("y_true") + 1)
    return F.when(F.col("y_true") == 1, F.col("y_prob")).otherwise(1.0 - F.col("y_prob"))


def log_loss(scores: DataFrame, group: Sequence[str] = (), eps: float = 1e-15) -> DataFrame:
    """Mean cross-entropy ``-log(max(p_true, eps))`` per group."""
    return scores.groupBy(*group).agg(F.avg(-F.log(F.greatest(_p_true(scores), F.lit(eps)))).alias("log_loss"))


def weighted_log_loss(scores: DataFrame, weights: DataFrame, group: Sequence[str] = (),
                      eps: float = 1e-15) -> DataFrame:
    """Class-weighted cross-entropy ``sum(w * l) / sum(w)``; ``weights`` is ``(class_id, weight)``."""
    w = weights.select(F.col("class_id").cast("int").alias("y_true"), F.col("weight").cast("double"))
    j = scores.join(F.broadcast(w), "y_true", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    loss = -F.log(F.greatest(_p_true(scores), F.lit(eps)))
    return j.groupBy(*group).agg((F.sum(F.col("weight") * loss) / F.sum("weight")).alias("weighted_log_loss"))
