"""Splits, folds, class weights, exact kNN and SMOTE oversampling.

Random choices come from :func:`unit_draw` / :func:`hash32` of the row key,
class, draw number and seed, so results do not depend on partitioning or task
retries.  Per-class work never puts a hot class into one task:

* ranks inside a class use :func:`global_rank` (range buckets);
* the exact kNN search compares blocks of a few hundred points, pruned by pivots
  (:mod:`fernwood.operators.neighbours`);
* synthetic rows are generated in fixed-size chunks spread over tasks, and the
  base / neighbour rows are fetched with equi-joins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernwood.functions import hash32, unit_draw
from fernwood.operators.neighbours import knn_within_class
from fernwood.operators.ranking import global_rank

# Synthetic rows produced by one task
CHUNK_ROWS = 100_000


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    """``{class: rows}`` (one small aggregate; classes are few)."""
    return {r[0]: r[1] for r in df.groupBy(label).count().collect()}


def _quotas(counts: dict, total_draw: int) -> dict:
    """Largest-remainder allocation of ``total_draw`` rows over classes (ties by class)."""
    n = sum(counts.values())
    exact = {c: total_draw * v / n for c, v in counts.items()}
    floor = {c: math.floor(x) for c, x in exact.items()}
    left = total_draw - sum(floor.values())
    order = sorted(counts, key=lambda c: (-(exact[c] - floor[c]), c is not None, c))
    for c in order[:left]:
        floor[c] += 1
    return floor


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42,
                     out: str = "split") -> DataFrame:
    """Stratified hold-out; ``ceil(test_size * N)`` rows go to ``holdout``.

    Per-class quotas use the largest remainder; inside a class the rows with
    the smallest ``hash(key, seed)`` are held out.
    """
    counts = class_counts(df, label)
    quotas = _quotas(counts, math.ceil(test_size * sum(counts.values())))
    h = df.withColumn("_h", hash32(F.col(key), seed))
    ranked = global_rank(h, [("_h", True), (key, True)], [label], "_rk")
    q = df.sparkSession.createDataFrame(list(quotas.items()), f"_class {df.schema[label].dataType.simpleString()}, _quota long")
    # one row per class, as collected above: no row moves for its quota
    return ranked.join(F.broadcast(q), ranked[label].eqNullSafe(q["_class"])).withColumn(
        out, F.when(F.col("_rk") <= F.col("_quota"), "holdout").otherwise("train")).drop("_h", "_rk", "_class", "_quota")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """``fold = (rank - 1) mod k`` with the rank inside the class in hash order."""
    h = df.withColumn("_h", hash32(F.col(key), seed))
    ranked = global_rank(h, [("_h", True), (key, True)], [label], "_rk")
    return ranked.withColumn(out, F.pmod(F.col("_rk") - 1, F.lit(k)).cast("int")).drop("_h", "_rk")


def minority_classes(df: DataFrame, label: str, threshold: int = 1000) -> DataFrame:
    """``(class_id, n)`` for classes with ``0 < n < threshold``."""
    return df.groupBy(F.col(label).alias("class_id")).agg(F.count(F.lit(1)).alias("n")) \
        .where((F.col("n") > 0) & (F.col("n") < threshold))


def eligible_minority(df: DataFrame, label: str, threshold: int = 1000, min_rows: int = 3) -> DataFrame:
    """Minority classes with an ``eligible`` flag (at least ``min_rows`` rows)."""
    return minority_classes(df, label, threshold).withColumn("eligible", F.col("n") >= min_rows)


def check_smote_sizes(counts: dict, targets: Sequence[int], k: int) -> None:
    """Every target class needs at least ``k + 1`` rows."""
    for c in targets:
        n = counts.get(c, 0)
        if n < k + 1:
            raise ValueError(f"class {c} has {n} rows; SMOTE with k_neighbors={k} needs at least {k + 1}")


def smote_plan(df: DataFrame, label: str, targets: Sequence[int], strategy="auto") -> DataFrame:
    """``(class_id, have, want, to_make)``; ``auto`` grows each target to the majority count."""
    counts = df.groupBy(F.col(label).alias("class_id")).agg(F.count(F.lit(1)).alias("have"))
    if strategy == "auto":
        planned = counts.withColumn("want", F.lit(counts.agg(F.max("have")).first()[0]))
    else:
        m = F.create_map(*[x for c, v in dict(strategy).items() for x in (F.lit(int(c)), F.lit(int(v)))])
        planned = counts.withColumn("want", F.element_at(m, F.col("class_id")).cast("long"))
    return planned.where(F.col("class_id").isin([int(t) for t in targets])).select(
        "class_id", "have", "want", F.greatest(F.col("want") - F.col("have"), F.lit(0)).alias("to_make"))


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """``weight = N / (K * n_c)`` over the K classes present."""
    counts = df.groupBy(F.col(label).alias("class_id")).agg(F.count(F.lit(1)).alias("n"))
    total, classes = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    return counts.select("class_id", (F.lit(total) / (F.lit(classes) * F.col("n"))).alias("weight"))


def balanced_weights_fixed_k(df: DataFrame, label: str, k: int) -> DataFrame:
    """Weights for classes ``0..k-1``; an empty class counts as one row."""
    spark = df.sparkSession
    n_total = F.lit(df.count())
    dim = spark.createDataFrame([(i,) for i in range(k)], "class_id int")
    counts = df.groupBy(F.col(label).cast("int").alias("class_id")).agg(F.count(F.lit(1)).alias("n"))
    return dim.join(counts, "class_id", "left").select(
        "class_id", (n_total / (F.lit(k) * F.greatest(F.coalesce("n", F.lit(0)), F.lit(1)))).cast("double")
        .alias("weight"))


def explicit_weights(df: DataFrame, label: str, weights: dict) -> DataFrame:
    """Given weights, 1.0 for any class not listed."""
    m = F.create_map(*[x for c, v in weights.items() for x in (F.lit(int(c)), F.lit(float(v)))])
    classes = df.select(F.col(label).cast("int").alias("class_id")).distinct()
    return classes.select("class_id", F.coalesce(F.element_at(m, F.col("class_id")), F.lit(1.0)).alias("weight"))


def with_weights(df: DataFrame, label: str, weights: DataFrame, out: str = "weight") -> DataFrame:
    """Attach a per-row weight for ``weightCol`` (weights table is one row per class)."""
    w = weights.select(F.col("class_id").alias(label), F.col("weight").alias(out))
    return df.join(F.broadcast(w), label, "left").withColumn(out, F.coalesce(F.col(out), F.lit(1.0)))


def resample_by_weight(df: DataFrame, key: str, weight: str, seed: int = 42) -> DataFrame:
    """Rows repeated ``weight`` times on average, for learners without a weight column.

    A row gets the whole part of its weight, and one more with the chance of the rest, drawn
    from a hash of its key.
    """
    whole = F.floor(weight)
    copies = whole + (unit_draw(F.col(key), seed) < F.col(weight) - whole).cast("long")
    return df.where(copies > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))).drop("_copy")


def smote(df: DataFrame, key: str, label: str, features: str, targets: Sequence[int],
          strategy="auto", k: int = 5, seed: int = 42) -> DataFrame:
    """SMOTE oversampling of ``targets``; originals kept, other classes untouched.

    Synthetic row ``i`` of class ``c``: base = the row of rank
    ``hash(c, i, seed, 'base') mod have`` (rank in key order), neighbour =
    its ``(hash(c, i, seed, 'nbr') mod k) + 1``-th nearest same-class row,
    ``u = draw(c, i, seed, 'gap')`` and ``x_new = x + u * (x_nbr - x)``.
    Output: ``(label, sample_id, is_synthetic, features)``; synthetic ids are
    ``-(offset + i + 1)`` with the rows made for smaller classes as offset, so they are unique.
    """
    counts = class_counts(df, label)
    check_smote_sizes(counts, targets, k)
    plan = {r["class_id"]: (r["have"], r["to_make"]) for r in
            smote_plan(df, label, targets, strategy).collect()}
    spark = df.sparkSession
    orig = df.select(F.col(label).alias(label), F.col(key).cast("long").alias("sample_id"),
                     F.lit(False).alias("is_synthetic"),
                     F.transform(features, lambda v: v.cast("double")).alias(features))
    offset, before = {}, 0
    for c in sorted(plan):
        offset[c], before = before, before + plan[c][1]
    chunks = [(c, offset[c], h, j, int(min(CHUNK_ROWS, to_make - j * CHUNK_ROWS)))
              for c, (h, to_make) in plan.items() if to_make > 0
              for j in range(math.ceil(to_make / CHUNK_ROWS))]
    if not chunks:
        return orig
    pool = df.where(F.col(label).isin(list(plan))).select(
        F.col(label).alias("cls"), F.col(key).alias("key"),
        F.transform(features, lambda v: v.cast("double")).alias("x"))
    base_ranked = global_rank(pool, [("key", True)], ["cls"], "br")
    knn = knn_within_class(df.where(F.col(label).isin(list(plan))), key, label, features, k)

    # a task per chunk of synthetic rows
    chunk_df = spark.createDataFrame(chunks, "cls int, off long, have long, chunk int, n int").repartition(len(chunks))
    syn = chunk_df.select("cls", "off", "have", F.explode(F.sequence(
        F.col("chunk") * CHUNK_ROWS, F.col("chunk") * CHUNK_ROWS + F.col("n") - 1)).alias("i"))
    syn = syn.select(
        "cls", "off", "i",
        (F.pmod(hash32(F.col("cls"), F.col("i"), seed, "base"), F.col("have")) + 1).alias("br"),
        (F.pmod(hash32(F.col("cls"), F.col("i"), seed, "nbr"), F.lit(k)) + 1).cast("int").alias("nbr_rank"),
        unit_draw(F.col("cls"), F.col("i"), seed, "gap").alias("u"))

    base = base_ranked.select("cls", "br", F.col("key").alias("bkey"), F.col("x").alias("bx"))
    s1 = syn.join(base, ["cls", "br"], "inner")
    nb = knn.select(F.col(label).alias("cls"), F.col(key).alias("bkey"), "nbr_rank", "nbr_key")
    s2 = s1.join(nb, ["cls", "bkey", "nbr_rank"], "inner")
    nx = pool.select(F.col("key").alias("nbr_key"), F.col("x").alias("nx"))
    s3 = s2.join(nx, "nbr_key", "inner")
    new = s3.select(
        F.col("cls").alias(label), (-(F.col("off") + F.col("i") + 1)).cast("long").alias("sample_id"),
        F.lit(True).alias("is_synthetic"),
        F.zip_with("bx", "nx", lambda a, b: a + F.col("u") * (b - a)).alias(features))
    return orig.unionByName(new)

