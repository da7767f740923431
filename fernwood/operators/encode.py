"""Fit/transform encoders, scaling and labels.

Fitted state is small and explicit:

* :class:`Vocabulary` is a DataFrame ``(feature, value, id)``; ids are the
  rank of the value in sorted order.  It is joined back without a hint, so Spark
  decides by its size.  Transforming a frame with values
  never seen at fit time returns a *new* vocabulary with the unseen values
  appended after the known ids, sorted among themselves.
* one-hot levels and scaling statistics are a few literals per column and are
  applied in one ``select``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernwood.operators.audit import check_missing
from fernwood.operators.quantiles import numeric_columns, present
from fernwood.operators.ranking import global_rank
from fernwood.schema import columns_except
from fernwood.session import write_scratch



@dataclass
class Vocabulary:
    """``(feature, value, id)`` with ids 0..n-1 per feature; ``sizes`` is ``{feature: n}``."""

    table: DataFrame
    sizes: dict[str, int]

    @property
    def rows(self) -> int:
        return sum(self.sizes.values())


def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("s")).select("s.*").where(F.col("value").isNotNull())


def _rank_values(distinct: DataFrame, offset: dict[str, int] | None = None) -> DataFrame:
    """``id = offset + rank - 1`` of each value in byte order, per feature."""
    ranked = global_rank(distinct, [("value", True)], ["feature"], "_r")
    off = F.lit(0)
    if offset:
        off = F.coalesce(F.element_at(F.create_map(*[x for k, v in offset.items()
                                                     for x in (F.lit(k), F.lit(v))]), F.col("feature")),
                         F.lit(0))
    return ranked.select("feature", "value", (F.col("_r") - 1 + off).cast("int").alias("id"))


def fit_vocabulary(df: DataFrame, cols: Sequence[str]) -> Vocabulary:
    """Sorted distinct values of each column, id = rank - 1."""
    if not cols:
        return Vocabulary(df.sparkSession.createDataFrame([], "feature string, value string, id int"), {})
    distinct = _long_values(df, cols).distinct()
    sizes = {r["feature"]: r["n"] for r in
             distinct.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    for c in cols:
        sizes.setdefault(c, 0)
    return Vocabulary(write_scratch(_rank_values(distinct), "vocabulary"), sizes)


def extend_vocabulary(vocab: Vocabulary, df: DataFrame, cols: Sequence[str]) -> Vocabulary:
    """A new vocabulary with values unseen at fit time appended (sorted among themselves)."""
    if not cols:
        return vocab
    seen = _long_values(df, cols).distinct()
    known = vocab.table.select("feature", "value")
    new = seen.join(known, ["feature", "value"], "left_anti")
    new_sizes = {r["feature"]: r["n"] for r in
                 new.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not new_sizes:
        return vocab
    appended = _rank_values(new, offset={c: vocab.sizes.get(c, 0) for c in new_sizes})
    sizes = dict(vocab.sizes)
    for c, n in new_sizes.items():
        sizes[c] = sizes.get(c, 0) + n
    return Vocabulary(vocab.table.unionByName(write_scratch(appended, "vocabulary")), sizes)


def ordinal_transform(df: DataFrame, vocab: Vocabulary, cols: Sequence[str],
                      extend: bool = True) -> tuple[DataFrame, Vocabulary]:
    """Replace each column by its id; unseen values get appended ids when ``extend``.

    With ``extend=False`` unseen values become null.  Returns the frame and the
    vocabulary actually used (the input one is never changed).
    """
    if extend:
        vocab = extend_vocabulary(vocab, df, cols)
    out = df
    for c in cols:
        v = vocab.table.where(F.col("feature") == c).select(
            F.col("value").alias(f"_v_{c}"), F.col("id").alias(f"_id_{c}"))
        out = out.join(v, out[c].cast("string") == F.col(f"_v_{c}"), "left") \
            .withColumn(c, F.col(f"_id_{c}")).drop(f"_v_{c}", f"_id_{c}")
    return out, vocab


def fit_one_hot(df: DataFrame, cols: Sequence[str], max_levels: int = 1000) -> dict[str, list[str]]:
    """D3 fit: the pinned, sorted levels of each low-cardinality column.

    Levels become columns of the plan, so a column with more than ``max_levels`` of them is
    refused; they are counted before any of them comes to the driver.
    """
    if not cols:
        return {}
    distinct = write_scratch(_long_values(df, cols).distinct(), "levels")
    for r in distinct.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_levels).collect():
        raise ValueError(f"{r['feature']} has {r['n']} levels, more than max_levels={max_levels}; "
                         "use an ordinal encoding or raise max_levels")
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for r in distinct.collect():
        levels[r["feature"]].append(r["value"])
    for c in cols:
        levels[c].sort(key=lambda s: s.encode("utf-8"))
    return levels


def one_hot(df: DataFrame, levels: dict[str, list[str]], keep_original: bool = False) -> DataFrame:
    """D3: ``{col}_{level}`` 0/1 tinyint columns in one ``select``; unseen level -> all zeros."""
    new_cols = []
    for c, vals in levels.items():
        for v in vals:
            new_cols.append((F.coalesce(F.col(c).cast("string") == F.lit(v), F.lit(False)))
                            .cast("tinyint").alias(f"{c}_{v}"))
    kept = [c for c in df.columns if keep_original or c not in levels]
    return df.select(*kept, *new_cols)


@dataclass
class ScalerModel:
    """Per-column mean and population std (zero std divides by 1)."""

    stats: dict[str, tuple[float, float]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.stats:
            raise ValueError("scaler is not fitted")
        return df.withColumns({
            c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s if s else 1.0)
            for c, (m, s) in self.stats.items()})

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(c, m, s) for c, (m, s) in self.stats.items()],
                                     "feature string, mean double, std double")


def fit_scaler(df: DataFrame, cols: Sequence[str] | None = None) -> ScalerModel:
    """One aggregate of ``avg`` and ``stddev_pop`` over all columns; null and NaN are left out.

    A missing value stays missing when transformed; a column without any value is not scaled.
    """
    cols = numeric_columns(df, cols)
    row = df.agg(*[F.avg(present(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(present(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return ScalerModel({c: (0.0, 1.0) if row[f"m{i}"] is None else (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)})


TASKS = ("binary", "multiclass", "multiclass_5cat")


def make_labels(df: DataFrame, task: str = "binary", label: str = "label",
                label_dim: DataFrame | None = None, normal: str = "normal",
                out: str = "y") -> DataFrame:
    """Append the integer target ``out``.

    ``binary``: 0 for ``normal`` else 1.  ``multiclass``: the label id of one
    shared dictionary (the same ids for every split).  ``multiclass_5cat``: the
    category id.  A label missing from the dictionary raises at run time.
    """
    if task == "binary":
        return df.withColumn(out, (F.col(label) != F.lit(normal)).cast("tinyint"))
    if task not in TASKS:
        raise ValueError(f"unknown task {task!r}; expected one of {TASKS}")
    if label_dim is None:
        raise ValueError(f"task {task!r} needs a label dictionary")
    idcol = "label_id" if task == "multiclass" else "category_id"
    dim = label_dim.select(F.col("name").alias("_lname"), F.col(idcol).alias("_lid"))
    joined = df.join(dim, df[label] == F.col("_lname"), "left")
    checked = F.when(F.col("_lid").isNull(),
                     F.raise_error(F.concat(F.lit("label not in dictionary: "), F.col(label).cast("string")))
                     ).otherwise(F.col("_lid")).cast("int")
    return joined.withColumn(out, checked).drop("_lname", "_lid")


@dataclass
class PreprocessModel:
    """Fitted encoders for the whole preparation step."""

    task: str
    ordinal_cols: list[str]
    one_hot_levels: dict[str, list[str]]
    vocab: Vocabulary
    scaler: ScalerModel
    feature_cols: list[str]
    label_dim: DataFrame | None = None
    drop_cols: list[str] = field(default_factory=list)
    missing: tuple[int, list[str]] = (0, [])

    def transform(self, df: DataFrame, key: str = "key", label: str = "label",
                  normal: str = "normal") -> tuple[DataFrame, "PreprocessModel"]:
        """Encode -> drop -> scale; returns the frame and the model with any extended vocabulary."""
        y = make_labels(df, self.task, label, self.label_dim, normal)
        enc, vocab = ordinal_transform(y, self.vocab, self.ordinal_cols)
        enc = one_hot(enc.drop(*[c for c in self.drop_cols if c in enc.columns], label),
                      self.one_hot_levels)
        scaled = self.scaler.transform(enc)
        keep = [c for c in [key] if c in scaled.columns] + self.feature_cols + ["y"]
        extra = [c for c in scaled.columns if c not in keep and c not in self.feature_cols]
        model = PreprocessModel(self.task, self.ordinal_cols, self.one_hot_levels, vocab,
                                self.scaler, self.feature_cols, self.label_dim, self.drop_cols, self.missing)
        return scaled.select(*keep, *[c for c in extra if c == "split"]), model


def preprocess_fit(df: DataFrame, task: str, ordinal_cols: Sequence[str], one_hot_cols: Sequence[str],
                   label_dim: DataFrame | None = None, key: str = "key", label: str = "label",
                   drop_cols: Sequence[str] = ("difficulty",), passthrough: Sequence[str] = ("split",),
                   scale_cols: Sequence[str] | None = None) -> PreprocessModel:
    """Audit, then fit of labels, ordinal ids, one-hot levels and scaling on ``df``.

    The audit counts missing cells in one pass and warns (``missing`` of the model keeps the
    total and the columns); nothing is filled.

    Scaling covers every feature (ids and one-hot columns included) unless
    ``scale_cols`` narrows it.
    """
    if task not in TASKS:
        raise ValueError(f"unknown task {task!r}; expected one of {TASKS}")
    missing = check_missing(df)
    vocab = fit_vocabulary(df, ordinal_cols)
    levels = fit_one_hot(df, one_hot_cols)
    enc, _ = ordinal_transform(df, vocab, ordinal_cols, extend=False)
    enc = one_hot(enc, levels)
    skip = {key, label, *drop_cols, *passthrough}
    features = columns_except(enc, skip)
    scaler = fit_scaler(enc, list(scale_cols) if scale_cols is not None else features)
    return PreprocessModel(task, list(ordinal_cols), levels, vocab, scaler, features,
                           label_dim, list(drop_cols), missing)
