"""Exact linear-interpolated quantiles for many columns in one distributed job.

Same definition as pandas ``Series.quantile`` (linear) and DuckDB
``quantile_cont``: with ``h = (n - 1) * q``, the result is
``v[floor h] + (v[ceil h] - v[floor h]) * (h - floor h)`` over the sorted
non-null values.

Spark's own ``percentile`` keeps a value->count map of the whole column in one
task, which does not survive a high-cardinality column at scale.  Here:

* one aggregate takes the number of values and a quantile sketch per column; the sketch
  gives, for every target, a bracket of values that must hold the target ranks;
* the brackets of ungrouped columns (columns x probabilities, the caller's arguments) are
  literals of two narrow scans: an aggregate that counts the values below each bracket, and
  a projection that lets only the values inside through, a few hundredths of a percent of
  the rows.  Rows are neither unpivoted nor joined, and only what lies inside is shuffled;
* with groups the brackets stay a table of one row per group; rows meet theirs by a join on
  the group and a salt, so a hot group is spread, and nothing is collected;
* :func:`running_total` ranks the values inside a bracket (range buckets, no single-task
  window).  A bracket that misses its ranks is widened to the whole column.

``method="approx"`` switches to ``percentile_approx`` for very wide frames
where an approximate answer is acceptable.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, BooleanType

from fernwood.operators.ranking import running_total
from fernwood.session import write_scratch

#: of the quantile sketch; a rank is off by one in so many at most
ACCURACY = 10000
#: sub-keys that the rows of a hot group are spread over
SALTS = 64


def numeric_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Columns of ``cols`` (default: all) that exist and are numeric; booleans excluded."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    names = list(cols) if cols is not None else list(df.columns)
    return [c for c in names if c in fields and isinstance(fields[c], NumericType)
            and not isinstance(fields[c], BooleanType)]


def present(c: str) -> Column:
    """The column as double, NaN as null (the missing value of the learners' tables)."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def stack_long(df: DataFrame, cols: Sequence[str], name: str = "feature",
               value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``cols`` to ``(keep..., name, value double)``."""
    return df.select(*keep, *[present(c).alias(c) for c in cols]).unpivot(
        list(keep), list(cols), name, value)


def value_counts(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """``(group..., column, value, cnt)``: distinct non-null values with their counts."""
    long = stack_long(df, cols, keep=group_cols).where(F.col("value").isNotNull())
    return long.groupBy(*group_cols, "feature", "value").agg(F.count(F.lit(1)).alias("cnt"))


def _edges(probs: Sequence[float]) -> list[float]:
    """Where the sketch is asked: just below and just above every probability."""
    around = 2.0 / ACCURACY
    return [x for p in probs for x in (max(0.0, p - around), min(1.0, p + around))]


def quantiles_long(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   method: str = "exact", group_cols: Sequence[str] = ()) -> DataFrame:
    """Table ``(group..., feature, prob, quantile)`` of linear quantiles.

    Without groups the answer has columns x probs rows and is a fitted statistic (a local
    DataFrame); with groups it is computed and stays distributed.
    """
    cols = numeric_columns(df, cols)
    probs = [float(p) for p in probs]
    spark = df.sparkSession
    if not cols:
        return _empty(spark, df, group_cols)
    if method == "approx":
        long = stack_long(df, cols, keep=group_cols)
        agg = long.groupBy(*group_cols, "feature").agg(
            F.percentile_approx("value", list(probs), 100000).alias("_qs"))
        return agg.select(
            *group_cols, "feature",
            F.explode(F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"),
                                   F.col("_qs").alias("quantile"))).alias("_z"),
        ).select(*group_cols, "feature", "_z.prob", "_z.quantile")
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")
    if group_cols:
        return _grouped(df, cols, probs, list(group_cols))
    out = [(c, p, q) for c, qs in _ungrouped(df, cols, probs).items() for p, q in zip(probs, qs, strict=True)]
    return spark.createDataFrame(out, "feature string, prob double, quantile double")


# ---------------------------------------------------------------- without groups: literals in the scan

def _ungrouped(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float]]:
    """``{column: quantiles}`` of the columns that have a value."""
    if not probs:
        return {}
    edges = _edges(probs)
    stats = df.agg(*[F.struct(F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("most"),
                              F.percentile_approx(v, edges, ACCURACY).alias("edges")).alias(f"c{i}")
                     for i, v in enumerate(map(present, cols))]).first()
    targets, brackets = {}, {}
    for c in range(len(cols)):
        if stats[c]["n"]:
            for i, p in enumerate(probs):
                h = (stats[c]["n"] - 1) * p
                targets[c, i] = (math.floor(h), math.ceil(h))
                brackets[c, i] = tuple(stats[c]["edges"][2 * i:2 * i + 2])
    found: dict = {}
    todo = targets
    while todo:
        found.update(_ranked(df, cols, todo, brackets))
        # the sketch's bound makes a miss unlikely; the next round searches the whole column
        todo = {t: ranks for t, ranks in todo.items() if any((*t, r) not in found for r in ranks)}
        brackets.update({(c, i): (stats[c]["least"], stats[c]["most"]) for c, i in todo})
    out: dict[str, list[float]] = {}
    for (c, i), (lo, hi) in targets.items():
        a, b = found[c, i, lo], found[c, i, hi]
        out.setdefault(cols[c], []).append(a + (b - a) * ((stats[c]["n"] - 1) * probs[i] - lo))
    return out


def _ranked(df: DataFrame, cols: list[str], targets: dict, brackets: dict) -> dict[tuple[int, int, int], float]:
    """``{(column, target, rank): value}`` of the ranks that lie in their target's bracket."""
    counted = df.agg(*[F.count(F.when(present(cols[c]) < brackets[c, i][0], 1)).alias(f"b{c}_{i}") for c, i in targets]).first()
    below = {t: counted[f"b{t[0]}_{t[1]}"] for t in targets}
    inside = F.filter(F.array(*[
        F.when(present(cols[c]).between(*map(F.lit, brackets[c, i])),
               F.struct(F.lit(c).alias("c"), F.lit(i).alias("i"), present(cols[c]).alias("value"))) for c, i in targets]),
        lambda x: x.isNotNull())
    values = df.select(F.explode(inside).alias("v")).select("v.*").groupBy("c", "i", "value").agg(
        F.count(F.lit(1)).alias("cnt"))
    cum = running_total(write_scratch(values, "brackets"), [("value", True)], {"cum": "cnt"}, ["c", "i"])
    # ranks inside the bracket, by column and target
    wanted = F.create_map(*[x for (c, i), ranks in targets.items() for x in (
        F.lit(f"{c},{i}"), F.array(*[F.lit(r - below[c, i]).cast("long") for r in ranks]))])
    hits = cum.withColumn("r", F.explode(F.array_distinct(wanted[F.concat_ws(",", "c", "i")]))).where(
        (F.col("cum") - F.col("cnt") <= F.col("r")) & (F.col("r") < F.col("cum")))
    return {(h["c"], h["i"], h["r"] + below[h["c"], h["i"]]): h["value"] for h in hits.collect()}


# ---------------------------------------------------------------- with groups: a table of brackets

def _salted_join(rows: DataFrame, table: DataFrame, keys: list[str], spread: Column) -> DataFrame:
    """``rows`` with the columns of ``table`` (one row per ``keys``), hot keys spread over sub-keys.

    The table's rows are repeated for the sub-keys that occur.  Null keys meet like any other.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    parts = salted.groupBy(*keys, "_salt").agg(F.lit(1).alias("_one")).select(
        *[F.col(k).alias(f"_p_{k}") for k in keys], F.col("_salt").alias("_p_salt"))
    named = table.withColumnsRenamed({k: f"_t_{k}" for k in keys})

    def same(a: str, b: str) -> Column:
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(f"{a}{k}").eqNullSafe(F.col(f"{b}{k}"))
        return cond
    wanted = parts.join(named, same("_p_", "_t_")).drop(*[f"_t_{k}" for k in keys])
    return salted.join(wanted, same("", "_p_") & (F.col("_salt") == F.col("_p_salt"))).drop(
        "_salt", "_p_salt", *[f"_p_{k}" for k in keys])


def _grouped(df: DataFrame, cols: list[str], probs: list[float], groups: list[str]) -> DataFrame:
    """Quantiles per group and column; groups may be many and of any size."""
    vals = [f"_v{i}" for i in range(len(cols))]
    rows = df.select(*groups, *[present(c).alias(v) for c, v in zip(cols, vals, strict=True)])
    edges = _edges(probs)
    stats = write_scratch(rows.groupBy(*groups).agg(*[
        F.struct(F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("most"),
                 F.percentile_approx(v, edges, ACCURACY).alias("edges")).alias(f"_s{i}") for i, v in enumerate(vals)]), "sketches")

    def bracket(c: int, i: int, whole: bool) -> tuple[Column, Column]:
        s = F.col(f"_s{c}")
        return (s["least"], s["most"]) if whole else (s["edges"][2 * i], s["edges"][2 * i + 1])

    def searched(table: DataFrame, whole: bool) -> DataFrame:
        met = _salted_join(rows, table, groups, F.struct(*vals))
        cells = []
        for c, v in enumerate(vals):
            for i in range(len(probs)):
                lo, hi = bracket(c, i, whole)
                # below a bracket only the number counts: those values fall together into one row
                cells.append(F.when(F.col(v) <= hi, F.struct(
                    F.lit(c).alias("c"), F.lit(i).alias("i"), F.col(f"_s{c}")["n"].alias("n"),
                    F.when(F.col(v) >= lo, F.col(v)).alias("value"))))
        inside = met.select(*groups, F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("_x")).select(
            *groups, "_x.*").groupBy(*groups, "c", "i", "n", "value").agg(F.count(F.lit(1)).alias("cnt"))
        # nulls come first, so the running count of the values inside starts from the rows below
        cum = running_total(write_scratch(inside, "brackets"), [("value", True)], {"cum": "cnt"}, [*groups, "c", "i"])
        h = (F.col("n") - 1) * F.array(*map(F.lit, probs))[F.col("i")]

        def at(rank: Column) -> Column:
            return F.max(F.when((F.col("cum") - F.col("cnt") <= rank) & (rank < F.col("cum")), F.col("value")))
        return cum.where(F.col("value").isNotNull()).groupBy(*groups, "c", "i", "n").agg(
            at(F.floor(h)).alias("a"), at(F.ceil(h)).alias("b"))

    # one row for every group, column with a value, and probability
    asked = stats.select(*groups, F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.lit(i).alias("i"), F.col(f"_s{c}")["n"].alias("n"))
        for c in range(len(cols)) for i in range(len(probs))])).alias("_x")).select(*groups, "_x.*").where(F.col("n") > 0)
    found = write_scratch(searched(stats, False).where(F.col("a").isNotNull() & F.col("b").isNotNull()), "ranks")
    keys = [*groups, "c", "i", "n"]

    def missed() -> DataFrame:
        return asked.unionByName(found.select(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") == 1)
    if not missed().isEmpty():  # the sketch's bound makes this unlikely
        again = searched(stats, True)
        both = found.withColumn("_o", F.lit(0)).unionByName(again.withColumn("_o", F.lit(1)))
        found = both.groupBy(*keys).agg(F.min(F.struct("_o", "a", "b")).alias("_m")).select(*keys, "_m.a", "_m.b")
    h = (F.col("n") - 1) * F.array(*map(F.lit, probs))[F.col("i")]
    return found.select(
        *groups, F.array(*map(F.lit, cols))[F.col("c")].alias("feature"), F.array(*map(F.lit, probs))[F.col("i")].alias("prob"),
        (F.col("a") + (F.col("b") - F.col("a")) * (h - F.floor(h))).alias("quantile"))


def _empty(spark, df, group_cols):
    key_fields = [df.schema[g].simpleString().split(":", 1)[1] for g in group_cols]
    schema = ", ".join([f"`{g}` {t}" for g, t in zip(group_cols, key_fields)]
                       + ["feature string", "prob double", "quantile double"])
    return spark.createDataFrame([], schema)


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   method: str = "exact") -> dict[str, list[float]]:
    """Fitted statistics on the driver: ``{column: [q for each prob]}`` (small by construction)."""
    if method == "exact":
        return _ungrouped(df, numeric_columns(df, cols), [float(p) for p in probs])
    rows = quantiles_long(df, cols, probs, method).collect()
    out: dict[str, list[float]] = {}
    index = {float(p): i for i, p in enumerate(probs)}
    for r in rows:
        out.setdefault(r["feature"], [math.nan] * len(probs))[index[float(r["prob"])]] = r["quantile"]
    return out
