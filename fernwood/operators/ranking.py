"""Exact running totals and ranks along a global order, without one big task.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row to a single
task; a ``partitionBy(class)`` window does the same for a hot class.  Here the
rows are dealt out by range over the whole order tuple (groups, then the order
columns, tie-breaker included):

1. ``repartitionByRange`` on ``(groups, order)`` cuts the global order into buckets.
   The bounds are whole tuples, so a hot group, a long common string prefix or a
   skewed number is cut like anything else; the bucket number is written with the row;
2. a window partitioned by ``(groups, bucket)`` gives the running total inside the
   bucket;
3. one row per ``(groups, bucket)`` holds the bucket's totals; their prefix sum per
   group is what the group's earlier buckets add.

The sum of (2) and (3) is exactly the running total, for any number of buckets and any
size.  Order and groups follow Spark's own rules for null and NaN, and null groups are
groups like any other.  Rows that agree on the whole order tuple share a bucket, so an
order should end with a unique column, or the caller pre-aggregates by the order columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fernwood.session import write_scratch

_B = "_fw_bucket"


def default_buckets(df: DataFrame) -> int:
    """As many buckets as the session has shuffle partitions."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def running_total(
    df: DataFrame,
    order: Sequence[tuple[str, bool]],
    sums: dict[str, str],
    group_cols: Sequence[str] = (),
    n_buckets: int | None = None,
    following: dict[str, str] | None = None,
    group_totals: dict[str, str] | None = None,
) -> DataFrame:
    """Append inclusive running sums along ``order`` within ``group_cols``.

    ``order`` is a list of ``(column, ascending)`` of any orderable types; ``sums`` maps
    output column name to the column being summed.  The order should be total (add a
    unique tie-breaker) when the caller needs row ranks.  ``following`` maps an output name to
    a column of the next row of the group (null for its last row): inside a bucket by a window,
    across buckets by the next bucket's first row.  ``group_totals`` maps an output name to a
    column summed over the whole group.
    """
    following, group_totals = following or {}, group_totals or {}
    n_buckets = n_buckets or default_buckets(df)
    by = [F.col(c).asc() if asc else F.col(c).desc() for c, asc in order]
    groups = list(group_cols)
    data = write_scratch(
        df.repartitionByRange(n_buckets, *[F.col(g).asc() for g in groups], *by)
        .withColumn(_B, F.spark_partition_id()), "ranked")

    inner = Window.partitionBy(*groups, _B).orderBy(*by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = data.withColumns({out: F.sum(src).over(inner) for out, src in sums.items()})
    firsts, nexts = [], []
    if following:
        plain = Window.partitionBy(*groups, _B).orderBy(*by)
        pack = F.struct(*[F.col(src).alias(out) for out, src in following.items()])
        rows = rows.withColumns({"_fw_next": F.lead(pack).over(plain), "_fw_rn": F.row_number().over(plain)})
        firsts = [F.max(F.when(F.col("_fw_rn") == 1, pack)).alias("_fw_first")]
        nexts = [F.lead("_fw_first").over(Window.partitionBy(*(groups or [F.lit(0)])).orderBy(_B)).alias("_fw_after")]

    # at most one row per group and bucket it touches: groups + buckets rows in all
    totals = (rows if following else data).groupBy(*groups, _B).agg(
        *[F.sum(src).alias(f"_fw_{out}") for out, src in {**sums, **group_totals}.items()], *firsts)
    whole = Window.partitionBy(*(groups or [F.lit(0)]))
    before = whole.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_fw_g{i}") for i, g in enumerate(groups)], F.col(_B).alias("_fw_b"),
        *[F.coalesce(F.sum(f"_fw_{out}").over(before), F.lit(0)).alias(f"_fw_{out}") for out in sums],
        *[F.sum(f"_fw_{out}").over(whole).alias(f"_fw_{out}") for out in group_totals], *nexts)
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_fw_g{i}")) for i, g in enumerate(groups)],
                  F.col(_B) == F.col("_fw_b"))
    joined = rows.join(offsets, same, "inner")
    after = F.coalesce("_fw_next", "_fw_after") if following else None
    return joined.withColumns(
        {out: F.coalesce(out, F.lit(0)) + F.col(f"_fw_{out}") for out in sums}
        | {out: after[out] for out in following} | {out: F.col(f"_fw_{out}") for out in group_totals}).select(
        *df.columns, *sums, *following, *group_totals)


def global_rank(
    df: DataFrame,
    order: Sequence[tuple[str, bool]],
    group_cols: Sequence[str] = (),
    out: str = "rank",
    n_buckets: int | None = None,
) -> DataFrame:
    """1-based ``row_number`` along a total ``order`` within ``group_cols``, exact."""
    ones = df.withColumn("_fw_one", F.lit(1).cast("long"))
    ranked = running_total(ones, order, {out: "_fw_one"}, group_cols, n_buckets)
    return ranked.drop("_fw_one")
