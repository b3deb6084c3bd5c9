"""Grouping, distinct, sort/top-k, window ranking, pivot and union.

Each operator is a thin, declarative composition of DataFrame calls so that
Catalyst keeps its optimisations: partial (map-side) aggregation before every
shuffle, ``TakeOrderedAndProject`` for sort+limit, ``WindowGroupLimit`` for
rank filters, and a pivot over listed values with no value-discovery job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def group_sum(df: DataFrame, keys: Sequence[str], value: str, alias: str, *, descending: bool = True) -> DataFrame:
    """``SUM(value) AS alias`` per key, sorted by the total.

    Hash aggregation runs partial-then-final: each task pre-aggregates its
    rows, so a hot key costs one row per task in the shuffle, not its row count.
    """
    out = df.groupBy(*keys).agg(F.sum(value).alias(alias))
    order = F.col(alias).desc() if descending else F.col(alias).asc()
    return out.orderBy(order, *_cols(keys))


def sort_spread(df: DataFrame, *order: Column | str) -> DataFrame:
    """Global ``ORDER BY`` that stays balanced when a few keys hold most rows.

    A global sort range-partitions on its keys, and every row with equal keys
    goes to the same task: a key holding a third of the rows would be sorted by
    one task.  All columns follow as tie-breakers, so range bounds fall inside
    a run of equal keys and the run is split across tasks.  The order is total
    but for equal rows, and the same on every retry.  Map columns, which have
    no order, break no ties.
    """
    ties = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return df.orderBy(*[F.col(c) if isinstance(c, str) else c for c in order], *ties)


def group_count(df: DataFrame, key: str, *, not_null: bool = True) -> DataFrame:
    """Rows per key (column ``count``)."""
    if not_null:
        df = df.where(F.col(key).isNotNull())
    return df.groupBy(key).count()


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows by ``order``: planned as ``TakeOrderedAndProject``
    (per-task top-k, then a k-row merge), never a full sort.  Give ``order``
    a total order (tie-breakers) so the k rows are well defined."""
    return df.orderBy(*order).limit(k)


def first_row(df: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """The first row by ``order`` (default: every column ascending)."""
    order = order if order is not None else [F.col(c).asc() for c in df.columns]
    return top_k(df, order, 1)


def count_distinct(df: DataFrame, column: str, alias: str) -> DataFrame:
    """Exact distinct count of non-NULL values of ``column``.

    Catalyst rewrites it as a two-level aggregate (dedupe by value, then
    count), so values are deduplicated map-side before the shuffle.
    """
    return df.select(column).where(F.col(column).isNotNull()).agg(F.count_distinct(column).alias(alias))


def distinct_values(df: DataFrame, columns: Sequence[str], *, not_null: bool = True) -> DataFrame:
    out = df.select(*columns)
    if not_null:
        cond = None
        for c in columns:
            cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
        out = out.where(cond)
    return out.distinct()


def global_stats(df: DataFrame, aggs: Mapping[str, Column]) -> DataFrame:
    """One-row summary, e.g. ``{"SumX": F.sum("x"), "AvgY": F.avg("y")}``."""
    return df.agg(*[c.alias(name) for name, c in aggs.items()])


def top_k_per_group(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Column,
    k: int,
    *,
    rank_col: str = "rank",
) -> DataFrame:
    """Rows whose ``dense_rank`` inside their group is at most ``k``.

    Ties share a rank, so a group can return more than ``k`` rows.  The
    ``rank <= k`` filter lets Spark insert a ``WindowGroupLimit`` both before
    and after the shuffle: every task keeps only its local top-k ranks per
    group (a superset of the global ones), so a hot group ships at most
    k distinct values (plus ties) per task instead of all its rows.  Spark
    adds the limit for ``k`` up to ``spark.sql.optimizer.windowGroupLimitThreshold``
    (1000 by default); for a larger ``k`` use :func:`top_values_per_group`.
    """
    w = Window.partitionBy(*partition_by).orderBy(order_by)
    return df.withColumn(rank_col, F.dense_rank().over(w)).where(F.col(rank_col) <= k)


def top_values_per_group(
    df: DataFrame,
    partition_by: Sequence[str],
    value: str,
    k: int,
    *,
    descending: bool = True,
    rank_col: str = "rank",
    parts: int = 32,
) -> DataFrame:
    """Rows whose ``dense_rank`` by ``value`` inside their group is at most ``k``, for any ``k`` and any skew.

    Ranks are ranks of distinct values, so rows take no part in the windows:
    distinct (group, value) pairs, deduplicated before the shuffle, are dealt
    over ``parts`` per group by hash of the value, and each part keeps its first
    ``k``; the at most ``parts`` x ``k`` values left of a group are ranked, and
    the first ``k`` join back to the rows.  A group with a third of all rows is
    thus ranked by many tasks; a single value that frequent is split by AQE in
    the join.  NULL groups and values count like others (NULL ranks last when
    ``descending``, first otherwise).
    """
    keys = [f"__key{i}" for i in range(len(partition_by))]
    pairs = df.select(*[F.col(f"`{c}`").alias(x) for c, x in zip(partition_by, keys)], F.col(f"`{value}`").alias("__value")).distinct()
    order = F.col("__value").desc() if descending else F.col("__value").asc()
    part = F.pmod(F.xxhash64("__value"), F.lit(parts))
    near = pairs.withColumn("__part", part)
    near = near.withColumn("__n", F.row_number().over(Window.partitionBy(*keys, "__part").orderBy(order))).where(F.col("__n") <= k)
    ranked = near.withColumn(rank_col, F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where(F.col(rank_col) <= k)
    ranks = ranked.select(*keys, "__value", rank_col)
    on = F.col(f"`{value}`").eqNullSafe(F.col("__value"))
    for c, x in zip(partition_by, keys):
        on = on & F.col(f"`{c}`").eqNullSafe(F.col(x))
    return df.join(ranks, on).select(*[F.col(f"`{c}`") for c in df.columns], rank_col)


def pivot_agg(
    df: DataFrame,
    group_by: Sequence[str],
    pivot_col: str,
    values: Mapping[str, object],
    aggs: Mapping[str, Column],
) -> DataFrame:
    """Pivot ``pivot_col`` over listed ``values`` with one or more aggregates.

    ``values`` maps an output label to the pivot value (``{"JAN": 1}``);
    output columns are ``<label>_<aggregate name>``.  Listing the values
    avoids the extra job that would find them.  Spark plans it in two
    aggregation phases: a partial + final aggregate per (group, pivot value),
    then a ``PivotFirst`` per group whose shuffle carries at most one row per
    (group, listed value), so both shuffles move pre-aggregated rows only.
    """
    labels = list(values.keys())
    raw = list(values.values())
    out = df.groupBy(*group_by).pivot(pivot_col, raw).agg(*[c.alias(n) for n, c in aggs.items()])
    renames = {}
    for label, v in zip(labels, raw):
        for name in aggs:
            spark_name = f"{v}_{name}" if len(aggs) > 1 else f"{v}"
            renames[spark_name] = f"{label}_{name}"
    return out.withColumnsRenamed(renames)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Positional UNION ALL: duplicates kept, no shuffle."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.union(d)
    return out
