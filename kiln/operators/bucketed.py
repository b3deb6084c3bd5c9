"""Equi-join of two large tables through bucketed copies, whatever the skew of their keys.

Buckets spare later joins their shuffle, but a bucket holds all rows of its
keys, so a key with a third of the rows makes one task's work.  Here the number
of buckets follows from the number of rows, and keys above a share of the rows
are taken out first: few by definition, they are joined apart, the side with
more rows of them dealt over ``COPIES`` parts and the other side copied to each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a bucket, about, and the share of all rows above which a key is hot.
ROWS_PER_BUCKET = 1 << 20
HOT_SHARE = 1 / 256
COPIES = 32


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, least: int = 1000) -> tuple[dict, int]:
    """Keys (and their rows) that hold more than ``share`` of the rows with a key, and the number of those rows.

    There are at most 1 / share such keys, whatever the table; keys with at most
    ``least`` rows are never hot.
    """
    keyed = df.where(F.col(f"`{key}`").isNotNull())
    total = keyed.count()
    counts = keyed.groupBy(F.col(f"`{key}`").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") > max(least, total * share)).collect()
    return {r["k"]: r["n"] for r in hot}, total


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """A power of two, so that tables of other sizes share a multiple."""
    return 1 << max(0, -(-rows // rows_per_bucket) - 1).bit_length()


def _in(c: Column, keys) -> Column:
    return c.isin(list(keys)) if keys else F.lit(False)


def _write(df: DataFrame, key: str, buckets: int, path: str) -> str:
    name = f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, F.col(f"`{key}`"))  # one file per bucket
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return name


def _join_hot(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_is_large: bool, copies: int) -> DataFrame:
    """Rows of the large side are dealt out evenly over ``copies`` parts; the other side's are in each part."""
    names = left.columns, right.columns
    part = F.pmod(F.monotonically_increasing_id(), F.lit(copies)).cast("int").alias("__part")
    every = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("__other")
    if left_is_large:
        left, right = left.select("*", part), right.select("*", every)
    else:
        left, right = left.select("*", every), right.select("*", part)
    on = (F.col(left_key) == F.col(right_key)) & (F.col("__part") == F.col("__other"))
    return left.join(right, on).select(*names[0], *names[1])


@contextmanager
def bucketed_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    path: str,
    *,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    hot_share: float = HOT_SHARE,
    least_hot: int = 1000,
    copies: int = COPIES,
) -> Iterator[DataFrame]:
    """Inner join of two tables with different column names, for the actions inside the block.

    Copies without the hot keys are bucketed under ``path`` and joined without
    another shuffle; they can serve several actions.  When the block ends, the
    catalogue no longer knows them; their files belong to the caller.  NULL keys
    match nothing and are left out.
    """
    spark = left.sparkSession
    left, right = left.where(F.col(f"`{left_key}`").isNotNull()), right.where(F.col(f"`{right_key}`").isNotNull())
    hot_l, n_l = hot_keys(left, left_key, hot_share, least_hot)
    hot_r, n_r = hot_keys(right, right_key, hot_share, least_hot)
    hot = {*hot_l, *hot_r}
    buckets = bucket_count(max(n_l, n_r), rows_per_bucket)
    names = []
    try:
        for df, key, side in ((left, left_key, "left"), (right, right_key, "right")):
            names.append(_write(df.where(~_in(F.col(f"`{key}`"), hot)), key, buckets, f"{path}/{side}"))
        joined = spark.table(names[0]).join(spark.table(names[1]), F.col(left_key) == F.col(right_key))
        if hot:
            apart = left.where(_in(F.col(f"`{left_key}`"), hot)), right.where(_in(F.col(f"`{right_key}`"), hot))
            joined = joined.unionByName(_join_hot(*apart, left_key, right_key, sum(hot_l.values()) >= sum(hot_r.values()), copies))
        yield joined
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
