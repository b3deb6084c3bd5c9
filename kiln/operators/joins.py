"""Equi-joins: fact-to-dimension and key joins.

No side is hinted: the planner broadcasts a side whose size it knows to be
below ``spark.sql.autoBroadcastJoinThreshold``, and AQE turns a sort-merge
join into a broadcast join when a shuffled side proves that small, or splits
its skewed partitions.  Building a join starts no job.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, on: Column, *, how: str = "inner") -> DataFrame:
    """Join a fact table to a dimension.

    ``dim`` is usually aliased by the caller (``dim.alias("n")``) so the
    select after the join can name ``n.col``.
    """
    return fact.join(dim, on, how)


def join_on_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str, *, how: str = "inner") -> DataFrame:
    """Equi-join on two differently named keys.

    When neither side is small the planner uses a sort-merge join (both sides
    shuffled on the key); inputs written bucketed on the key (see
    :func:`kiln.sources.files.write_sorted_parquet`) join with no shuffle.
    """
    return left.join(right, F.col(left_key) == F.col(right_key), how)


@contextmanager
def cached(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep frames cached for the actions inside the block; they are released at its end."""
    kept = tuple(f.persist() for f in frames)
    try:
        yield kept
    finally:
        for f in kept:
            f.unpersist()
