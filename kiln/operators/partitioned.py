"""Update, delete and merge that rewrite only the partitions they touch.

The table is a directory of Parquet files partitioned by one or more columns.
Each change finds the partitions with rows to change in a scan of the key and
predicate columns, reads those partitions alone, and writes them back with
Spark's dynamic partition overwrite; files of all other partitions stay as they
are.  Rows that move to another partition touch that one too.  A partition that
is left without rows is removed.

What comes to the driver is one line per touched partition, less than the list
of files that Spark's own reader keeps there.

Each partition is replaced by Spark's commit protocol, one after another: a run
that dies in between is completed by running it again.  Delete and merge may be
run any number of times; an update may where its condition does not hold for
the values it sets.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kiln import paths
from kiln.operators import tables


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], *, mode: str = "errorifexists") -> str:
    """Parquet partitioned by columns; rows are gathered by partition, and a partition with many rows is dealt over tasks."""
    _spread(df, partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path


def read_partitioned(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table with declared types, partition columns included, in the schema's order."""
    return spark.read.schema(schema).parquet(path).select(*[f"`{f.name}`" for f in schema.fields])


def _spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])  # AQE splits large partitions, joins small ones


def _among(cols: Sequence[str], parts: Iterable[tuple]) -> Column:
    """Whether the partition columns are one of ``parts``: known while planning, so other partitions are not listed or read."""
    same = [functools.reduce(operator.and_, [F.col(f"`{c}`").eqNullSafe(F.lit(v)) for c, v in zip(cols, p)]) for p in parts]
    return functools.reduce(operator.or_, same, F.lit(False))


def _replace(spark: SparkSession, path: str, rows: DataFrame, partition_by: Sequence[str], emptied: Iterable[str]) -> None:
    """Put ``rows`` in place of the partitions that they belong to, and remove the directories ``emptied``."""
    out = _spread(rows, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy(*partition_by).parquet(path)
    for folder in emptied:
        paths.delete(spark, folder)


def _moves(rows: DataFrame, partition_by: Sequence[str], changed: Column, to: Sequence[Column | None]) -> list[Row]:
    """Per partition with a change: where its rows go, as (was, folder, changed, stays, now)."""
    was = F.struct(*[F.col(f"`{c}`").alias(c) for c in partition_by]).alias("was")
    now = F.struct(*[(F.lit(None) if x is None else x).alias(c) for c, x in zip(partition_by, to)])
    stays = F.lit(False) if to[0] is None else F.lit(True)
    each = rows.select(
        was,
        F.col("_metadata.file_path").alias("file"),
        changed.alias("changed"),
        (~changed | stays).alias("stays"),
        F.when(changed & stays, now).alias("now"),
    )
    moves = each.groupBy("was", "changed", "stays", "now").agg(F.min("file").alias("file"))
    return moves.collect()  # at most partitions x partitions that rows move between


def _touched(spark: SparkSession, moves: list[Row], arriving: Iterable[tuple] = ()) -> tuple[set[tuple], list[str]]:
    """Partitions to rewrite, and the folders of those that no row stays in or comes to."""
    arriving = set(arriving) | {tuple(m["now"]) for m in moves if m["now"] is not None}
    left = {tuple(m["was"]) for m in moves if m["changed"]}
    touched = left | arriving
    kept = arriving | {tuple(m["was"]) for m in moves if not m["changed"]}
    return touched, sorted({paths.of_uri(spark, m["file"]).rsplit("/", 1)[0] for m in moves if tuple(m["was"]) in left - kept})


def update_files(
    spark: SparkSession, path: str, schema: StructType, condition: Column | str, values: Mapping[str, Column], partition_by: Sequence[str]
) -> int:
    """:func:`tables.update` in place; the number of partitions written.  Rows whose partition column is set move."""
    table = spark.read.schema(schema).parquet(path)
    cond = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
    to = [values[c].cast(schema[c].dataType) if c in values else F.col(f"`{c}`") for c in partition_by]
    touched, emptied = _touched(spark, _moves(table, partition_by, cond, to))
    if touched:
        part = read_partitioned(spark, path, schema).where(_among(partition_by, touched))
        _replace(spark, path, tables.update(part, cond, values), partition_by, emptied)
    return len(touched)


def delete_files(spark: SparkSession, path: str, schema: StructType, condition: Column | str, partition_by: Sequence[str]) -> int:
    """:func:`tables.delete` in place; the number of partitions that had rows to delete."""
    table = spark.read.schema(schema).parquet(path)
    cond = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
    touched, emptied = _touched(spark, _moves(table, partition_by, cond, [None] * len(partition_by)))
    if touched:
        part = read_partitioned(spark, path, schema).where(_among(partition_by, touched))
        _replace(spark, path, tables.delete(part, cond), partition_by, emptied)
    return len(touched)


def merge_files(spark: SparkSession, path: str, schema: StructType, source: DataFrame, key: str, partition_by: Sequence[str], *, evolve: bool = False) -> StructType:
    """:func:`tables.merge` in place; returns the schema to read the table with.

    Touched are the partitions that hold a key of the source and those that
    source rows belong to.  Where the key is a partition column, only the
    partitions of the source's keys are read at all.  The source must have the
    partition columns.
    """
    tables.check_schema(schema, source.schema, evolve)
    missing = [c for c in partition_by if c not in source.columns]
    if missing:
        raise tables.SchemaMismatchError(f"the source lacks the partition columns {missing}")
    schema = tables._union(spark, schema, source.schema)
    cols = [F.col(f"`{c}`") for c in partition_by]
    arriving = [tuple(r) for r in source.select(*cols).distinct().collect()]  # partitions of the new table
    table = spark.read.schema(schema).parquet(path)
    if key in partition_by:
        table = table.where(_among(partition_by, arriving)) if list(partition_by) == [key] else table.where(F.col(f"`{key}`").isin([p[list(partition_by).index(key)] for p in arriving]))
    keyed = table.select(*dict.fromkeys([key, *partition_by]), "_metadata")
    known = source.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("__key")).distinct()
    found = keyed.join(known, F.col(f"`{key}`") == F.col("__key"), "left")
    # a matched row goes where its source row belongs, which is among `arriving`
    hit = F.col("__key").isNotNull()
    moves = _moves(found, partition_by, hit, [None] * len(partition_by))
    touched, emptied = _touched(spark, moves, arriving)
    if touched:
        part = read_partitioned(spark, path, schema).where(_among(partition_by, touched))
        _replace(spark, path, tables.merge(part, source, key), partition_by, emptied)
    return schema
