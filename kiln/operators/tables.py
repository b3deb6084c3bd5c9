"""Append, update, delete and merge as plain DataFrame functions over Parquet directories.

A table is a directory of Parquet files read with a declared schema.  An
append adds files to it after a check against the schema that its files hold;
update, delete and merge return the new rows, which the caller writes to a
fresh directory (the directory is the unit that readers switch to), or, for a
partitioned directory, :mod:`kiln.operators.partitioned` puts in place of the
partitions they touch.  There is no log, no file list and nothing is
collected: every function is one declarative plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from kiln import paths

#: Where Spark's file sink records its files; a read of such a directory sees no others.
SINK_LOG = "_spark_metadata"


class SchemaMismatchError(ValueError):
    """Rows that do not fit the table's schema."""


def _fits(have: DataType, new: DataType, evolve: bool) -> bool:
    """Same type, whatever may be null; with ``evolve`` a struct may gain fields."""
    if isinstance(have, StructType) and isinstance(new, StructType):
        known = {f.name: f.dataType for f in have.fields}
        extra = [f.name for f in new.fields if f.name not in known]
        if extra and not evolve or _case_clashes(have, new):
            return False
        return all(_fits(known[f.name], f.dataType, evolve) for f in new.fields if f.name in known)
    if isinstance(have, ArrayType) and isinstance(new, ArrayType):
        return _fits(have.elementType, new.elementType, evolve)
    if isinstance(have, MapType) and isinstance(new, MapType):
        return _fits(have.keyType, new.keyType, evolve) and _fits(have.valueType, new.valueType, evolve)
    return type(have) is type(new) and have.simpleString() == new.simpleString()


def _case_clashes(have: StructType, new: StructType) -> list[str]:
    """Names of ``new`` that equal another name of either schema but for case: Spark would read them as one column."""
    spelled: dict[str, set[str]] = {}
    for f in (*have.fields, *new.fields):
        spelled.setdefault(f.name.lower(), set()).add(f.name)
    names = [f.name for f in new.fields]
    return [n for n in names if len(spelled[n.lower()]) > 1 or names.count(n) > 1]


def check_schema(schema: StructType, rows: StructType, evolve: bool = False) -> None:
    """Raise where ``rows`` cannot be appended to a table of ``schema``; names are compared without case, and must agree in it."""
    clashes = _case_clashes(schema, rows)
    if clashes:
        raise SchemaMismatchError(f"columns {clashes} equal another column but for case")
    known = {f.name: f.dataType for f in schema.fields}
    extra = [f.name for f in rows.fields if f.name not in known]
    if extra and not evolve:
        raise SchemaMismatchError(f"columns {extra} are not in the table")
    changed = [f.name for f in rows.fields if f.name in known and not _fits(known[f.name], f.dataType, evolve)]
    if changed:
        raise SchemaMismatchError(f"columns {changed} have another type in the table")


def stored_schema(spark: SparkSession, *places: str) -> StructType | None:
    """The schema that the files at ``places`` hold together, from their footers; ``None`` where there are no files.

    Spark reads the footers in one distributed job.  Files that disagree on a
    column's type raise :class:`SchemaMismatchError`.
    """
    try:
        return spark.read.option("mergeSchema", "true").parquet(*places).schema
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" in str(e):
            raise SchemaMismatchError(f"files disagree: {e}") from e
        raise


def _union(spark: SparkSession, *schemas: StructType) -> StructType:
    """All columns of the schemas, in order of appearance."""
    out = spark.createDataFrame([], schemas[0])
    for s in schemas[1:]:
        out = out.unionByName(spark.createDataFrame([], s), allowMissingColumns=True)
    return out.schema


def append(table: DataFrame, rows: DataFrame, *, evolve: bool = False) -> DataFrame:
    """The table's rows and the new ones; columns that one side lacks are NULL there."""
    check_schema(table.schema, rows.schema, evolve)
    return table.unionByName(rows, allowMissingColumns=True)


def append_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    rows: DataFrame,
    *,
    evolve: bool = False,
    partition_by: Sequence[str] = (),
) -> StructType:
    """Add ``rows`` to the directory at ``path`` and return the schema to read it with.

    ``schema`` is what the caller takes the table for.  It and ``rows`` are held
    against what the files themselves say, so a stale or wrong ``schema`` cannot
    let a column of another type, or one that differs by case only, into the
    directory.  Files written before a column was added simply lack it and read
    as NULL; columns that others added are part of the schema returned.
    """
    if paths.exists(spark, f"{path}/{SINK_LOG}"):
        raise ValueError(f"{path} belongs to a stream's file sink, whose readers see no other files; use kiln.streaming.stream_into_table")
    stored = stored_schema(spark, path)
    if stored is not None:
        check_schema(stored, schema, evolve=True)
        schema = _union(spark, schema, stored)
    check_schema(schema, rows.schema, evolve)
    merged = _union(spark, schema, rows.schema)
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)
    return merged


def update(table: DataFrame, condition: Column | str, values: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition holds; where it is NULL the row stays as it is."""
    cond = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
    return table.withColumns(
        {c: F.when(cond, v.cast(table.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()}
    )


def delete(table: DataFrame, condition: Column | str) -> DataFrame:
    """The rows where the condition does not hold or is NULL."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return table.where(~F.coalesce(cond, F.lit(False)))


def source_per_key(source: DataFrame, key: str) -> DataFrame:
    """(key, __row, __rows): one source row per non-NULL key and how many there are."""
    row = F.struct(*[F.col(f"`{c}`") for c in source.columns])
    found = source.where(F.col(key).isNotNull()).groupBy(key)
    return found.agg(F.first(row).alias("__row"), F.count(F.lit(1)).alias("__rows"))


def merge(table: DataFrame, source: DataFrame, key: str, *, evolve: bool = False) -> DataFrame:
    """Upsert: rows of ``table`` whose key the source has take its values, all other source rows are inserted.

    A matched row keeps the values of columns that the source lacks; inserted
    rows have NULL there.  A source column of another type, or (but with
    ``evolve``) one that the table lacks, raises :class:`SchemaMismatchError`.
    NULL keys never match.  Two source rows for one row of the table fail the
    job that reads the result: the check is part of its plan.
    """
    check_schema(table.schema, source.schema, evolve)
    given = set(source.columns)
    clash = F.raise_error(F.concat(F.lit(f"several source rows for {key} "), F.col(f"`{key}`").cast("string")))
    new = F.when(F.col("__rows") > 1, clash.cast(source.select(F.struct("*").alias("r")).schema["r"].dataType)).otherwise(F.col("__row"))
    both = table.join(source_per_key(source, key), key, "left").withColumn("__new", new)
    hit = F.col("__rows").isNotNull()
    cols = [F.when(hit, F.col(f"__new.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c) if c in given else F.col(f"`{c}`") for c in table.columns]
    cols += [F.col(f"__new.`{c}`").alias(c) for c in source.columns if c not in table.columns]
    inserted = source.join(table.select(key), key, "left_anti").select(*source.columns)
    return both.select(*cols).unionByName(inserted, allowMissingColumns=True)
