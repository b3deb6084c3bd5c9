"""File readers and writers: CSV, TSV, JSON lines and Parquet.

Schema handling comes in four forms: inferred from the data, declared up
front, all-string text cast afterwards, and stored with Parquet files.

Casts and timestamp parsing use the ``try_`` forms so malformed text becomes
NULL instead of failing the job (Spark 4 runs with ANSI mode on).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, StringType, StructField, StructType

from kiln.operators.relational import sort_spread

# Fixed value: timestamp text keeps microseconds so a text round trip is exact.
TS_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

_TEXT_TS_OPTIONS = {"timestampNTZFormat": TS_TEXT_FORMAT, "timestampFormat": TS_TEXT_FORMAT}


# ---------------------------------------------------------------- readers


def read_csv_inferred(
    spark: SparkSession, path: str, *, sep: str = ",", sampling_ratio: float = 1.0, via_format: bool = False
) -> DataFrame:
    """CSV with a header row and inferred column types.

    Inference is an extra pass over the whole input; for large inputs declare
    the schema instead.  A ``sampling_ratio`` below 1 loses values: a cell that
    does not fit the type seen in the sample reads as NULL.  ``via_format`` spells the read as
    ``format("csv").load(path)``; the result is the same.
    """
    opts = {"header": "true", "inferSchema": "true", "sep": sep, "samplingRatio": str(sampling_ratio)}
    opts.update(_TEXT_TS_OPTIONS)
    if via_format:
        return spark.read.format("csv").options(**opts).load(path)
    return spark.read.options(**opts).csv(path)


def read_csv_declared(spark: SparkSession, path: str, schema: StructType, *, sep: str = ",") -> DataFrame:
    """CSV with a declared schema; a cell that does not fit its type is NULL."""
    opts = {"header": "true", "sep": sep, "mode": "PERMISSIVE"}
    opts.update(_TEXT_TS_OPTIONS)
    return spark.read.schema(schema).options(**opts).csv(path)


def split_csv(
    spark: SparkSession, path: str, schema: StructType, out: str, *, sep: str = ",", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """CSV with a declared schema, parted into typed rows and rejected lines.

    A line with a cell that does not fit its type, or with more or fewer cells
    than columns, is rejected as it stands (columns ``line`` and ``file``); every
    other line is a typed row.  One scan parses and writes both parts under
    ``out``, which is new, so each line is parsed once and lands in exactly one
    part.  Empty lines hold no record and are in neither.
    """
    line = "line"
    while line in schema.names:
        line = f"_{line}"
    whole = StructType([*schema.fields, StructField(line, StringType())])
    opts = {"header": str(header).lower(), "sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": line, **_TEXT_TS_OPTIONS}
    rows = spark.read.schema(whole).options(**opts).csv(path)
    rows = rows.select("*", F.col(f"`{line}`").isNotNull().alias("_rejected"), F.col("_metadata.file_path").alias("_file"))
    rows.write.partitionBy("_rejected").parquet(out)
    stored = StructType([*whole.fields, StructField("_file", StringType()), StructField("_rejected", BooleanType())])
    back = spark.read.schema(stored).parquet(out)
    good = back.where(~F.col("_rejected")).select(*[F.col(f"`{c}`") for c in schema.names])
    bad = back.where(F.col("_rejected")).select(F.col(f"`{line}`").alias("line"), F.col("_file").alias("file"))
    return good, bad


def read_csv_text(spark: SparkSession, path: str, *, sep: str = ",") -> DataFrame:
    """CSV read with the header only: every column is a string."""
    return spark.read.options(header="true", sep=sep).csv(path)


def read_tsv_inferred(spark: SparkSession, path: str, *, sampling_ratio: float = 1.0) -> DataFrame:
    """Tab-delimited text with a header and inferred types."""
    return read_csv_inferred(spark, path, sep="\t", sampling_ratio=sampling_ratio)


def read_json(
    spark: SparkSession, path: str, schema: StructType | None = None, *, via_format: bool = False
) -> DataFrame:
    """JSON lines; inferred (columns come out in name order) or declared."""
    reader = spark.read.options(**_TEXT_TS_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    if via_format:
        return reader.format("json").load(path)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str, *, via_format: bool = False) -> DataFrame:
    if via_format:
        return spark.read.format("parquet").load(path)
    return spark.read.parquet(path)


def cast_columns(df: DataFrame, types: Mapping[str, str | DataType]) -> DataFrame:
    """Tolerant casts: a value that does not convert becomes NULL."""
    return df.withColumns({name: try_cast(F.col(name), t) for name, t in types.items()})


def try_cast(c: Column, t: str | DataType) -> Column:
    type_name = t if isinstance(t, str) else t.simpleString()
    return c.try_cast(type_name)


def shape_like(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema``'s columns, in its order.

    Used after an inferring read (inference narrows ``bigint`` to ``int`` and
    reads timestamp text as zoned timestamps) to get the declared shape back.
    """
    return df.select(*[try_cast(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


# ---------------------------------------------------------------- writers


def write_csv(df: DataFrame, path: str, *, sep: str = ",", mode: str = "overwrite") -> str:
    df.write.mode(mode).options(header="true", sep=sep, **_TEXT_TS_OPTIONS).csv(path)
    return path


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    df.write.mode(mode).options(**_TEXT_TS_OPTIONS).json(path)
    return path


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_sorted_parquet(
    df: DataFrame,
    path: str,
    key: str,
    *,
    mode: str = "overwrite",
    buckets: int | None = None,
    table_name: str | None = None,
) -> str:
    """Parquet sorted by ``key``.

    Without ``buckets`` the data is range-partitioned and sorted globally,
    so each file holds a contiguous key range and min/max statistics let later
    scans skip files.  All columns break ties
    (:func:`kiln.operators.relational.sort_spread`), so a key holding a third
    of the rows is written by many tasks, not one.  With ``buckets`` the rows
    are hash-bucketed by ``key`` and sorted inside each bucket, and the output
    is registered as ``table_name`` in the session catalog: two tables
    bucketed the same way on the join key join without any shuffle.  A hot
    key makes its bucket large, so bucket only on keys without heavy skew;
    otherwise the sort-merge join with AQE's skew split is the better plan.
    """
    if buckets is None:
        sort_spread(df, F.col(key).asc()).write.mode(mode).parquet(path)
        return path
    if not table_name:
        raise ValueError("a bucketed write needs a table_name")
    (
        df.write.mode(mode)
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table_name)
    )
    return path
