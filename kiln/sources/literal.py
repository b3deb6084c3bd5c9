"""In-code rows and generated rows."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

# Alphabet for generated user names and the name prefix.
NAME_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
NAME_PREFIX = "user-"
NAME_LENGTH = 5
USAGE_RANGE = 1000
# Multipliers of the per-character position rule.
_CHAR_STEPS = (31, 37, 41, 43, 47)
_USAGE_STEP = 7919


def literal_rows(spark: SparkSession, rows: Iterable[Sequence], schema: StructType) -> DataFrame:
    """A table from in-code rows.  Meant for small, bounded row sets.

    The rows become one literal array of structs expanded with ``inline`` on
    a one-row range, so the relation lives in the plan: no Python worker is
    started on executors to decode pickled rows.
    """
    rows = list(rows)
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [
        F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(row, schema.fields, strict=True)])
        for row in rows
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))


def _literal(value, data_type) -> Column:
    """A typed literal.  A wall-clock (``timestamp_ntz``) value goes in as ISO
    text: ``lit(datetime)`` would read it in the driver's local time zone."""
    if isinstance(value, _dt.datetime) and isinstance(data_type, TimestampNTZType):
        return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast(data_type)
    return F.lit(value).cast(data_type)


def _name_char(uid: Column, step: int, seed: int, i: int) -> Column:
    pos = F.pmod(uid * F.lit(step) + F.lit(seed + 13 * i), F.lit(len(NAME_ALPHABET))) + F.lit(1)
    return F.substring(F.lit(NAME_ALPHABET), pos.cast("int"), F.lit(1))


def synthetic_usage(ids: DataFrame, id_col: str = "id", *, seed: int = 42) -> DataFrame:
    """Usage rows ``(uid, uname, usage)`` for every id in ``ids``.

    Values are a deterministic function of (id, seed), computed per row on the
    executors, so the generator scales out with the id column (for a bare
    count use ``spark.range(n)`` as ``ids``).  ``usage`` falls in
    ``[0, USAGE_RANGE)`` and ``uname`` is ``NAME_PREFIX`` plus
    ``NAME_LENGTH`` alphanumeric characters.
    """
    uid = F.col(id_col)
    chars = [_name_char(uid, step, seed, i) for i, step in enumerate(_CHAR_STEPS[:NAME_LENGTH])]
    usage = F.pmod(uid * F.lit(_USAGE_STEP) + F.lit(seed * 31), F.lit(USAGE_RANGE)).cast("int")
    return ids.select(
        uid.alias("uid"),
        F.concat(F.lit(NAME_PREFIX), *chars).alias("uname"),
        usage.alias("usage"),
    )
