"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import importlib
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint under the shared folder.

    Later jobs read the stored rows, so an executor that is lost costs only its
    running tasks, and a plan that uses the rows twice computes them once.
    Spark deletes the files once the frame is garbage, where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    shared_dir(df.sparkSession)  # registers a checkpoint dir where the session has none
    return df.checkpoint(eager=True)


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, or a variant of it that no column of ``frames`` bears."""
    taken = {c.lower() for f in frames for c in f.columns}
    out, i = name, 0
    while out.lower() in taken:
        i += 1
        out = f"{name}_{i}"
    return out


def text_or_empty(col: str):
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where the driver found it.

    Functions of an importable module are pickled by name, so a worker needs
    the package too.  On a cluster it is installed or sent with ``--py-files``;
    pickling by value below makes the operators work without either.
    """
    from pyspark import cloudpickle

    for name in list(sys.modules):
        if name == __package__ or name.startswith(__package__ + "."):
            cloudpickle.register_pickle_by_value(importlib.import_module(name))


#: Bytes of an Arrow batch.  Spark's default is ten thousand rows or 64 MB, held by the JVM and a worker for each of
#: an executor's tasks.
BATCH_BYTES = "4m"
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, in a session that leaves Spark's default; long rows still come whole."""
    if spark.conf.get(_BATCH_KEY, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, BATCH_BYTES)


def by_value(fn):
    """Decorator for operators that run Python on the executors."""

    @functools.wraps(fn)
    def wrapped(df, *args, **kwargs):
        ship_package(df.sparkSession)
        bound_batches(df.sparkSession)
        return fn(df, *args, **kwargs)

    return wrapped
