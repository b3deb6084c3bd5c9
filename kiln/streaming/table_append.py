"""File-source stream into a directory of Parquet files that batch code writes too.

Spark's file sink keeps a log in its output directory, and a read of that
directory sees the logged files only.  Here a batch is written by
``foreachBatch`` instead: into a folder of its own batch number, out of readers'
sight, whose files then move into the table under names that carry the batch.
A batch that runs again replaces its own files, and one that was published as a
whole is left alone, so a retry adds nothing; appends, updates and plain reads
of the directory need to know nothing of the stream.

The stream itself carries only the names of arriving files.  Each batch holds
the footers of its files against the table's schema: a file with an unknown
column, or a column of another type, is kept out of the table, and its rows go,
with all their columns, to a quarantine directory.  Nothing is dropped.

A bounded run ends between batches: once its time is over, the running batch is
published and the next one stops before it writes.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from kiln import paths
from kiln.operators.tables import SINK_LOG, SchemaMismatchError, check_schema, stored_schema
from kiln.streaming.file_append import DEFAULT_TRIGGER, file_stream, run_for

#: Files of one batch, so also the length of the list of names that the driver holds.
MAX_FILES = 1000
_ENDED = "the run's time is over; this batch waits for the next run"
_DONE = "_PUBLISHED"


def drifting_files(spark: SparkSession, files: Sequence[str], schema: StructType) -> list[str]:
    """The files whose own schema has a column that ``schema`` lacks, or has with another type.

    Footers are read by Spark, many files in one job; a set with such a file is
    halved until the file stands alone, so few drifting files cost few jobs.
    Names that differ in case only are kept apart: merged without case, a file's
    would be lost if another file came first.
    """
    apart = spark.newSession()
    apart.conf.set("spark.sql.caseSensitive", "true")
    try:
        stored = stored_schema(apart, *files) if files else None
        if stored is not None:
            check_schema(schema, stored)
        return []
    except SchemaMismatchError:
        if len(files) == 1:
            return list(files)
    half = len(files) // 2
    return drifting_files(spark, files[:half], schema) + drifting_files(spark, files[half:], schema)


def publish(spark: SparkSession, staging: str, table_dir: str, prefix: str, levels: int) -> None:
    """Move the files of a batch from its folder into the table, in place of any that an earlier try had moved."""
    below = "/*" * levels
    for old in paths.glob(spark, f"{table_dir}{below}/{prefix}-*.parquet"):
        paths.delete(spark, old)
    for i, f in enumerate(paths.glob(spark, f"{staging}{below}/part-*")):
        where = "/".join(f.rsplit("/", levels + 1)[1:-1])  # partition directories, if any
        paths.move(spark, f, "/".join(filter(None, (table_dir, where, f"{prefix}-{i:05d}.parquet"))))


class _Batches:
    """What a batch of the stream does; ``closed`` ends the run before the next one."""

    def __init__(self, source_dir, schema, table_dir, checkpoint_dir, quarantine_dir, partition_by):
        self.schema, self.table_dir, self.checkpoint_dir = schema, table_dir, checkpoint_dir
        self.quarantine_dir, self.partition_by = quarantine_dir, list(partition_by)
        self.source = hashlib.sha256(source_dir.rstrip("/").encode()).hexdigest()[:8]
        self.closed = False

    def stream_id(self, spark: SparkSession) -> str | None:
        """The identity that Spark stores with the checkpoint; ``None`` before the first start."""
        if not paths.exists(spark, f"{self.checkpoint_dir}/metadata"):
            return None
        line = spark.read.text(f"{self.checkpoint_dir}/metadata").first()[0]
        return f"{self.source}-{json.loads(line)['id'].replace('-', '')[:16]}"

    def refuse_second_copy(self, spark: SparkSession) -> None:
        own = self.stream_id(spark)
        others = [f.rsplit("/", 1)[1] for f in paths.glob(spark, f"{self.table_dir}/_stream/{self.source}-*")]
        if any(o != own for o in others):
            raise ValueError(f"{self.table_dir} has this source's files from another checkpoint; a new one would add them again")

    def __call__(self, names: DataFrame, batch: int) -> None:
        if self.closed:
            raise RuntimeError(_ENDED)
        spark = names.sparkSession
        stream = self.stream_id(spark)
        folder = f"{self.table_dir}/_stream/{stream}"
        if paths.exists(spark, f"{folder}/{batch}/{_DONE}"):
            return  # published before the stream could note it
        files = sorted(paths.of_uri(spark, r[0]) for r in names.distinct().collect())  # at most the files of a batch
        bad = drifting_files(spark, files, self.schema)
        for i, f in enumerate(bad):
            spark.read.parquet(f).withColumn("arrived_as", F.lit(f)).write.mode("overwrite").parquet(f"{self.quarantine_dir}/{stream}/{batch}/{i}")
        good = [f for f in files if f not in set(bad)]
        if good:
            rows = spark.read.schema(self.schema).parquet(*good)
            rows.write.mode("overwrite").partitionBy(*self.partition_by).parquet(f"{folder}/{batch}")
            publish(spark, f"{folder}/{batch}", self.table_dir, f"stream-{stream}-{batch}", len(self.partition_by))
        paths.touch(spark, f"{folder}/{batch}/{_DONE}")
        for old in paths.glob(spark, f"{folder}/*"):  # only the last batch can run again
            if int(old.rsplit("/", 1)[1]) < batch:
                paths.delete(spark, old)


def stream_into_table(
    spark: SparkSession,
    source_dir: str,
    schema: StructType | str,
    table_dir: str,
    checkpoint_dir: str,
    *,
    quarantine_dir: str | None = None,
    partition_by: Sequence[str] = (),
    available_now: bool = True,
    trigger: str = DEFAULT_TRIGGER,
    run_seconds: float | None = None,
    max_files_per_trigger: int = MAX_FILES,
) -> None:
    """Stream the files that arrive in ``source_dir`` into the table; raises what a batch failed with.

    The table may hold rows already and may be appended to, updated or read by
    others between and after runs.  ``schema`` is the table's, partition columns
    included.  A checkpoint belongs to one source and table; a second checkpoint
    on the same pair is refused, since it would add the source's rows again.
    Files without rows add nothing; missing columns read as NULL.  Files of
    another schema go to ``quarantine_dir`` (default: below the table, where
    readers of the table do not look), one folder each.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if paths.exists(spark, f"{table_dir}/{SINK_LOG}"):
        raise ValueError(f"{table_dir} belongs to a stream's file sink, whose readers see no other files")
    batches = _Batches(source_dir, schema, table_dir, checkpoint_dir, quarantine_dir or f"{table_dir}/_quarantine", partition_by)
    batches.refuse_second_copy(spark)
    names = file_stream(spark, source_dir, schema, max_files_per_trigger=max_files_per_trigger).select("_metadata.file_path")
    writer = names.writeStream.foreachBatch(batches).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    _run(writer.start(), batches, None if available_now else run_seconds)


def _run(query: StreamingQuery, batches: _Batches, seconds: float | None) -> None:
    try:
        if seconds is None or seconds < 0:
            run_for(query, None)
        else:
            if not query.awaitTermination(seconds):
                batches.closed = True
                run_for(query, 0)
        failed = query.exception()
    except StreamingQueryException as e:
        failed = e
    if failed is not None and not (batches.closed and _ENDED in str(failed)):
        raise failed
