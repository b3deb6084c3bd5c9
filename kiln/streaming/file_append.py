"""File-source stream appended to a directory of Parquet files.

``readStream`` over a directory with a declared schema (a file with an extra
column is read without it) and Spark's own file sink.  The sink's record of
committed batches lies in the output directory and the source's progress in
the checkpoint, so the two belong together: a rerun or restart on the same
checkpoint adds each file's rows once, and a new checkpoint reads the whole
source and needs a new output directory.  Readers of that directory see the
sink's files only; a table that batch code writes too is streamed into by
:mod:`kiln.streaming.table_append`.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from kiln import paths
from kiln.operators.tables import SINK_LOG

DEFAULT_TRIGGER = "10 seconds"


def file_stream(
    spark: SparkSession,
    source_dir: str,
    schema: StructType | str,
    *,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame over ``source_dir``; ``max_files_per_trigger`` bounds each micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(source_dir)


def start_append(
    stream: DataFrame,
    output_dir: str,
    checkpoint_dir: str,
    *,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    """Start an append-mode query writing ``stream`` as Parquet files under ``output_dir``.

    ``available_now`` processes what is in the source and stops; otherwise a
    processing-time ``trigger`` is used.  An output directory that another
    checkpoint has filled is refused: the sink would take the new run's first
    batches for ones it has already and skip them.  So is one with files that no
    stream wrote: the sink's log would hide them from every later read (use
    :func:`kiln.streaming.stream_into_table` there).
    """
    spark = stream.sparkSession
    logged = paths.exists(spark, f"{output_dir}/{SINK_LOG}")
    if logged and not paths.exists(spark, f"{checkpoint_dir}/offsets"):
        raise ValueError(f"{output_dir} was written from another checkpoint; a new checkpoint needs a new directory")
    if not logged and paths.has_data(spark, output_dir):
        raise ValueError(f"{output_dir} holds files that no stream wrote, which the sink would hide; use stream_into_table")
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", output_dir).option("checkpointLocation", checkpoint_dir)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


class _BatchEnds(StreamingQueryListener):
    """Notices when a batch of one query has been committed."""

    def __init__(self, query: StreamingQuery):
        self.query_id, self.seen = str(query.id), threading.Event()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        if str(event.progress.id) == self.query_id:
            self.seen.set()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if str(event.id) == self.query_id:
            self.seen.set()


def run_for(query: StreamingQuery, seconds: float | None) -> None:
    """Run ``seconds``, then stop once the batch that is running has been committed.

    ``None`` or a negative value waits until the query ends by itself.  A
    listener tells when the running batch ends, so the time is exceeded by that
    batch at most; a batch that begins in the moment before the stop leaves
    nothing behind, since the sink commits whole batches only.
    """
    if seconds is None or seconds < 0:
        query.awaitTermination()
        return
    streams = SparkSession.active().streams
    ends = _BatchEnds(query)
    streams.addListener(ends)
    try:
        if query.awaitTermination(max(seconds, 0.01)):
            return
        ends.seen.clear()
        while query.isActive and query.status["isTriggerActive"] and not ends.seen.wait(0.1):
            pass
        query.stop()
    finally:
        streams.removeListener(ends)


def stream_files(
    spark: SparkSession,
    source_dir: str,
    schema: StructType | str,
    output_dir: str,
    checkpoint_dir: str,
    *,
    available_now: bool = True,
    trigger: str = DEFAULT_TRIGGER,
    run_seconds: float | None = None,
    max_files_per_trigger: int | None = None,
) -> None:
    """Stream ``source_dir`` into ``output_dir``; raises what the query failed with."""
    stream = file_stream(spark, source_dir, schema, max_files_per_trigger=max_files_per_trigger)
    q = start_append(stream, output_dir, checkpoint_dir, trigger=trigger, available_now=available_now)
    run_for(q, None if available_now else run_seconds)
    if q.exception() is not None:
        raise q.exception()
