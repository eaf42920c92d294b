"""Delta files landing in a folder drive the incremental merge, one micro-batch each.

This is the same daily job, only triggered by Structured Streaming: the file
source remembers which delta files were merged (in ``checkpoint_location``),
and ``foreachBatch`` hands each new batch to :func:`incremental_merge`.
``current`` is rewritten by dynamic partition overwrite, so a retried batch
with the same load time leaves it as it was; the archive append is
at-least-once (a retried batch appends its snapshot again).  The batch job's
``archive_once`` is not used here: it needs one load time per run, and a
fixed ``load_ts`` is shared by every batch.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.plans.jobs import incremental_merge, incremental_merge_table
from tidemark.spec import TableSpec


def start_merge_stream(
    spark: SparkSession,
    delta_dir: str,
    delta_schema: StructType,
    spec: TableSpec,
    current_path: str,
    checkpoint_location: str,
    archive_path: str | None = None,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    available_now: bool = True,
    processing_time: str = "1 minute",
    load_ts=None,
    current_schema: StructType | None = None,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops after the files present.

    By default everything new is one run, so all files of a delta meet in one
    merge; ``files_per_batch=1`` merges every file as its own run, in arrival order
    (only for feeds that write one file per delta).  ``load_ts`` fixes the load time of
    every batch; by default each batch takes the driver clock once.
    ``current_schema`` is passed to every merge (it saves a listing per batch).
    """
    def merge_batch(batch, batch_id: int) -> None:
        incremental_merge(batch.sparkSession, batch, spec, current_path, archive_path, load_ts=load_ts, fmt=fmt,
                          current_schema=current_schema)

    return _start(spark, delta_dir, delta_schema, fmt, checkpoint_location, files_per_batch, available_now,
                  processing_time, merge_batch)


def start_merge_stream_table(
    spark: SparkSession,
    delta_dir: str,
    delta_schema: StructType,
    spec: TableSpec,
    current_table: str,
    checkpoint_location: str,
    archive_table: str | None = None,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    available_now: bool = True,
    processing_time: str = "1 minute",
    load_ts=None,
) -> StreamingQuery:
    """:func:`start_merge_stream` into catalog tables (:func:`incremental_merge_table`):
    each batch lists only the partitions it touches.  ``fmt`` is the format of
    the delta files."""
    def merge_batch(batch, batch_id: int) -> None:
        incremental_merge_table(batch.sparkSession, batch, spec, current_table, archive_table, load_ts=load_ts)

    return _start(spark, delta_dir, delta_schema, fmt, checkpoint_location, files_per_batch, available_now,
                  processing_time, merge_batch)


def _start(spark, delta_dir, delta_schema, fmt, checkpoint_location, files_per_batch, available_now,
           processing_time, merge_batch) -> StreamingQuery:
    reader = spark.readStream.format(fmt).schema(delta_schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    deltas = reader.load(delta_dir)
    writer = deltas.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
