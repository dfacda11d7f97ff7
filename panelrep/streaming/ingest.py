"""Incremental scenario ingest with Structured Streaming.

New scenario exports land as files in a folder; a file-source stream picks up
what is new (the stream checkpoint remembers files already seen).  Every
micro-batch is written under its number to an incoming area, so a retried batch
replaces itself and a scenario may come in any number of batches.
:func:`publish` then adds the complete scenarios to the project: each one moves
into place as a whole, and a stored scenario is never overwritten.

:func:`drain` does both for a scheduled job: it takes all files that are there,
stops, and publishes.  With a processing-time trigger, call :func:`publish` with
the scenarios that are known to be complete.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import ensure_checkpoint_dir, file_system
from ..sources.facts import ingest_no_clobber


def _incoming(root: str, query: str) -> str:
    return f"{root}/_incoming/query={query}"


def stage_batch(batch: DataFrame, number: int, root: str, query: str) -> None:
    """Writes a micro-batch to its own folder of the incoming area."""
    batch.write.mode("overwrite").parquet(f"{_incoming(root, query)}/batch={number}")


def publish(spark: SparkSession, schema: T.StructType, root: str, query: str, scenarios: Sequence[str] | None = None, *,
            key: str = "scenario") -> list[str]:
    """Adds the incoming scenarios (all, or those named) that the project lacks; the names of the added ones.

    The incoming rows stay where they are, so that a scenario published later
    is whole; :func:`clear` removes them.
    """
    path = _incoming(root, query)
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return []
    rows = spark.read.schema(schema).parquet(path).select(schema.names)
    if scenarios is not None:
        rows = rows.filter(rows[key].cast("string").isin(list(scenarios)))
    return ingest_no_clobber(spark, rows, root, query, key)


def clear(spark: SparkSession, root: str, query: str) -> None:
    """Removes the incoming rows of a query table; only while no stream writes there."""
    fs, p = file_system(spark, _incoming(root, query))
    fs.delete(p, True)


def drain(spark: SparkSession, source_dir: str, schema: T.StructType, root: str, query: str, *, key: str = "scenario",
          **options) -> list[str]:
    """Takes all files that are there, then publishes every scenario that the project lacks."""
    start_ingest(spark, source_dir, schema, root, query, **options).awaitTermination()
    return publish(spark, schema, root, query, key=key)


def start_ingest(spark: SparkSession, source_dir: str, schema: T.StructType, root: str, query: str, *,
                 fmt: str = "parquet", checkpoint: str | None = None, available_now: bool = True,
                 processing_time: str | None = None, files_per_batch: int | None = None) -> StreamingQuery:
    """Start the stream that stages one query table's batches; returns the running query."""
    stream = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        stream = stream.option("header", True)
    src = stream.load(source_dir)
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{query}"
    writer = (src.writeStream.foreachBatch(lambda df, number: stage_batch(df, number, root, query))
              .option("checkpointLocation", ckpt))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
