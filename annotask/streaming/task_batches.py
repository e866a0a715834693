"""Create task batches from a stream: one batch per micro-batch.

Each epoch is written by :func:`annotask.sinks.batches.write_task_batch` as
batch ``<name>-<epoch>``; a replayed epoch is a new attempt at its own batch,
so the sink is exactly-once for readers of committed batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from annotask.sinks.batches import write_task_batch


def stream_task_batches(
    stream: DataFrame,
    path: str,
    project_id: str,
    name: str,
    checkpoint_path: str,
    jobs_path: str | None = None,
    available_now: bool = False,
    processing_time: str = "1 minute",
    **options,
) -> StreamingQuery:
    """Start a query that writes every micro-batch as a committed task batch."""

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        write_task_batch(batch, path, project_id, f"{name}-{epoch_id}", jobs_path=jobs_path, **options)

    writer = stream.writeStream.foreachBatch(write_epoch).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
