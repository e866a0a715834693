"""Deliveries since the last call, per project and consumer, with Structured Streaming.

The cursor is a streaming checkpoint: the file source records which landed
files it has consumed. There is one cursor per landing, project and consumer; a
call for a project reads only that project's folder of the landing and moves
only that cursor. A call without a project has a cursor of its own over the
whole landing. No file is passed over for its age.

A call runs the query with ``trigger(availableNow=True)`` and writes each epoch
to ``calls/call=<id>/epoch=<n>``; what is in the call's folder is what the call
returns, however many epochs it took. A call that stopped before an epoch's
commit never returned it: the next call runs that epoch again, into its own folder.
Records and bodies that give no row are kept there too (``delivery_rejects``).

Rows that fail the call's filters are consumed as well (the cursor is not
per filter). One call per cursor at a time.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from annotask.functions.filters import filter_tasks
from annotask.schema import PAGE_RECORD_SCHEMA
from annotask.session import checkpoint_root
from annotask.sources.pages import (
    JSON_OPTIONS,
    PAGE_LINE_SCHEMA,
    ROW,
    explode_all,
    page_lines,
    project_folder,
    rejects_of,
    rows_of,
)

DEFAULT_CONSUMER = "default"
# The file source forgets files that are this much older than the newest; no
# landing is.
_NO_AGE_LIMIT = "36500d"


def cursor_key(landing_path: str, project_id=None, consumer: str | None = None) -> str:
    """The cursor's folder name. Landing, project and consumer are user input; their digest is not."""
    parts = (landing_path.rstrip("/"), "" if project_id is None else f"={project_id}", consumer or DEFAULT_CONSUMER)
    return hashlib.sha256("\n".join(f"{len(p)}:{p}" for p in parts).encode("utf-8")).hexdigest()


def _cursor_dirs(spark, landing_path, project_id, consumer, output_path, checkpoint_path) -> tuple[str, str]:
    if output_path and checkpoint_path:
        return checkpoint_path, output_path
    root = f"{checkpoint_root(spark)}/annotask/cursors/{cursor_key(landing_path, project_id, consumer)}"
    return checkpoint_path or f"{root}/checkpoint", output_path or f"{root}/calls"


def _page_stream(spark, landing_path, project_id, max_files_per_trigger, max_bytes_per_trigger) -> DataFrame:
    reader = spark.readStream.schema(PAGE_LINE_SCHEMA).options(**JSON_OPTIONS).option("maxFileAge", _NO_AGE_LIMIT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    path = landing_path if project_id is None else project_folder(landing_path, project_id)
    return page_lines(reader.json(path))


def _exploded(pages: DataFrame, record_schema: T.StructType, project_id=None, **filters) -> DataFrame:
    """Rows that pass the filters, and all rejects."""
    found = explode_all(pages, "value", record_schema, keep=("result", "page"))
    wanted = filter_tasks(found, project_id=project_id, **filters)
    return found if wanted is found else wanted.where(F.col("_outcome") == ROW).union(found.where(F.col("_outcome") != ROW))


def delivery_stream(
    spark: SparkSession,
    landing_path: str,
    project_id=None,
    batch_id=None,
    client_batch_id=None,
    client_batch_id_match_type=None,
    record_schema: T.StructType = PAGE_RECORD_SCHEMA,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame of delivered task rows from a landing of lines.

    ``max_files_per_trigger`` / ``max_bytes_per_trigger`` (an integer byte
    count) bound what one micro-batch reads (the per-call limit).
    """
    pages = _page_stream(spark, landing_path, project_id, max_files_per_trigger, max_bytes_per_trigger)
    rows = rows_of(explode_all(pages, "value", record_schema, keep=("result", "page")))
    return filter_tasks(
        rows,
        project_id=project_id,
        batch_id=batch_id,
        client_batch_id=client_batch_id,
        client_batch_id_match_type=client_batch_id_match_type,
    )


def _nothing(spark: SparkSession, record_schema: T.StructType) -> DataFrame:
    pages = spark.createDataFrame([], "result string, page int, value string")
    return explode_all(pages, "value", record_schema, keep=("result", "page"))


def _read_written(spark: SparkSession, path: str, record_schema: T.StructType) -> DataFrame:
    """What epochs wrote under a folder; nothing yet gives no rows."""
    empty = _nothing(spark, record_schema)
    try:
        return spark.read.schema(empty.schema).parquet(path).select(*empty.columns)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty


def deliveries_since_last_call(
    spark: SparkSession,
    landing_path: str,
    consumer: str | None = None,
    project_id=None,
    batch_id=None,
    client_batch_id=None,
    client_batch_id_match_type=None,
    output_path: str | None = None,
    checkpoint_path: str | None = None,
    record_schema: T.StructType = PAGE_RECORD_SCHEMA,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Rows delivered since the previous call for this landing, project and consumer (none → empty)."""
    checkpoint, calls = _cursor_dirs(spark, landing_path, project_id, consumer, output_path, checkpoint_path)
    filters = dict(
        project_id=project_id,
        batch_id=batch_id,
        client_batch_id=client_batch_id,
        client_batch_id_match_type=client_batch_id_match_type,
    )
    try:
        stream = _page_stream(spark, landing_path, project_id, max_files_per_trigger, max_bytes_per_trigger)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        # Nothing has landed yet: no rows, and no cursor is created.
        return rows_of(_nothing(spark, record_schema))
    call = f"{calls}/call={uuid.uuid4().hex}"

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        _exploded(batch, record_schema, **filters).write.mode("overwrite").parquet(f"{call}/epoch={epoch_id}")

    query = (
        stream.writeStream.foreachBatch(write_epoch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return rows_of(_read_written(spark, call, record_schema))


def delivery_rejects(
    spark: SparkSession,
    landing_path: str,
    consumer: str | None = None,
    project_id=None,
    output_path: str | None = None,
    record_schema: T.StructType = PAGE_RECORD_SCHEMA,
) -> DataFrame:
    """Records and bodies that all calls of this cursor so far could not read:
    ``result``, ``page``, ``position``, ``rejected`` (record or body) and ``text``."""
    _, calls = _cursor_dirs(spark, landing_path, project_id, consumer, output_path, None if output_path is None else "-")
    return rejects_of(_read_written(spark, calls, record_schema), record_schema)


def start_delivery_stream(
    spark: SparkSession,
    landing_path: str,
    output_path: str,
    consumer: str | None = None,
    processing_time: str = "1 minute",
    checkpoint_path: str | None = None,
    rejects_path: str | None = None,
    record_schema: T.StructType = PAGE_RECORD_SCHEMA,
    project_id=None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    **filters,
) -> StreamingQuery:
    """The same cursor without stopping: new pages are picked up every trigger.

    Rows go to ``output_path/epoch=<n>``, rejects beside them to
    ``rejects_path/epoch=<n>`` (default ``<output_path>_rejects``).
    """
    checkpoint, _ = _cursor_dirs(spark, landing_path, project_id, consumer, output_path, checkpoint_path)
    stream = _page_stream(spark, landing_path, project_id, max_files_per_trigger, max_bytes_per_trigger)
    rejects = rejects_path or f"{output_path.rstrip('/')}_rejects"

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        found = _exploded(batch, record_schema, project_id=project_id, **filters).persist()
        rejects_of(found, record_schema).write.mode("overwrite").parquet(f"{rejects}/epoch={epoch_id}")
        rows_of(found).write.mode("overwrite").parquet(f"{output_path}/epoch={epoch_id}")
        found.unpersist()

    return (
        stream.writeStream.foreachBatch(write_epoch)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=processing_time)
        .start()
    )
