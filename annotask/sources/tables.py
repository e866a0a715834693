"""Task and delivery tables: reading them, and the status / delivery views.

The tables are Parquet, partitioned by ``project_id`` (see
:func:`annotask.sinks.tables.write_tasks`). Each view is a lazy DataFrame: the
filters are pushed into the scan, the project filter prunes folders, and
``omit_answers`` prunes the widest column from the read schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from annotask.functions.filters import filter_tasks
from annotask.functions.json import answers_to_json
from annotask.operators.projections import omit_answers as _omit_answers
from annotask.operators.projections import same_as_delivery as _same_as_delivery
from annotask.operators.keys import id_frame
from annotask.operators.changes import apply_changes, read_changes
from annotask.schema import AS_OF, DELIVERY_SCHEMA, STORED_TASK_SCHEMA


def read_tasks(
    spark: SparkSession, path: str, changes_path: str | None = None, project_id=None, version: int | None = None
) -> DataFrame:
    """A task table written partitioned by project (declared schema, no inference).

    With ``changes_path`` as its log of state changes leaves it (``version``: as that version of the log does);
    with ``project_id`` only that project's part of both is read.
    """
    stored = STORED_TASK_SCHEMA if changes_path is None else T.StructType([*STORED_TASK_SCHEMA.fields, T.StructField(AS_OF, T.LongType())])
    tasks = filter_tasks(spark.read.schema(stored).parquet(path), project_id=project_id)
    if changes_path is None:
        return tasks
    return apply_changes(tasks, read_changes(spark, changes_path, project_id, version)).drop(AS_OF)


def read_deliveries(spark: SparkSession, path: str) -> DataFrame:
    """A delivery table, from ``write_deliveries`` or ``compact_pages`` (answers are compact text already)."""
    return spark.read.schema(DELIVERY_SCHEMA).parquet(path).select(*DELIVERY_SCHEMA.names)


def multi_task_status(
    tasks: DataFrame,
    project_id=None,
    batch_id=None,
    client_batch_id=None,
    client_batch_id_match_type=None,
    date_type=None,
    from_timestamp=None,
    to_timestamp=None,
    state=None,
    omit_answers: bool = True,
    compact: bool = True,
) -> DataFrame:
    """Tasks matching every given filter.

    ``date_type`` and ``to_timestamp`` are honoured (creation or completion
    date, strict bounds). ``omit_answers`` drops the answers column, so the
    scan does not read it. With ``compact=False`` answers are taken as they are:
    those of stored tables are compact text already.
    """
    out = filter_tasks(
        tasks,
        project_id=project_id,
        batch_id=batch_id,
        client_batch_id=client_batch_id,
        client_batch_id_match_type=client_batch_id_match_type,
        date_type=date_type,
        from_timestamp=from_timestamp,
        to_timestamp=to_timestamp,
        state=state,
    )
    if omit_answers:
        return _omit_answers(out)
    return answers_to_json(out) if compact else out


def delivered_tasks(
    deliveries: DataFrame,
    project_id=None,
    batch_id=None,
    client_batch_id=None,
    client_batch_id_match_type=None,
    from_timestamp=None,
    task_id=None,
    dedupe: bool = False,
    compact: bool = True,
) -> DataFrame:
    """Deliveries after ``from_timestamp`` (strict), answers as compact JSON text.

    Bounds carry nanoseconds and Spark keeps microseconds, so a bound cut to
    µs can return again a delivery made inside the same microsecond; with
    ``dedupe`` rows are made unique by (id, delivered_at).
    """
    out = filter_tasks(
        deliveries,
        project_id=project_id,
        batch_id=batch_id,
        client_batch_id=client_batch_id,
        client_batch_id_match_type=client_batch_id_match_type,
        from_timestamp=from_timestamp,
        task_id=task_id,
        date_col="delivered_at",
    )
    if dedupe:
        out = out.dropDuplicates(["id", "delivered_at"])
    return answers_to_json(out) if compact else out


def task_status(
    tasks: DataFrame, task_ids, project_id=None, same_as_delivery: bool = True, compact: bool = True
) -> DataFrame:
    """Status of one task (a scalar id) or of many (a list or a DataFrame of ids).

    One id is a pushed-down equality (and a bloom-filter hit on tables written
    by ``write_tasks``). Many ids are a left-semi join against the id list; a
    semi join never multiplies rows, so the list is not de-duplicated. Spark
    broadcasts the list only from a measured size, otherwise both sides are
    shuffled on ``id``.
    """
    out = filter_tasks(tasks, project_id=project_id)
    if isinstance(task_ids, (str, int)):
        out = filter_tasks(out, task_id=task_ids)
    else:
        ids = id_frame(tasks.sparkSession, task_ids, "id", unique=False)
        out = out.join(ids, "id", "left_semi")
    out = answers_to_json(out) if compact else out
    if same_as_delivery:
        return _same_as_delivery(out)
    return out
