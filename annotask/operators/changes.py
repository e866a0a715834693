"""State changes of tasks as a log, folded into what readers see.

Rejections, priority changes and deletions are appended to a versioned log
(``sinks.versions``) that is partitioned by project like the task table.
``apply_changes`` folds it: one row per task (the latest rejection, the latest
priority, whether it was deleted), joined to the tasks. A change is therefore
kept even where it leaves a project without tasks.

Later means of a higher version of the log, then (inside one version) of a later time.
A stored task can carry the version that its state already takes in (``as_of``, see
``write_tasks``): only changes after it are folded, so a task that was rejected,
reworked and written back is not rejected again by the old row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annotask.functions.filters import timestamp_literal
from annotask.operators.keys import id_frame
from annotask.operators.mutations import REJECTED
from annotask.schema import AS_OF, TASK_CHANGE_SCHEMA
from annotask.sinks.versions import VERSION, VersionedLog

REJECT, PRIORITY, DELETE = "reject", "priority", "delete"
_ALWAYS = (1 << 63) - 1


def _time(at) -> Column:
    return timestamp_literal(at if at is not None else _dt.datetime.now(_dt.timezone.utc))


def _rows(ids: DataFrame, project_id, kind: str, at, reasons: Column | None = None, priority: Column | None = None) -> DataFrame:
    made = {
        "project_id": F.lit(str(project_id)),
        "id": F.col("id").cast("string"),
        "kind": F.lit(kind),
        "reasons": reasons if reasons is not None else F.lit(None),
        "priority": priority if priority is not None else F.lit(None),
        "at": at if isinstance(at, Column) else _time(at),
    }
    return ids.select(*[made[f.name].cast(f.dataType).alias(f.name) for f in TASK_CHANGE_SCHEMA.fields]).where("id is not null")


def rejection_changes(rejections: DataFrame, project_id, at=None) -> DataFrame:
    """Changes from ``rejections(id, reasons[, at])``."""
    when = F.col("at") if at is None and "at" in rejections.columns else at
    return _rows(rejections, project_id, REJECT, when, reasons=F.col("reasons"))


def priority_changes(spark: SparkSession, task_ids, project_id, priority: int, at=None) -> DataFrame:
    return _rows(id_frame(spark, task_ids, "id"), project_id, PRIORITY, at, priority=F.lit(int(priority)))


def deletion_changes(spark: SparkSession, task_ids, project_id, at=None) -> DataFrame:
    return _rows(id_frame(spark, task_ids, "id"), project_id, DELETE, at)


def change_log(spark: SparkSession, path: str) -> VersionedLog:
    return VersionedLog(spark, path, TASK_CHANGE_SCHEMA)


def record_changes(changes: DataFrame, path: str, project_id=None) -> int:
    """Append changes to the log (``project_id``: all are of that project); returns their version."""
    return change_log(changes.sparkSession, path).append(changes, project_id)


def changes_version(spark: SparkSession, path: str) -> int:
    """The log's newest version; -1 before the first change."""
    return change_log(spark, path).version()


def read_changes(spark: SparkSession, path: str, project_id=None, version: int | None = None) -> DataFrame:
    """The changes of a version of the log (by default the newest), each with its own version."""
    return change_log(spark, path).read(version, project_id)


def apply_changes(tasks: DataFrame, changes: DataFrame, project_id=None) -> DataFrame:
    """``tasks`` as the log leaves them (with ``project_id``, of that project only).

    The log is reduced to one row per task first, with partial aggregation, so a
    task changed very often, or a project with very many changes, reaches the join
    as one row per task. Changes without a version (not from a log) hold for every task.
    """
    if project_id is not None:
        tasks = tasks.where(F.col("project_id") == F.lit(str(project_id)))
        changes = changes.where(F.col("project_id") == F.lit(str(project_id)))

    version = F.coalesce(F.col(VERSION) if VERSION in changes.columns else F.lit(None), F.lit(_ALWAYS)).cast("long")

    def latest(kind: str, *value: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.struct(version.alias("version"), "at", *(F.col(v).alias("value") for v in value))))

    folded = changes.groupBy("project_id", "id").agg(
        latest(REJECT, "reasons").alias("_reject"),
        latest(PRIORITY, "priority").alias("_priority"),
        latest(DELETE).alias("_delete"),
    )
    met = tasks.join(folded, ["project_id", "id"], "left")
    if AS_OF in tasks.columns:
        known = F.coalesce(F.col(AS_OF), F.lit(-1).cast("long"))
        met = met.withColumns({c: F.when(F.col(f"{c}.version") > known, F.col(c)) for c in ("_reject", "_priority", "_delete")})
    met = met.where(F.col("_delete").isNull())
    before = F.col("reject_reasons") if "reject_reasons" in tasks.columns else F.lit(None).cast("array<string>")
    new = {
        "state": F.when(F.col("_reject").isNotNull(), F.lit(REJECTED)).otherwise(F.col("state")),
        "priority": F.when(F.col("_priority").isNotNull(), F.col("_priority.value")).otherwise(F.col("priority")),
        "reject_reasons": F.when(F.col("_reject").isNotNull(), F.col("_reject.value")).otherwise(before),
    }
    names = [*tasks.columns, *([] if "reject_reasons" in tasks.columns else ["reject_reasons"])]
    return met.select(*[new[c].alias(c) if c in new else F.col(c) for c in names])
