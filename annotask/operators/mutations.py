"""Bulk changes to task and batch-job tables, as DataFrame → DataFrame.

Each change is a join against a de-duplicated change list: the list is made
unique per key first (an aggregation with map-side combine), so every task
matches at most one change row and no key gathers its rows in one task.
Adaptive execution turns the join into a broadcast when the change list is
measured small, and otherwise shuffles both sides on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.operators.keys import id_frame

REJECTED = "rejected"
CANCELLED = "cancelled"
# Batch jobs that are already over are not cancelled again.
FINAL_JOB_STATES = ("committed", "completed", "failed", CANCELLED)


def _in_project(df: DataFrame, project_id) -> object:
    return F.lit(True) if project_id is None else (F.col("project_id") == F.lit(str(project_id)))


def reject_tasks(tasks: DataFrame, rejections: DataFrame, project_id=None) -> DataFrame:
    """Mark tasks as rejected, with their reasons.

    ``rejections(id, reasons array<string>[, at timestamp])``; when a task is
    rejected several times the latest rejection (by ``at``, then by reasons)
    is kept. Tasks of other projects are left alone. Reasons of an earlier
    rejection (``reject_reasons`` in ``tasks``) are replaced by a later one.
    """
    order = F.col("at") if "at" in rejections.columns else F.lit(None).cast("timestamp_ntz")
    reasons = F.col("reasons")
    if not isinstance(rejections.schema["reasons"].dataType, T.ArrayType):
        reasons = F.array(reasons.cast("string"))
    latest = (
        rejections.select(F.col("id").cast("string").alias("id"), F.struct(order.alias("at"), reasons.alias("reasons")).alias("_r"))
        .where(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.max("_r").alias("_r"))
        .select("id", F.lit(True).alias("_hit"), F.col("_r.reasons").alias("_reasons"))
    )
    hit = F.coalesce(F.col("_hit"), F.lit(False)) & _in_project(tasks, project_id)
    before = F.col("reject_reasons") if "reject_reasons" in tasks.columns else F.lit(None).cast("array<string>")
    out = tasks.join(latest, "id", "left")
    return out.select(
        *[
            F.when(hit, F.lit(REJECTED)).otherwise(F.col("state")).alias("state") if c == "state" else F.col(c)
            for c in tasks.columns
            if c != "reject_reasons"
        ],
        F.when(hit, F.col("_reasons")).otherwise(before).alias("reject_reasons"),
    )


def update_priorities(tasks: DataFrame, task_ids, priority: int, project_id=None) -> DataFrame:
    """Set ``priority`` on the listed tasks; unknown ids change nothing."""
    ids = id_frame(tasks.sparkSession, task_ids, "id").withColumn("_hit", F.lit(True))
    hit = F.coalesce(F.col("_hit"), F.lit(False)) & _in_project(tasks, project_id)
    out = tasks.join(ids, "id", "left")
    return out.select(
        *[F.when(hit, F.lit(int(priority))).otherwise(F.col(c)).cast("int").alias(c) if c == "priority" else F.col(c) for c in tasks.columns]
    )


def delete_tasks(tasks: DataFrame, task_ids, project_id=None) -> DataFrame:
    """All tasks but the listed ones (of the given project)."""
    if project_id is None:
        return tasks.join(id_frame(tasks.sparkSession, task_ids, "id", unique=False), "id", "left_anti")
    ids = id_frame(tasks.sparkSession, task_ids, "id")
    marked = tasks.join(ids.withColumn("_hit", F.lit(True)), "id", "left")
    gone = F.coalesce(F.col("_hit"), F.lit(False)) & F.coalesce(_in_project(tasks, project_id), F.lit(False))
    return marked.where(~gone).select(*tasks.columns)


def cancel_batches(jobs: DataFrame, batch_ids, project_id=None) -> DataFrame:
    """Cancel the listed batch-creation jobs that are not over yet."""
    ids = id_frame(jobs.sparkSession, batch_ids, "batch_id").withColumn("_hit", F.lit(True))
    hit = F.coalesce(F.col("_hit"), F.lit(False)) & _in_project(jobs, project_id) & ~F.col("status").isin(*FINAL_JOB_STATES)
    out = jobs.join(ids, "batch_id", "left")
    return out.select(
        *[F.when(hit, F.lit(CANCELLED)).otherwise(F.col(c)).alias(c) if c == "status" else F.col(c) for c in jobs.columns]
    )
