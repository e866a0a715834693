"""Project and batch reports: stats, batch-job status, project lookup, schemas.

All are hash aggregations with a partial (map-side) step, so a hot project or
batch is pre-aggregated in every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.functions.filters import filter_tasks
from annotask.operators.projections import omit_failed_task_data as _blank_failed_data
from annotask.schema import PREANNOTATION_PREFIX, STATE_COLUMN_NAMES, TASK_STATES


def _state_counts():
    return [F.count_if(F.col("state") == F.lit(s)).alias(STATE_COLUMN_NAMES[s]) for s in TASK_STATES]


def project_stats(tasks: DataFrame, project_id=None, from_timestamp=None, to_timestamp=None) -> DataFrame:
    """Per project: task count and one count per state, over tasks created in
    the (strict) time frame."""
    scoped = filter_tasks(tasks, project_id=project_id, from_timestamp=from_timestamp, to_timestamp=to_timestamp)
    return scoped.groupBy("project_id").agg(
        F.count(F.lit(1)).alias("n_tasks"),
        *_state_counts(),
        F.min("created_at").alias("first_created_at"),
        F.max("created_at").alias("last_created_at"),
        F.count("completed_at").alias("n_completed_at"),
    )


def project_state_counts(tasks: DataFrame, project_id=None, from_timestamp=None, to_timestamp=None) -> DataFrame:
    """Long form of :func:`project_stats`: one row per (project, state)."""
    scoped = filter_tasks(tasks, project_id=project_id, from_timestamp=from_timestamp, to_timestamp=to_timestamp)
    return scoped.groupBy("project_id", "state").agg(F.count(F.lit(1)).alias("n_tasks"))


def batch_task_counts(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("project_id", "batch_id").agg(
        F.count(F.lit(1)).alias("n_tasks"),
        *_state_counts(),
        F.min("created_at").alias("first_created_at"),
        F.max("created_at").alias("last_created_at"),
    )


def batch_status(jobs: DataFrame, tasks: DataFrame, project_id=None, batch_id=None) -> DataFrame:
    """Status of batch-creation jobs with the counts of their tasks.

    Tasks are counted per (project, batch) first, so the join sees one row
    per batch on each side. Where the job rows have it, ``n_failed`` is how many
    inputs did not become tasks.
    """
    jobs = filter_tasks(jobs, project_id=project_id, batch_id=batch_id)
    tasks = filter_tasks(tasks, project_id=project_id, batch_id=batch_id)
    counts = batch_task_counts(tasks)
    count_cols = ["n_tasks"] + [STATE_COLUMN_NAMES[s] for s in TASK_STATES]
    of_job = ["project_id", "batch_id", "status", "tasks_file_name", "notification_email", "created_at"]
    failed = ["n_failed"] if "n_failed" in jobs.columns else []
    out = jobs.select(*of_job, *failed).join(counts, ["project_id", "batch_id"], "left")
    return out.select(
        *of_job,
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in (*count_cols, *failed)],
        "first_created_at",
        "last_created_at",
    )


def batch_task_detail(
    jobs: DataFrame,
    tasks: DataFrame,
    omit_failed_task_data: bool = False,
    project_id=None,
    batch_id=None,
    rejected_requests: DataFrame | None = None,
) -> DataFrame:
    """Per-task rows of batch jobs; ``failed`` when the job or the task itself failed.

    ``rejected_requests`` (project_id, batch_id, value: the request as JSON)
    are the inputs of the jobs that did not become tasks: rows without an id,
    failed each by itself. With ``omit_failed_task_data`` the input data
    of failed tasks is blanked.
    """
    jobs = filter_tasks(jobs, project_id=project_id, batch_id=batch_id).select(
        "project_id", "batch_id", (F.col("status") == F.lit("failed")).alias("failed")
    )
    tasks = filter_tasks(tasks, project_id=project_id, batch_id=batch_id).select("project_id", "batch_id", "id", "state", "data")
    out = tasks.join(jobs, ["project_id", "batch_id"], "inner")
    if rejected_requests is not None:
        own = filter_tasks(rejected_requests, project_id=project_id, batch_id=batch_id)
        own = own.join(jobs.select("project_id", "batch_id"), ["project_id", "batch_id"], "left_semi")
        nothing = F.lit(None).cast("string")
        data = F.from_json("value", "data string").getField("data")
        out = out.unionByName(
            own.select("project_id", "batch_id", nothing.alias("id"), nothing.alias("state"), data.alias("data"), F.lit(True).alias("failed"))
        )
    return _blank_failed_data(out) if omit_failed_task_data else out


def project_information(projects: DataFrame, project_id=None) -> DataFrame:
    """Project rows (one project, or all)."""
    return projects if project_id is None else projects.where(F.col("id") == F.lit(str(project_id)))


def creation_schema(inputs: DataFrame, prefix: str = PREANNOTATION_PREFIX, infer_nested: bool = False) -> DataFrame:
    """Field profile of task inputs: name, type, non-null count, pre-annotation flag.

    With ``infer_nested`` the JSON type of each string pre-annotation column
    is merged over all rows (``schema_of_variant_agg``).
    """
    types = {f.name: f.dataType.simpleString() for f in inputs.schema.fields}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    rows = []
    for i, f in enumerate(inputs.schema.fields):
        column = F.col(f"`{f.name.replace('`', '``')}`")
        aggs.append(F.count(column).alias(f"_n{i}"))
        row = [
            F.lit(f.name).alias("column_name"),
            F.lit(types[f.name]).alias("data_type"),
            F.col(f"_n{i}").cast("bigint").alias("non_null"),
            F.col("_rows").cast("bigint").alias("n_rows"),
            F.lit(f.name.startswith(prefix)).alias("is_preannotation"),
        ]
        if infer_nested:
            nested = f.name.startswith(prefix) and isinstance(f.dataType, T.StringType)
            if nested:
                aggs.append(F.schema_of_variant_agg(F.try_parse_json(column)).alias(f"_t{i}"))
            row.append((F.col(f"_t{i}") if nested else F.lit(None).cast("string")).alias("json_type"))
        rows.append(F.struct(*row))
    # All counts in one aggregation; the wide row then becomes long rows.
    return inputs.agg(*aggs).select(F.inline(F.array(*rows)))


def delivery_schema(deliveries: DataFrame, project_id=None, infer_types: bool = False) -> DataFrame:
    """Per project: top-level answer fields and how many deliveries carry each.

    Answers are read as a map of field → value, exploded and counted in one
    scan: every delivery adds a row without a field too, whose count is the
    project's deliveries. A project without any field has one row, its field
    NULL and ``n_present`` 0. With ``infer_types`` the values are read as
    VARIANT and the merged JSON type of each field is added
    (``schema_of_variant_agg``).
    """
    scoped = filter_tasks(deliveries, project_id=project_id)
    value_type = "variant" if infer_types else "string"
    fields = F.map_entries(F.from_json(F.col("answers"), f"map<string,{value_type}>"))
    none = F.expr(f"array(named_struct('key', cast(null as string), 'value', cast(null as {value_type})))")
    nothing = F.expr(f"cast(array() as array<struct<key:string,value:{value_type}>>)")
    each = scoped.select("project_id", F.explode(F.concat(none, F.coalesce(fields, nothing))).alias("_e"))
    aggs = [F.count(F.lit(1)).alias("_n")]
    if infer_types:
        aggs.append(F.schema_of_variant_agg(F.col("_e.value")).alias("json_type"))
    counts = each.groupBy("project_id", F.col("_e.key").alias("field")).agg(*aggs)
    # One row per field and project is all that this window sees.
    of_project = Window.partitionBy("project_id")
    counts = counts.withColumn("n_deliveries", F.max(F.when(F.col("field").isNull(), F.col("_n"))).over(of_project))
    counts = counts.withColumn("_fields", F.count("field").over(of_project))
    out = counts.where(F.col("field").isNotNull() | (F.col("_fields") == 0))
    present = F.when(F.col("field").isNull(), F.lit(0)).otherwise(F.col("_n")).cast("bigint").alias("n_present")
    types = [F.when(F.col("field").isNotNull(), F.col("json_type")).alias("json_type")] if infer_types else []
    return out.select("project_id", "field", present, *types, "n_deliveries")
