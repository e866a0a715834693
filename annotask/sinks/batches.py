"""Create task batches from a DataFrame: an opened job, the data, then a commit.

``write_task_batch`` appends an ``opened`` job row, so that a batch being
written can be cancelled, then decodes pre-annotations, wraps every row as a task
request and writes the requests on the executors. Every run of a batch is an
attempt of its own: its rows carry the attempt, and the commit row names it.
Readers see the rows of the committed attempt only, so a half-written batch or
an earlier run of the same batch is never seen, whatever it left behind. A batch
that was cancelled before its commit stays cancelled; a committed one cannot be
cancelled any more. Nothing passes through the driver except row counts, gathered
with ``observe`` in the same pass.

The job log is versioned (``sinks.versions``): what came before what is told by
the versions in which the rows were committed, not by the writers' clocks, and
compaction takes out only the folders that it read.

Requests are Parquet partitioned by ``project_id`` alone, batch, attempt and
outcome being columns: listing them does not grow with the number of batches'
folders.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.functions.filters import filter_tasks
from annotask.operators.mutations import CANCELLED
from annotask.operators.requests import task_request_json
from annotask.schema import (
    DEFAULT_PRIORITY,
    DEFAULT_SUBMIT,
    DEFAULT_TASKS_FILE_NAME,
    JOB_LOG_SCHEMA,
    PREANNOTATION_PREFIX,
)
from annotask.sinks.versions import VERSION, VersionedLog

OPENED, COMMITTED = "opened", "committed"
ACCEPTED, REJECTED = "accepted", "rejected"
REQUEST_SCHEMA = "value string, project_id string, batch_id string, attempt string, outcome string"
# Bytes of committed attempts that every task is given at most; about so many a row, besides its texts.
BROADCAST_BYTES = 32 << 20
_ATTEMPT_BYTES = 200
# Parts that an attempt's requests are dealt to where the attempts are too many for that.
ATTEMPT_PARTS = 64


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def write_task_batch(
    df: DataFrame,
    path: str,
    project_id: str,
    batch_id: str,
    priority: int = DEFAULT_PRIORITY,
    submit: bool = DEFAULT_SUBMIT,
    notification_email: str | None = None,
    prefix: str = PREANNOTATION_PREFIX,
    on_error: str = "fail",
    drop_nulls: bool = False,
    max_records_per_file: int | None = 1_000_000,
    jobs_path: str | None = None,
    tasks_file_name: str = DEFAULT_TASKS_FILE_NAME,
) -> dict:
    """Write one batch of task requests; return its job row (as a dict).

    The row's status is ``committed``, or ``cancelled`` where the batch was
    cancelled while it was written.
    """
    spark, attempt = df.sparkSession, uuid.uuid4().hex
    job = {
        "project_id": str(project_id),
        "batch_id": str(batch_id),
        "status": OPENED,
        "tasks_file_name": tasks_file_name,
        "notification_email": notification_email,
        "n_tasks": None,
        "n_failed": None,
        "created_at": _now(),
        "attempt": attempt,
    }
    if jobs_path is not None:
        commit_batch(spark, jobs_path, job)
    requests = task_request_json(df, priority=priority, submit=submit, prefix=prefix, on_error=on_error, drop_nulls=drop_nulls)
    invalid = F.col("_invalid") if "_invalid" in requests.columns else F.lit(False)
    out = requests.select(
        F.col("request_json").alias("value"),
        F.lit(str(project_id)).alias("project_id"),
        F.lit(str(batch_id)).alias("batch_id"),
        F.lit(attempt).alias("attempt"),
        F.when(invalid, F.lit(REJECTED)).otherwise(F.lit(ACCEPTED)).alias("outcome"),
    )
    obs = Observation(f"batch-{project_id}-{batch_id}-{attempt}")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("outcome") == REJECTED).alias("rejected"))
    out.write.mode("append").option("maxRecordsPerFile", int(max_records_per_file or 0)).partitionBy("project_id").parquet(path)
    counts = obs.get
    rows = int(counts.get("rows", 0) or 0)
    rejected = int(counts.get("rejected", 0) or 0)
    job |= {"status": COMMITTED, "n_tasks": rows - rejected, "n_failed": rejected, "created_at": _now()}
    if jobs_path is not None:
        commit_batch(spark, jobs_path, job)
        # The log decides: a cancel that came before this row stands.
        of_batch = (F.col("project_id") == F.lit(str(project_id))) & (F.col("batch_id") == F.lit(str(batch_id)))
        job["status"] = read_batch_jobs(spark, jobs_path, project_id=project_id).where(of_batch).first()["status"]
    return job


def job_log(spark: SparkSession, jobs_path: str) -> VersionedLog:
    return VersionedLog(spark, jobs_path, JOB_LOG_SCHEMA)


def commit_batch(spark: SparkSession, jobs_path: str, job: dict) -> int:
    """Append a job row; a ``committed`` one makes the attempt it names visible to readers. Returns its version."""
    row = tuple(job.get(f.name) for f in JOB_LOG_SCHEMA.fields)
    # One row needs one task, whatever the session's parallelism.
    frame = spark.createDataFrame([row], JOB_LOG_SCHEMA).coalesce(1)
    return job_log(spark, jobs_path).append(frame, job["project_id"])


def _attempts(log: DataFrame) -> DataFrame:
    """Per attempt at a batch the rows that decide: its first, its first cancel and commit, its last but cancels.

    The log has a few rows per attempt, so this aggregation is small.
    """
    row = F.struct(VERSION, "created_at", *[f.name for f in JOB_LOG_SCHEMA.fields if f.name != "created_at"])
    cancel, commit = F.col("status") == CANCELLED, F.col("status") == COMMITTED
    return log.groupBy("project_id", "batch_id", "attempt").agg(
        F.min(row).alias("_first"),
        F.min(F.when(cancel, row)).alias("_cancel"),
        F.min(F.when(commit, row)).alias("_commit"),
        F.max(F.when(~cancel, row)).alias("_last"),
    )


def _current(log: DataFrame) -> DataFrame:
    """Per (project, batch) the row that counts.

    Of a batch the attempt opened last counts. A cancel row ends that attempt if
    it came before the attempt's commit, and is void after it; otherwise the
    attempt's latest row counts.
    """
    names = [f.name for f in JOB_LOG_SCHEMA.fields]
    before = F.col("_commit").isNull() | (F.col(f"_cancel.{VERSION}") < F.col(f"_commit.{VERSION}"))
    job = F.when(F.col("_cancel").isNotNull() & before, F.col("_cancel")).otherwise(F.col("_last"))
    opened = F.struct(F.col(f"_first.{VERSION}"), "attempt")
    last = _attempts(log).groupBy("project_id", "batch_id").agg(F.max_by(job, opened).alias("_j"))
    return last.select(*[F.col(n) if n in ("project_id", "batch_id") else F.col(f"_j.{n}").alias(n) for n in names])


def read_batch_jobs(spark: SparkSession, jobs_path: str, latest: bool = True, project_id=None, version: int | None = None) -> DataFrame:
    """The batch-job log; by default the current row per (project, batch). ``version``: as of that version."""
    log = job_log(spark, jobs_path).read(version, project_id)
    return _current(log) if latest else log.drop(VERSION)


def record_job_status(spark: SparkSession, jobs_path: str, jobs: DataFrame, project_id=None) -> int:
    """Append changed job rows (e.g. from ``cancel_batches``) with a new time; returns their version."""
    now = F.lit(_now().strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    cols = [now.alias("created_at") if f.name == "created_at" else F.col(f.name) for f in JOB_LOG_SCHEMA.fields]
    return job_log(spark, jobs_path).append(jobs.select(*cols), project_id)


def compact_batch_jobs(spark: SparkSession, jobs_path: str, project_id) -> int:
    """Keep the rows that decide about a project's attempts, in place of the folders of its log that were read.

    Rows keep their versions, so what is appended meanwhile or later (a commit, a cancel) is judged as
    it would have been before. Another compaction that finished first is a LogConflict; nothing is lost then.
    Folders with rows of several projects stay as they are.
    """
    log = job_log(spark, jobs_path)
    read = [f for f in log.folders(project_id=project_id) if "project" in f]
    rows = F.array_distinct(F.array_compact(F.array("_first", "_cancel", "_commit", "_last")))
    kept = _attempts(log.read(folders=read)).select(F.explode(rows).alias("_row")).select("_row.*")
    return log.rewrite(kept.coalesce(1), read, project_id)


def read_task_requests(spark: SparkSession, path: str, outcome: str = ACCEPTED) -> DataFrame:
    """All requests of one outcome, with project, batch and attempt (no commit check)."""
    return spark.read.schema(REQUEST_SCHEMA).parquet(path).where(F.col("outcome") == F.lit(outcome))


def read_committed_requests(
    spark: SparkSession,
    path: str,
    jobs_path: str,
    data_schema: T.StructType | str | None = None,
    project_id=None,
    outcome: str = ACCEPTED,
) -> DataFrame:
    """Requests of committed attempts only (left-semi on the job table), accepted ones by default.

    One attempt can hold all requests, so they are not gathered by attempt: the attempts are counted and broadcast
    up to BROADCAST_BYTES, and joined to parts of each attempt's requests beyond. With ``data_schema`` the request JSON
    is parsed into ``data``/``priority``/``submit`` columns.
    """
    keys = ["project_id", "batch_id", "attempt"]
    jobs = read_batch_jobs(spark, jobs_path, project_id=project_id).where(~F.col("status").isin(OPENED, CANCELLED)).select(*keys)
    lines = filter_tasks(read_task_requests(spark, path, outcome), project_id=project_id)
    size = F.sum(F.octet_length(F.concat_ws("", *keys)) + _ATTEMPT_BYTES)
    if (jobs.agg(size).first()[0] or 0) <= BROADCAST_BYTES:
        lines = lines.join(F.broadcast(jobs), keys, "left_semi")
    else:
        lines = lines.withColumn("_part", F.col("_metadata.row_index") % ATTEMPT_PARTS)
        parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ATTEMPT_PARTS - 1).cast("long")))
        lines = lines.join(jobs.withColumn("_part", parts), [*keys, "_part"], "left_semi")
    lines = lines.select("value", "project_id", "batch_id", "outcome")
    if data_schema is None:
        return lines
    if isinstance(data_schema, str):
        data_schema = T.StructType.fromDDL(data_schema)
    request = T.StructType([T.StructField("data", data_schema), T.StructField("priority", T.IntegerType()), T.StructField("submit", T.BooleanType())])
    request = F.from_json("value", request)
    return lines.select("project_id", "batch_id", request.alias("r")).select("project_id", "batch_id", "r.*")
