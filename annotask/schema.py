"""Table layouts and fixed values shared by every operator.

Tasks, deliveries, batch jobs, projects and response logs are held as
tables; ``project_id`` is the partition column of every one of them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the annotation service's own values.
# ---------------------------------------------------------------------------
# Task states, in the service's order ("in progress" carries a space).
TASK_STATES = ("new", "in progress", "completed", "approved", "delivered", "acknowledged", "rejected")
# HTTP codes that are retried: rate limit, bad gateway, unavailable, gateway timeout.
RETRIABLE_STATUS = (429, 502, 503, 504)
# Retry policy: at most 5 tries, first wait 1 second, each wait doubled.
MAX_TRIES = 5
FIRST_DELAY_SECONDS = 1
BACKOFF_FACTOR = 2
# Page sizes of the service's listings.
MULTI_STATUS_PAGE_SIZE = 100
DELIVERED_PAGE_SIZE = 1000
# Prefix of pre-annotation input columns.
PREANNOTATION_PREFIX = "output_"
# Client batch id matching modes; None means "exact".
MATCH_TYPES = ("exact", "contains")
# date_type values and the column each one selects; None means creation date.
DATE_TYPES = {"creation_date": "created_at", "completion_date": "completed_at"}
# Defaults of a task request.
DEFAULT_PRIORITY = 0
DEFAULT_SUBMIT = False
DEFAULT_TASKS_FILE_NAME = "python_sdk"
# ---------------------------------------------------------------------------

STATE_COLUMN_NAMES = {s: "n_" + s.replace(" ", "_") for s in TASK_STATES}

TASK_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("project_id", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("client_batch_id", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("completed_at", T.TimestampNTZType()),
        T.StructField("data", T.StringType()),
        T.StructField("answers", T.StringType()),
    ]
)

# The stored task table also keeps why a task was rejected.
STORED_TASK_SCHEMA = T.StructType(TASK_SCHEMA.fields + [T.StructField("reject_reasons", T.ArrayType(T.StringType()))])

# A stored task's state takes in the change log up to this version (NULL: none of it).
AS_OF = "_as_of"

# Log of state changes to tasks.
TASK_CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("project_id", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("reasons", T.ArrayType(T.StringType())),
        T.StructField("priority", T.IntegerType()),
        T.StructField("at", T.TimestampNTZType()),
    ]
)

DELIVERY_SCHEMA = T.StructType(TASK_SCHEMA.fields + [T.StructField("delivered_at", T.TimestampNTZType())])

# Columns a single-task status carries when it is shaped "same as delivery".
DELIVERY_COLUMNS = ("id", "project_id", "batch_id", "client_batch_id", "state", "completed_at", "data", "answers")

BATCH_JOB_SCHEMA = T.StructType(
    [
        T.StructField("project_id", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("tasks_file_name", T.StringType()),
        T.StructField("notification_email", T.StringType()),
        T.StructField("n_tasks", T.LongType()),
        T.StructField("n_failed", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

# Rows of the job log also name the attempt at the batch they belong to.
JOB_LOG_SCHEMA = T.StructType(BATCH_JOB_SCHEMA.fields + [T.StructField("attempt", T.StringType())])

PROJECT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("asset_country_code", T.StringType()),
        T.StructField("project_group", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("client", T.StringType()),
    ]
)

RESPONSE_LOG_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)

# A task record as it appears inside a response page: answers stay raw JSON text.
PAGE_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("project_id", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("client_batch_id", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("completed_at", T.TimestampNTZType()),
        T.StructField("delivered_at", T.TimestampNTZType()),
        T.StructField("data", T.StringType()),
        T.StructField("answers", T.StringType()),
    ]
)

CORRUPT_FIELD = "_corrupt"

# One response body: ``{"task": T}`` or ``{"tasks": [T]}``, each record as its
# text; the last field receives a body that is not a JSON object.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("task", T.StringType()),
        T.StructField("tasks", T.ArrayType(T.StringType())),
        T.StructField(CORRUPT_FIELD, T.StringType()),
    ]
)
