"""Annotation tables derived from the driver's tables, in Spark and in SQL.

The driver's parquet tables stand in for a project's data:

* ``tasks`` from ``orders``: one task per order; project = customer key
  modulo 25 (so project ids line up with the 25 nation keys), batch =
  customer, client batch = order priority, state from the order status.
* ``line_tasks`` from ``lineitem``: one task per line, project = return flag,
  so every project holds about a third of all rows (the hot-key case).
* ``deliveries`` from ``events``: one delivery per event, answers = ``props``.
* ``inputs`` from ``documents`` left-joined to ``labels``: task inputs, the
  label as a JSON pre-annotation string.
* ``batch_jobs`` from ``customer``: one batch-creation job per customer.
* ``projects`` from ``nation`` and ``region``.
* ``response_log`` from ``events``: runs of 3, 4 or 5 consecutive event ids form
  one request (the run length depends on the user).

Each builder has a SQL twin (a CTE body) that DuckDB runs for the oracle, so
both sides compute the same table by the same rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annotask.schema import DEFAULT_TASKS_FILE_NAME

N_PROJECTS = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------- tasks
def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        (F.col("o_custkey") % N_PROJECTS).cast("string").alias("project_id"),
        F.col("o_custkey").cast("string").alias("batch_id"),
        F.col("o_orderpriority").alias("client_batch_id"),
        F.when(status == "O", "new").when(status == "P", "in progress").when(status == "F", "delivered").alias("state"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.col("o_orderdate").alias("created_at"),
        F.when(status == "F", F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("completed_at"),
        F.to_json(F.struct(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer_key"))).alias("data"),
        F.when(status == "F", F.to_json(F.struct(F.col("o_orderpriority").alias("label")))).alias("answers"),
    )


TASKS_SQL = f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
         CAST(o_custkey % {N_PROJECTS} AS VARCHAR) AS project_id,
         CAST(o_custkey AS VARCHAR) AS batch_id,
         o_orderpriority AS client_batch_id,
         CASE o_orderstatus WHEN 'O' THEN 'new' WHEN 'P' THEN 'in progress' WHEN 'F' THEN 'delivered' END AS state,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
         o_orderdate AS created_at,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END AS completed_at,
         json_object('order_key', o_orderkey, 'customer_key', o_custkey)::VARCHAR AS data,
         CASE WHEN o_orderstatus = 'F' THEN json_object('label', o_orderpriority)::VARCHAR END AS answers
  FROM orders"""


# --------------------------------------------------------------------------- line tasks (one hot project per return flag)
def line_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task per line item; project = return flag, so each project holds about a third of all rows."""
    li = table(spark, sf_dir, "lineitem")
    key = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return li.select(
        F.concat_ws("-", *key).alias("id"),
        F.col("l_returnflag").alias("project_id"),
        F.col("l_orderkey").cast("string").alias("batch_id"),
        F.col("l_linestatus").alias("client_batch_id"),
        F.when(F.col("l_linestatus") == "O", "new").otherwise("completed").alias("state"),
        F.col("l_shipdate").alias("created_at"),
    )


LINE_TASKS_SQL = """
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR)) AS id,
         l_returnflag AS project_id,
         CAST(l_orderkey AS VARCHAR) AS batch_id,
         l_linestatus AS client_batch_id,
         CASE WHEN l_linestatus = 'O' THEN 'new' ELSE 'completed' END AS state,
         l_shipdate AS created_at
  FROM lineitem"""


# --------------------------------------------------------------------------- deliveries
def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        (F.col("user_id") % N_PROJECTS).cast("string").alias("project_id"),
        F.col("user_id").cast("string").alias("batch_id"),
        F.col("event_type").alias("client_batch_id"),
        F.lit("delivered").alias("state"),
        F.lit(0).alias("priority"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("completed_at"),
        F.to_json(F.struct(F.col("event_id").alias("event_id"), F.col("user_id").alias("user_id"))).alias("data"),
        F.col("props").alias("answers"),
        F.col("ts").alias("delivered_at"),
    )


DELIVERIES_SQL = f"""
  SELECT CAST(event_id AS VARCHAR) AS id,
         CAST(user_id % {N_PROJECTS} AS VARCHAR) AS project_id,
         CAST(user_id AS VARCHAR) AS batch_id,
         event_type AS client_batch_id,
         'delivered' AS state,
         0 AS priority,
         ts AS created_at,
         ts AS completed_at,
         json_object('event_id', event_id, 'user_id', user_id)::VARCHAR AS data,
         props AS answers,
         ts AS delivered_at
  FROM events"""


# --------------------------------------------------------------------------- inputs
def inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left").select(
        "doc_id",
        "text",
        "lang",
        "source",
        "n_chars",
        F.when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), F.to_json(F.struct("quality", "toxic"))).alias(
            "output_label"
        ),
    )


INPUTS_SQL = """
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars,
         CASE WHEN l.quality IS NOT NULL OR l.toxic IS NOT NULL
              THEN json_object('quality', l.quality, 'toxic', l.toxic)::VARCHAR END AS output_label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


# --------------------------------------------------------------------------- batch jobs
def batch_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    return c.select(
        (F.col("c_custkey") % N_PROJECTS).cast("string").alias("project_id"),
        F.col("c_custkey").cast("string").alias("batch_id"),
        F.when(seg.isin("AUTOMOBILE", "BUILDING"), "completed")
        .when(seg == "FURNITURE", "processing")
        .when(seg == "HOUSEHOLD", "created")
        .otherwise("failed")
        .alias("status"),
        F.lit(DEFAULT_TASKS_FILE_NAME).alias("tasks_file_name"),
        F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com"))).alias(
            "notification_email"
        ),
        F.timestamp_add("SECOND", F.col("c_custkey"), F.lit("1994-12-01 00:00:00").cast("timestamp_ntz")).alias("created_at"),
    )


BATCH_JOBS_SQL = f"""
  SELECT CAST(c_custkey % {N_PROJECTS} AS VARCHAR) AS project_id,
         CAST(c_custkey AS VARCHAR) AS batch_id,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'completed'
              WHEN c_mktsegment = 'FURNITURE' THEN 'processing'
              WHEN c_mktsegment = 'HOUSEHOLD' THEN 'created'
              ELSE 'failed' END AS status,
         '{DEFAULT_TASKS_FILE_NAME}' AS tasks_file_name,
         CASE WHEN c_custkey % 3 <> 0 THEN lower(replace(c_name, '#', '.')) || '@example.com' END AS notification_email,
         TIMESTAMP '1994-12-01 00:00:00' + to_seconds(c_custkey) AS created_at
  FROM customer"""


# --------------------------------------------------------------------------- projects
def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        F.lit("active").alias("state"),
        F.lit("annotation").alias("type"),
        F.upper(F.substring("n_name", 1, 2)).alias("asset_country_code"),
        F.col("r_name").alias("project_group"),
        F.concat(F.lit("Labelling work for "), F.col("n_name")).alias("description"),
        F.concat(F.lit("client-"), F.col("n_regionkey").cast("string")).alias("client"),
    )


PROJECTS_SQL = """
  SELECT CAST(n.n_nationkey AS VARCHAR) AS id,
         n.n_name AS name,
         'active' AS state,
         'annotation' AS type,
         upper(substr(n.n_name, 1, 2)) AS asset_country_code,
         r.r_name AS project_group,
         'Labelling work for ' || n.n_name AS description,
         'client-' || CAST(n.n_regionkey AS VARCHAR) AS client
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""


# --------------------------------------------------------------------------- response log
def response_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    status = (
        F.when(kind == "error", F.lit(503)).when(kind == "click", F.lit(429)).when(kind == "signup", F.lit(404)).otherwise(F.lit(200))
    )
    size = F.col("user_id") % 3 + 3  # a user's requests take 3, 4 or 5 attempt slots
    return e.select(
        F.concat(F.lit("req-"), size.cast("string"), F.lit("-"), F.expr("event_id div (user_id % 3 + 3)").cast("string")).alias(
            "request_id"
        ),
        (F.col("event_id") % size + 1).cast("int").alias("attempt"),
        F.col("ts").alias("at"),
        status.cast("int").alias("status"),
        F.when(status == 200, F.col("props")).alias("body"),
    )


RESPONSE_LOG_SQL = """
  SELECT 'req-' || CAST(user_id % 3 + 3 AS VARCHAR) || '-' || CAST(event_id // (user_id % 3 + 3) AS VARCHAR) AS request_id,
         CAST(event_id % (user_id % 3 + 3) + 1 AS INTEGER) AS attempt,
         ts AS "at",
         CAST(CASE event_type WHEN 'error' THEN 503 WHEN 'click' THEN 429 WHEN 'signup' THEN 404 ELSE 200 END AS INTEGER) AS status,
         CASE WHEN event_type NOT IN ('error', 'click', 'signup') THEN props END AS body
  FROM events"""


def with_views(sql: str, *names: str) -> str:
    """Prefix a query with the CTEs of the derived tables it names."""
    bodies = {
        "tasks": TASKS_SQL,
        "line_tasks": LINE_TASKS_SQL,
        "deliveries": DELIVERIES_SQL,
        "inputs": INPUTS_SQL,
        "batch_jobs": BATCH_JOBS_SQL,
        "projects": PROJECTS_SQL,
        "response_log": RESPONSE_LOG_SQL,
    }
    ctes = ",\n".join(f"{n} AS ({bodies[n]}\n)" for n in names)
    return f"WITH {ctes}\n{sql}"
