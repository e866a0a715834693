"""One object per project space, with the service client's method names.

``AnnotationTables`` holds the locations of the tables (tasks, deliveries,
landed pages, task requests, batch jobs, projects) and exposes each client
call as a Spark operation: the ``*_to_table`` reads return lazy DataFrames,
batch creation writes files on the executors. State changes (reject, priorities,
delete) are appended to the change log of the project, if ``changes_path`` is set,
and every later read shows them; they return the project's tasks as they are then.
Calls that take ``spark`` use that session.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.operators import changes, mutations, stats
from annotask.operators.keys import id_frame
from annotask.operators.paging import read_page
from annotask.schema import DEFAULT_PRIORITY, DEFAULT_SUBMIT, DELIVERED_PAGE_SIZE, MULTI_STATUS_PAGE_SIZE, PROJECT_SCHEMA
from annotask.sinks.batches import REJECTED, read_batch_jobs, read_committed_requests, record_job_status, write_task_batch
from annotask.sources import tables
from annotask.sources.pages import explode_envelope, read_landing, variant_type
from annotask.streaming.deliveries import deliveries_since_last_call
from annotask.streaming.feed import call_deliveries


@dataclass
class AnnotationTables:
    spark: SparkSession
    tasks_path: str | None = None
    deliveries_path: str | None = None
    landing_path: str | None = None
    requests_path: str | None = None
    jobs_path: str | None = None
    projects_path: str | None = None
    changes_path: str | None = None
    feed_path: str | None = None

    # ------------------------------------------------------------------ tables
    def tasks(self, project_id=None, spark: SparkSession | None = None) -> DataFrame:
        path = self._need(self.tasks_path, "tasks_path")
        return tables.read_tasks(spark or self.spark, path, self.changes_path, project_id)

    def deliveries(self, spark: SparkSession | None = None) -> DataFrame:
        """The Parquet deliveries table, or the landed pages when there is none."""
        spark = spark or self.spark
        if self.deliveries_path is None and self.landing_path is not None:
            return explode_envelope(read_landing(spark, self.landing_path), "value", keep=()).drop("position")
        return tables.read_deliveries(spark, self._need(self.deliveries_path, "deliveries_path"))

    def jobs(self) -> DataFrame:
        return read_batch_jobs(self.spark, self._need(self.jobs_path, "jobs_path"))

    def projects(self) -> DataFrame:
        return self.spark.read.schema(PROJECT_SCHEMA).parquet(self._need(self.projects_path, "projects_path"))

    @staticmethod
    def _need(value, name):
        if value is None:
            raise ValueError(f"{name} is not set")
        return value

    # ------------------------------------------------------------------ create
    def create_task_batch_from_table(
        self,
        spark_dataframe: DataFrame,
        project_id: str,
        batch_priority: int = DEFAULT_PRIORITY,
        notification_email: str | None = None,
        submit: bool = DEFAULT_SUBMIT,
        batch_id: str | None = None,
        **options,
    ) -> dict:
        """Write the rows as one committed batch; returns the job row."""
        return write_task_batch(
            spark_dataframe,
            self._need(self.requests_path, "requests_path"),
            project_id,
            batch_id or uuid.uuid4().hex,
            priority=batch_priority,
            submit=submit,
            notification_email=notification_email,
            jobs_path=self._need(self.jobs_path, "jobs_path"),
            **options,
        )

    def create_task_batch(
        self,
        project_id: str,
        task_data_records: list[dict],
        batch_priority: int = DEFAULT_PRIORITY,
        notification_email: str | None = None,
        submit: bool = DEFAULT_SUBMIT,
        batch_id: str | None = None,
        **options,
    ) -> dict:
        """The same for records in the driver's memory: one DataFrame, with a column for each
        name that occurs. Nested values become JSON values of the request."""
        names = list(dict.fromkeys(name for record in task_data_records for name in record))
        texts = [tuple(json.dumps(r[n]) if n in r else None for n in names) for r in task_data_records]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        frame = self.spark.createDataFrame(texts, schema)
        frame = frame.select(*[F.parse_json(F.col(f"`{n}`")).alias(n) for n in names])
        return self.create_task_batch_from_table(
            frame, project_id, batch_priority, notification_email, submit, batch_id, **options
        )

    # ------------------------------------------------------------------ reads
    def get_delivered_tasks_to_table(
        self, spark=None, project_id=None, batch_id=None, client_batch_id=None, client_batch_id_match_type=None,
        from_timestamp=None, task_id=None,
    ) -> DataFrame:
        return tables.delivered_tasks(
            self.deliveries(spark), project_id=project_id, batch_id=batch_id, client_batch_id=client_batch_id,
            client_batch_id_match_type=client_batch_id_match_type, from_timestamp=from_timestamp, task_id=task_id,
            compact=False,
        )

    def get_delivered_tasks_since_last_call_to_table(
        self, spark=None, project_id=None, batch_id=None, client_batch_id=None, client_batch_id_match_type=None,
        consumer=None, limit=None, call=None,
    ) -> DataFrame:
        """With ``feed_path`` set: at most ``limit`` rows in landing order, and a call can be named, to be read again."""
        if self.feed_path is not None:
            return call_deliveries(
                spark or self.spark, self._need(self.landing_path, "landing_path"), self.feed_path, project_id, consumer,
                limit, call, batch_id, client_batch_id, client_batch_id_match_type,
            )
        if limit is not None or call is not None:
            raise ValueError("feed_path is not set: limits and named calls need it")
        return deliveries_since_last_call(
            spark or self.spark, self._need(self.landing_path, "landing_path"), consumer=consumer,
            project_id=project_id, batch_id=batch_id, client_batch_id=client_batch_id,
            client_batch_id_match_type=client_batch_id_match_type,
        )

    def get_task_status_to_table(self, spark=None, project_id=None, task_id=None, same_as_delivery=True) -> DataFrame:
        return tables.task_status(self.tasks(project_id, spark), task_id, same_as_delivery=same_as_delivery, compact=False)

    def get_multi_task_status_to_table(
        self, spark=None, project_id=None, batch_id=None, client_batch_id=None, client_batch_id_match_type=None,
        date_type=None, from_timestamp=None, to_timestamp=None, state=None, omit_answers=True,
    ) -> DataFrame:
        return tables.multi_task_status(
            self.tasks(project_id, spark), batch_id=batch_id, client_batch_id=client_batch_id,
            client_batch_id_match_type=client_batch_id_match_type, date_type=date_type,
            from_timestamp=from_timestamp, to_timestamp=to_timestamp, state=state, omit_answers=omit_answers,
            compact=False,
        )

    def get_multi_task_status_page(self, project_id, page: int = 1, page_size: int = MULTI_STATUS_PAGE_SIZE, **filters) -> DataFrame:
        """One page of the multi-task status listing (by creation time, then id), per project."""
        rows = self.get_multi_task_status_to_table(self.spark, project_id, **filters)
        return read_page(rows, page, page_size, ("project_id",), ("created_at", "id"))

    def get_delivered_tasks_page(self, project_id, page: int = 1, page_size: int = DELIVERED_PAGE_SIZE, **filters) -> DataFrame:
        """One page of the delivered-task listing (by delivery time, then id), per project."""
        rows = self.get_delivered_tasks_to_table(self.spark, project_id, **filters)
        return read_page(rows, page, page_size, ("project_id",), ("delivered_at", "id"))

    # ------------------------------------------------------------------ changes
    def _changed(self, log: DataFrame, project_id) -> DataFrame:
        """Record the changes and return the project's tasks with them; without a
        change log, only the latter, for the caller to write."""
        if self.changes_path is None:
            return changes.apply_changes(self.tasks(project_id), log)
        changes.record_changes(log, self.changes_path, project_id)
        return self.tasks(project_id)

    def reject_task(self, project_id, task_id, reasons) -> DataFrame:
        why = F.array(*[F.lit(str(r)) for r in reasons]).cast("array<string>")
        rejections = id_frame(self.spark, [task_id], "id").withColumn("reasons", why)
        return self._changed(changes.rejection_changes(rejections, project_id), project_id)

    def reject_tasks(self, project_id, rejections: DataFrame) -> DataFrame:
        return self._changed(changes.rejection_changes(rejections, project_id), project_id)

    def update_task_priorities(self, project_id, task_ids, priority: int) -> DataFrame:
        return self._changed(changes.priority_changes(self.spark, task_ids, project_id, priority), project_id)

    def delete_tasks(self, project_id, task_ids) -> DataFrame:
        return self._changed(changes.deletion_changes(self.spark, task_ids, project_id), project_id)

    def cancel_batch_creation_job(self, project_id, batch_id) -> DataFrame:
        """Cancel an unfinished job: its new status row is appended to the job log
        (readers of committed batches stop seeing it); returns the job's row."""
        jobs = self.jobs().where((F.col("project_id") == str(project_id)) & (F.col("batch_id") == str(batch_id)))
        changed = mutations.cancel_batches(jobs, [batch_id], project_id=project_id).where(F.col("status") == mutations.CANCELLED)
        record_job_status(self.spark, self._need(self.jobs_path, "jobs_path"), changed, project_id)
        return self.jobs().where((F.col("project_id") == str(project_id)) & (F.col("batch_id") == str(batch_id)))

    # ------------------------------------------------------------------ reports
    def get_status_batch_creation_job(self, project_id, batch_id) -> DataFrame:
        return stats.batch_status(self.jobs(), self.tasks(project_id), project_id=project_id, batch_id=batch_id)

    def get_status_batch_creation_job_detail(self, project_id, batch_id, omit_failed_task_data=False) -> DataFrame:
        """The batch's tasks, and the inputs that did not become tasks, as failed ones."""
        rejected = None
        if self.requests_path is not None:
            rejected = read_committed_requests(self.spark, self.requests_path, self.jobs_path, project_id=project_id, outcome=REJECTED)
        return stats.batch_task_detail(
            self.jobs(), self.tasks(project_id), omit_failed_task_data, project_id, batch_id, rejected_requests=rejected
        )

    def get_creation_task_schema(self, project_id) -> DataFrame:
        """Field profile of the committed task inputs of a project (schema inferred from the requests)."""
        requests = read_committed_requests(
            self.spark, self._need(self.requests_path, "requests_path"), self._need(self.jobs_path, "jobs_path"), project_id=project_id
        )
        found = requests.select(F.schema_of_variant_agg(F.try_parse_json("value"))).first()[0]
        data = variant_type(found)
        data = data["data"].dataType if "data" in data.names else T.StructType([])
        parsed = requests.select(F.from_json("value", T.StructType([T.StructField("data", data)])).alias("r"))
        return stats.creation_schema(parsed.select("r.data.*"))

    def get_delivery_task_schema(self, project_id) -> DataFrame:
        return stats.delivery_schema(self.deliveries(), project_id=project_id, infer_types=True)

    def get_project_information(self, project_id) -> DataFrame:
        return stats.project_information(self.projects(), project_id)

    def get_project_stats(self, project_id, from_timestamp=None, to_timestamp=None) -> DataFrame:
        return stats.project_stats(self.tasks(), project_id=project_id, from_timestamp=from_timestamp, to_timestamp=to_timestamp)
