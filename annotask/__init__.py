"""Annotation-task data on Spark: task tables, deliveries, batches and reports.

Every operator is a DataFrame transformation that runs on the executors.
"""

from annotask.api import AnnotationTables
from annotask.functions.filters import filter_tasks, task_predicate
from annotask.functions.json import answers_to_json, compact_json, parse_preannotations
from annotask.operators.mutations import cancel_batches, delete_tasks, reject_tasks, update_priorities
from annotask.operators.paging import page_completeness, paginate, rank_within, read_page
from annotask.operators.requests import task_request_json, task_requests
from annotask.operators.retry import classify_responses, request_outcomes, retry_queue
from annotask.operators.stats import (
    batch_status,
    batch_task_detail,
    creation_schema,
    delivery_schema,
    project_information,
    project_state_counts,
    project_stats,
)
from annotask.schema import TASK_STATES
from annotask.sinks.batches import read_committed_requests, write_task_batch
from annotask.sinks.tables import compact_pages, write_deliveries, write_tasks
from annotask.sources.pages import explode_envelope, infer_task_schema, read_task_pages
from annotask.sources.tables import delivered_tasks, multi_task_status, read_deliveries, read_tasks, task_status
from annotask.streaming.deliveries import deliveries_since_last_call, start_delivery_stream
from annotask.streaming.task_batches import stream_task_batches

__all__ = [name for name in dir() if not name.startswith("_")]
