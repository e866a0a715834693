"""Response log: classify responses, decide each request, queue the retries.

``response_log(request_id, attempt, at, status, body)`` holds one row per
HTTP attempt. A status of NULL is a connection error. Retriable responses
(rate limit, 502/503/504, no status) are tried again up to the try limit, with
exponential waits (1 s, 2 s, 4 s, 8 s); any other 4xx/5xx is a failure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annotask.functions.filters import timestamp_literal
from annotask.schema import BACKOFF_FACTOR, FIRST_DELAY_SECONDS, MAX_TRIES, RETRIABLE_STATUS

OK, RETRY, FAILED = "ok", "retry", "failed"
FINISHED, EXHAUSTED = "finished", "exhausted"


def response_class(status="status") -> Column:
    """``retry`` for retriable codes and connection errors, ``failed`` for
    other codes ≥ 400, else ``ok``."""
    status = F.col(status) if isinstance(status, str) else status
    return (
        F.when(status.isNull() | status.isin(*RETRIABLE_STATUS), F.lit(RETRY))
        .when(status >= 400, F.lit(FAILED))
        .otherwise(F.lit(OK))
    )


def backoff_seconds(attempt="attempt") -> Column:
    """Wait before the try after ``attempt``: first delay × factor^(attempt-1)."""
    attempt = F.col(attempt) if isinstance(attempt, str) else attempt
    return (F.lit(FIRST_DELAY_SECONDS) * F.pow(F.lit(BACKOFF_FACTOR), attempt - 1)).cast("bigint")


def classify_responses(log: DataFrame) -> DataFrame:
    """Add ``outcome`` (ok / retry / failed) to every logged attempt."""
    return log.withColumn("outcome", response_class("status"))


def request_outcomes(log: DataFrame, max_tries: int = MAX_TRIES) -> DataFrame:
    """One row per request: ``finished``, ``failed``, ``retry`` or ``exhausted``.

    The first non-retriable response decides a request (later rows are
    ignored). Without one, the request is ``retry`` while its last attempt is
    below the try limit, with ``next_at`` = last attempt time + backoff, and
    ``exhausted`` after that. One aggregation per request id with partial
    merge: a request with very many rows is pre-aggregated in every task.
    """
    cls = response_class("status")
    # Any integer or NULL may be a status; NULL comes after all codes.
    row = F.struct(F.col("attempt"), F.col("status").isNull().alias("no_status"), F.col("status"), F.col("at"))
    agg = log.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n_attempts"),
        F.min(F.when(cls != F.lit(RETRY), row)).alias("_d"),
        F.max(row).alias("_l"),
    )
    has_decision = F.col("_d").isNotNull()
    d_status, l_attempt = F.col("_d.status"), F.col("_l.attempt")
    outcome = (
        F.when(has_decision & (response_class(d_status) == F.lit(OK)), F.lit(FINISHED))
        .when(has_decision, F.lit(FAILED))
        .when(l_attempt >= max_tries, F.lit(EXHAUSTED))
        .otherwise(F.lit(RETRY))
    )
    next_at = F.when(
        ~has_decision & (l_attempt < max_tries),
        F.timestamp_add("SECOND", backoff_seconds(l_attempt), F.col("_l.at")),
    )
    return agg.select(
        "request_id",
        F.col("n_attempts").cast("bigint").alias("n_attempts"),
        outcome.alias("outcome"),
        F.when(has_decision, F.col("_d.attempt")).otherwise(l_attempt).alias("attempt"),
        F.when(has_decision, d_status).otherwise(F.col("_l.status")).alias("status"),
        F.when(has_decision, F.col("_d.at")).otherwise(F.col("_l.at")).alias("at"),
        next_at.alias("next_at"),
    )


def retry_queue(log: DataFrame, max_tries: int = MAX_TRIES, as_of=None) -> DataFrame:
    """Requests to try again: last attempt, its status, and when to retry.

    With ``as_of`` (RFC3339 text or a datetime) only the retries already due
    at that time are kept (``next_at <= as_of``).
    """
    out = request_outcomes(log, max_tries).where(F.col("outcome") == F.lit(RETRY))
    if as_of is not None:
        out = out.where(F.col("next_at") <= timestamp_literal(as_of, out.schema["next_at"].dataType))
    return out.select(
        "request_id",
        "attempt",
        "status",
        "at",
        "next_at",
        (F.col("attempt") + 1).cast("int").alias("next_attempt"),
    )
