"""Task requests: every input column under ``data``, plus priority and submit.

The request is built on executors with native expressions; ``to_json``
writes null inputs as explicit JSON ``null`` (unless ``drop_nulls``), keeps
integers as integers and structs as objects, and writes VARIANT
pre-annotations as nested JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annotask.functions.json import parse_preannotations
from annotask.schema import DEFAULT_PRIORITY, DEFAULT_SUBMIT, PREANNOTATION_PREFIX


def task_requests(
    df: DataFrame,
    priority: int = DEFAULT_PRIORITY,
    submit: bool = DEFAULT_SUBMIT,
    keep: tuple[str, ...] = (),
    request_col: str = "request",
) -> DataFrame:
    """Wrap the input columns as ``struct<data, priority, submit>``.

    Columns named in ``keep`` stay beside the request (e.g. a partition
    column) and are not put into ``data``; all others are, whatever their name.
    """
    data_cols = [c for c in df.columns if c not in keep]
    request = F.struct(
        F.struct(*[F.col(f"`{c}`") for c in data_cols]).alias("data"),
        F.lit(int(priority)).cast("int").alias("priority"),
        F.lit(bool(submit)).alias("submit"),
    )
    return df.select(*[F.col(f"`{c}`") for c in keep if c in df.columns], request.alias(request_col))


def request_json(column="request", drop_nulls: bool = False) -> Column:
    """The request as JSON text; null inputs kept as ``null`` unless dropped."""
    column = F.col(column) if isinstance(column, str) else column
    return F.to_json(column, {"ignoreNullFields": "true" if drop_nulls else "false"})


def task_request_json(
    df: DataFrame,
    priority: int = DEFAULT_PRIORITY,
    submit: bool = DEFAULT_SUBMIT,
    prefix: str = PREANNOTATION_PREFIX,
    on_error: str = "fail",
    drop_nulls: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Decode pre-annotations, wrap, serialise: one JSON request per input row.

    With ``on_error="reject"`` the result has a boolean column ``_invalid``;
    an input column of that name is input data like any other.
    """
    flag = "_invalid"
    while flag in df.columns:
        flag += "_"
    parsed = parse_preannotations(df, prefix=prefix, on_error=on_error, flag=flag)
    marks = (flag,) if flag in parsed.columns else ()
    wrapped = task_requests(parsed, priority=priority, submit=submit, keep=(*keep, *marks))
    return wrapped.select(
        *[F.col(f"`{c}`") for c in keep if c in df.columns],
        *[F.col(m).alias("_invalid") for m in marks],
        request_json("request", drop_nulls).alias("request_json"),
    )
