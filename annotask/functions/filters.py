"""Task filters (project, batch, client batch, date window, state, task id).

Every filter is a plain Column predicate, folded with ``&``; a ``None``
argument adds nothing. Predicates on plain columns reach the Parquet scan as
pushed filters, and ``project_id`` is the partition column, so a project
filter prunes whole folders.
"""

from __future__ import annotations

import datetime as _dt
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.schema import DATE_TYPES, MATCH_TYPES

_RFC3339 = re.compile(
    r"^(\d{4})-(\d{2})-(\d{2})(?:[Tt ](\d{2}):(\d{2})(?::(\d{2})(?:\.(\d+))?)?)?"
    r"(?:([Zz])|([+-])(\d{2}):?(\d{2}))?$"
)


def parse_timestamp(value) -> _dt.datetime:
    """RFC3339 text (or a datetime) → naive UTC datetime at microseconds.

    Fractions beyond microseconds are truncated, as Spark keeps µs.
    """
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return value
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day)
    m = _RFC3339.match(str(value).strip())
    if not m:
        raise ValueError(f"not an RFC3339 timestamp: {value!r}")
    year, month, day, hh, mm, ss, frac, zulu, sign, oh, om = m.groups()
    micros = int((frac or "0")[:6].ljust(6, "0"))
    out = _dt.datetime(int(year), int(month), int(day), int(hh or 0), int(mm or 0), int(ss or 0), micros)
    if sign:
        offset = _dt.timedelta(hours=int(oh), minutes=int(om))
        out = out - offset if sign == "+" else out + offset
    return out


def timestamp_literal(value, data_type: T.DataType = T.TimestampNTZType()) -> Column:
    """A bound as a literal of the compared column's type (UTC wall time)."""
    text = parse_timestamp(value).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(data_type, T.TimestampType):
        return F.lit(text.replace(" ", "T") + "Z").cast(T.TimestampType())
    return F.lit(text).cast(T.TimestampNTZType())


_RFC3339_SQL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$"
_EPOCH_NTZ = "1970-01-01 00:00:00"
# The service's own spelling, which a cast reads as it is.
_PLAIN_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?Z?$"


def rfc3339_column(column, data_type: T.DataType = T.TimestampNTZType()) -> Column:
    """RFC3339 text column → timestamp; any fraction length (cut to µs), any offset.

    Text without an offset is read as UTC, a date as its first moment; text
    that is no timestamp gives NULL. The result does not depend on the
    session time zone: NTZ values hold UTC wall time.
    """
    column = F.col(column) if isinstance(column, str) else column
    wall = F.substring_index(column, "Z", 1)
    if isinstance(data_type, T.TimestampType):
        wall = F.concat(wall, F.lit("Z"))
    return F.when(column.rlike(_PLAIN_TIME), wall.try_cast(data_type)).otherwise(_any_rfc3339(column, data_type))


def _any_rfc3339(column: Column, data_type: T.DataType) -> Column:
    text = F.regexp_replace(F.upper(F.trim(column)), r"(\.\d{6})\d+", "$1")
    text = F.regexp_replace(text, r"^(\d{4}-\d{2}-\d{2})(Z|[+-]\d{2}:?\d{2})?$", "$1T00:00:00$2")
    text = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    # The same texts as parse_timestamp; anything else is NULL.
    instant = F.when(text.rlike(_RFC3339_SQL), text.try_cast(T.TimestampType()))
    if isinstance(data_type, T.TimestampType):
        return instant
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit(_EPOCH_NTZ).cast(T.TimestampNTZType()))


def _state_value(state) -> str:
    return getattr(state, "value", state)


def _field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def client_batch_predicate(client_batch_id: str, match_type: str | None) -> Column:
    """``exact`` equality or ``contains`` as a literal substring (no wildcards)."""
    mode = match_type or "exact"
    if mode not in MATCH_TYPES:
        raise ValueError(f"client_batch_id_match_type must be one of {MATCH_TYPES}, got {match_type!r}")
    column = F.col("client_batch_id")
    if mode == "exact":
        return column == F.lit(client_batch_id)
    return column.contains(F.lit(client_batch_id))


def date_column(date_type: str | None) -> str:
    if date_type is None:
        return DATE_TYPES["creation_date"]
    if date_type not in DATE_TYPES:
        raise ValueError(f"date_type must be one of {tuple(DATE_TYPES)}, got {date_type!r}")
    return DATE_TYPES[date_type]


def task_predicate(
    df: DataFrame,
    project_id=None,
    batch_id=None,
    client_batch_id=None,
    client_batch_id_match_type=None,
    date_type=None,
    from_timestamp=None,
    to_timestamp=None,
    state=None,
    task_id=None,
    date_col: str | None = None,
) -> Column | None:
    """Conjunction of the given filters; ``None`` when no filter is given.

    Date bounds are strict: a row passes when its date is after ``from`` and
    before ``to``.
    """
    parts: list[Column] = []
    if project_id is not None:
        parts.append(F.col("project_id") == F.lit(str(project_id)))
    if batch_id is not None:
        parts.append(F.col("batch_id") == F.lit(str(batch_id)))
    if client_batch_id is not None:
        parts.append(client_batch_predicate(client_batch_id, client_batch_id_match_type))
    if from_timestamp is not None or to_timestamp is not None:
        name = date_col or date_column(date_type)
        dtype = _field_type(df, name)
        if from_timestamp is not None:
            parts.append(F.col(name) > timestamp_literal(from_timestamp, dtype))
        if to_timestamp is not None:
            parts.append(F.col(name) < timestamp_literal(to_timestamp, dtype))
    if state is not None:
        parts.append(F.col("state") == F.lit(_state_value(state)))
    if task_id is not None:
        parts.append(F.col("id") == F.lit(str(task_id)))
    if not parts:
        return None
    return reduce(lambda a, b: a & b, parts)


def filter_tasks(df: DataFrame, **filters) -> DataFrame:
    """Apply :func:`task_predicate`; no filter → the input unchanged."""
    predicate = task_predicate(df, **filters)
    return df if predicate is None else df.filter(predicate)
