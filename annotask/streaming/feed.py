"""Deliveries as a numbered feed: calls of exactly ``limit`` rows, and calls that can be read again.

:func:`publish` parses what has landed since it last ran, once for all consumers, and numbers each project's rows
without gaps in landing order: landing, file, line of the file, place in the page. The rows are kept as Parquet
by project, sorted by number, so a call opens only the row groups that hold its rows. A version of the feed names
the folder it added and the landing it reached (``sinks.versions``); of two publishers at once one makes
the version, and what the other wrote is never seen.

A consumer's cursor is a sequence of calls, each a range of numbers ``(after, upto]`` with the call's
filters. A call takes the range after the last one's, ending at its ``limit``-th matching row, wherever in a file or page
that row stands; the next call carries on in the middle of it. Making the call's record is what
moves the cursor: two calls at once cannot get the same rows, and a call that died before its record took none. A
call's rows are defined by its record, so they can be read again at any time: by number, or by the
name that the caller gave (:func:`read_call`); calling again under the same name gives the same rows.

As with every call, rows that fail the filters are consumed by the range that passes over them.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.functions.filters import filter_tasks
from annotask.operators.paging import rank_within
from annotask.schema import PAGE_RECORD_SCHEMA
from annotask.session import scratch_path
from annotask.sinks.versions import Numbered
from annotask.sources.landings import files_of, latest_landing, register_new
from annotask.sources.pages import JSON_OPTIONS, PAGE_LINE_SCHEMA, explode_all, page_lines, project_folder, rejects_of, rows_of
from annotask.streaming.deliveries import cursor_key

# Landings that one version takes in at most; further ones make further versions.
LANDINGS_PER_VERSION = 32
# Versions whose heads are looked up at a time.
VERSIONS_PER_STEP = 256
_PLACE = ("_landing", "_file", "_block", "_line")
_HEAD = "project_id string, first long, last long, version long"


def _versions(spark: SparkSession, feed_path: str) -> Numbered:
    return Numbered(spark, f"{feed_path}/versions")


def _feed_schema(record_schema: T.StructType) -> T.StructType:
    page = [T.StructField("result", T.StringType()), T.StructField("page", T.IntegerType()), T.StructField("position", T.IntegerType())]
    return T.StructType([*page, *record_schema.fields, T.StructField("seq", T.LongType())])


def _landed_pages(spark: SparkSession, landing_path: str, number: int) -> DataFrame:
    """A landing's pages with their place: its number, file, block of the file and order in it."""
    pages = spark.read.schema(PAGE_LINE_SCHEMA).options(**JSON_OPTIONS).json(files_of(spark, landing_path, number))
    placed = pages.select(
        "*",
        F.lit(number).alias("_landing"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return page_lines(placed)


def _heads(spark: SparkSession, feed_path: str, folders: list[str]) -> DataFrame:
    """Per project and version its first and last number there (first is null where it got no row)."""
    return spark.read.schema(_HEAD).parquet(*(f"{feed_path}/heads/{f}" for f in folders))


def publish(
    spark: SparkSession,
    landing_path: str,
    feed_path: str,
    discover: bool = True,
    record_schema: T.StructType = PAGE_RECORD_SCHEMA,
) -> int:
    """Bring the feed up to the newest landing; returns the feed's version (-1: nothing has landed yet).

    ``discover`` lists the landing for files that its writer did not register. What gives no row is kept for
    :func:`feed_rejects`.
    """
    if discover:
        register_new(spark, landing_path)
    versions, version = _versions(spark, feed_path), -1
    while True:
        version = versions.latest(version)
        before = versions.read(version) or {"landing": -1}
        newest = latest_landing(spark, landing_path, before["landing"])
        if newest == before["landing"]:
            return version
        upto = min(newest, before["landing"] + LANDINGS_PER_VERSION)
        folder = uuid.uuid4().hex
        _write_version(spark, landing_path, feed_path, before, upto, version + 1, folder, record_schema)
        versions.put(version + 1, {"landing": upto, "folder": folder})


def _write_version(spark, landing_path, feed_path, before, upto, version, folder, record_schema) -> None:
    landings = range(before["landing"] + 1, upto + 1)
    pages = reduce(DataFrame.unionByName, (_landed_pages(spark, landing_path, n) for n in landings))
    staged = scratch_path(spark, "feed-pages")
    explode_all(pages, "value", record_schema, keep=("result", "page", *_PLACE)).write.parquet(staged)
    found = spark.read.parquet(staged)
    rejects_of(found, record_schema).drop(*_PLACE).write.parquet(f"{feed_path}/rejects/{folder}")

    ranked = rank_within(rows_of(found), ["project_id"], [*_PLACE, "position"], rank_col="_rank")
    if "folder" in before:
        held = _heads(spark, feed_path, [before["folder"]]).select(F.col("project_id").alias("_of"), F.col("last").alias("_last"))
        ranked = ranked.join(held, F.col("project_id").eqNullSafe(F.col("_of")), "left")
    else:
        ranked = ranked.withColumn("_last", F.lit(0).cast("long"))
    rows = ranked.withColumn("seq", F.coalesce("_last", F.lit(0)) + F.col("_rank"))
    columns = [f.name for f in _feed_schema(record_schema).fields]
    target = f"{feed_path}/data/_version={folder}"
    rows.select(*columns).sortWithinPartitions("project_id", "seq").write.partitionBy("project_id").parquet(target)

    spans = spark.read.schema("project_id string, seq long").parquet(target)
    spans = spans.groupBy("project_id").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    if "folder" in before:
        spans = spans.unionByName(_heads(spark, feed_path, [before["folder"]]).select("project_id", F.lit(None).cast("long").alias("first"), "last"))
    heads = spans.groupBy("project_id").agg(F.max("first").alias("first"), F.max("last").alias("last"))
    # One row per project; a head is looked up by project.
    heads.withColumn("version", F.lit(version).cast("long")).sortWithinPartitions("project_id").write.parquet(f"{feed_path}/heads/{folder}")


def feed_rejects(spark: SparkSession, feed_path: str) -> DataFrame:
    """Records and bodies of all published landings that gave no row."""
    versions = _versions(spark, feed_path)
    folders = [versions.read(v)["folder"] for v in range(versions.latest() + 1)]
    schema = "result string, page int, position int, rejected string, text string"
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{feed_path}/rejects/{f}" for f in folders))


def read_feed(
    spark: SparkSession,
    feed_path: str,
    project_id,
    after: int = 0,
    upto: int | None = None,
    from_version: int = 0,
    record_schema: T.StructType = PAGE_RECORD_SCHEMA,
) -> tuple[DataFrame, int, int]:
    """A project's rows numbered ``after`` < seq <= ``upto`` (None: all there are), the last number among
    them (``after`` without any) and the version that holds it.

    ``from_version``: a version that no later row is older than. Only the folders that hold such rows are listed.
    """
    versions, schema = _versions(spark, feed_path), _feed_schema(record_schema)
    newest, spans = versions.latest(from_version - 1), []
    for start in range(from_version, newest + 1, VERSIONS_PER_STEP):
        names = [versions.read(v)["folder"] for v in range(start, min(start + VERSIONS_PER_STEP, newest + 1))]
        own = _heads(spark, feed_path, names).where((F.col("project_id") == F.lit(str(project_id))) & F.col("first").isNotNull())
        # One row per version that brought this project rows.
        found = sorted((r.version, r.first, r.last, names[r.version - start]) for r in own.select("version", "first", "last").collect())
        spans += [s for s in found if s[2] > after and (upto is None or s[1] <= upto)]
        if upto is not None and found and found[-1][2] >= upto:
            break
    if not spans:
        return spark.createDataFrame([], schema), after, from_version
    paths = [project_folder(f"{feed_path}/data/_version={folder}", project_id) for *_, folder in spans]
    stored = T.StructType([f for f in schema.fields if f.name != "project_id"])
    rows = spark.read.schema(stored).parquet(*paths).withColumn("project_id", F.lit(str(project_id)))
    last = spans[-1][2] if upto is None else min(spans[-1][2], upto)
    rows = rows.where((F.col("seq") > F.lit(int(after))) & (F.col("seq") <= F.lit(int(last))))
    return rows.select(*schema.names), last, spans[-1][0]


def read_whole_feed(spark: SparkSession, feed_path: str, record_schema: T.StructType = PAGE_RECORD_SCHEMA) -> DataFrame:
    """All projects' rows of the feed."""
    versions, schema = _versions(spark, feed_path), _feed_schema(record_schema)
    names = [versions.read(v)["folder"] for v in range(versions.latest() + 1)]
    if not names:
        return spark.createDataFrame([], schema)
    whole = spark.read.schema(schema).option("basePath", f"{feed_path}/data").parquet(*(f"{feed_path}/data/_version={n}" for n in names))
    return whole.select(*schema.names)


def _matching(rows: DataFrame, filters: dict) -> DataFrame:
    return filter_tasks(rows, **filters)


def _end(spark, feed_path, project_id, after, from_version, limit, filters, record_schema) -> tuple[int, int]:
    """The number of the ``limit``-th matching row after ``after``, else the last number; and its version."""
    if limit is None or not any(v is not None for v in filters.values()):
        upto = None if limit is None else after + limit
        return read_feed(spark, feed_path, project_id, after, upto, from_version, record_schema)[1:]
    width = 4 * limit
    while True:
        rows, last, version = read_feed(spark, feed_path, project_id, after, after + width, from_version, record_schema)
        first = _matching(rows, filters).select("seq").orderBy("seq").limit(limit).agg(F.count("*").alias("n"), F.max("seq").alias("seq")).first()
        if first["n"] == limit:
            return read_feed(spark, feed_path, project_id, after, first["seq"], from_version, record_schema)[1:]
        if last < after + width:
            return last, version
        width *= 4


def _cursor(spark, landing_path, feed_path, project_id, consumer) -> Numbered:
    return Numbered(spark, f"{feed_path}/cursors/{cursor_key(landing_path, project_id, consumer)}")


def _rows_of_call(spark, feed_path, project_id, record: dict, record_schema) -> DataFrame:
    rows, _, _ = read_feed(spark, feed_path, project_id, record["after"], record["upto"], record["from_version"], record_schema)
    return _matching(rows, record["filters"])


def _call_number(spark, cursor: Numbered, name: str) -> int | None:
    """The number of the cursor's call of that name; its records are searched as a table."""
    if cursor.latest() < 0:
        return None
    records = spark.read.schema("call string, number long").json(cursor.path).where(F.col("call") == F.lit(name))
    found = records.first()
    return None if found is None else found["number"]


def read_call(
    spark: SparkSession, landing_path: str, feed_path: str, project_id, call: int | str, consumer: str | None = None,
    record_schema: T.StructType = PAGE_RECORD_SCHEMA,
) -> DataFrame:
    """The rows that a call (its number from 0, or its name) returned."""
    cursor = _cursor(spark, landing_path, feed_path, project_id, consumer)
    number = _call_number(spark, cursor, call) if isinstance(call, str) else call
    record = None if number is None else cursor.read(number)
    if record is None:
        raise KeyError(f"no call {call!r} of this cursor")
    return _rows_of_call(spark, feed_path, project_id, record, record_schema)


def call_deliveries(
    spark: SparkSession,
    landing_path: str,
    feed_path: str,
    project_id,
    consumer: str | None = None,
    limit: int | None = None,
    call: str | None = None,
    batch_id=None,
    client_batch_id=None,
    client_batch_id_match_type=None,
    discover: bool = True,
    record_schema: T.StructType = PAGE_RECORD_SCHEMA,
) -> DataFrame:
    """The next ``limit`` matching deliveries (None: all) of a project for this consumer, with their number ``seq``.

    ``call`` names the call: if this cursor has one of that name already, its rows are returned
    again, whatever else is asked for. A call that finds nothing new leaves no record.
    """
    if limit is not None and int(limit) < 1:
        raise ValueError("the limit is at least 1")
    limit = None if limit is None else int(limit)
    cursor = _cursor(spark, landing_path, feed_path, project_id, consumer)
    if call is not None and (number := _call_number(spark, cursor, call)) is not None:
        return _rows_of_call(spark, feed_path, project_id, cursor.read(number), record_schema)
    publish(spark, landing_path, feed_path, discover, record_schema)
    filters = {"batch_id": batch_id, "client_batch_id": client_batch_id, "client_batch_id_match_type": client_batch_id_match_type}
    number = -1
    while True:
        number = cursor.latest(number)
        last = cursor.read(number) or {"upto": 0, "version": 0}
        upto, version = _end(spark, feed_path, project_id, last["upto"], last["version"], limit, filters, record_schema)
        if upto == last["upto"]:
            return spark.createDataFrame([], _feed_schema(record_schema))
        record = {
            "call": call, "number": number + 1, "after": last["upto"], "upto": upto, "filters": filters,
            "from_version": last["version"], "version": version,
        }
        if cursor.put(number + 1, record):
            return _rows_of_call(spark, feed_path, project_id, record, record_schema)
        # Another call of this cursor took these rows.
        if call is not None and (taken := _call_number(spark, cursor, call)) is not None:
            return _rows_of_call(spark, feed_path, project_id, cursor.read(taken), record_schema)
