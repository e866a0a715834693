"""State changes by position: bitmaps of deleted rows and small value files beside the task table.

A change names tasks by id. It is resolved once, when it is made, to the file and row that hold each task
(``locate``), by a scan that the table's bloom filters on ``id`` cut down to the row groups that can hold one of the
ids. Kept are positions only, in a versioned log (``sinks.versions``). A read folds them into

* one bitmap per file and 32,768 rows for the deletions,
* one value row per changed task (the latest rejection, the latest priority),

and looks each scanned row up by its own file and row number. These tables are as small as the changes: they are
counted first and broadcast up to BROADCAST_BYTES, and the task table is not shuffled; tables grown past
that bound are joined like any other, until a rewrite of the project takes the changes in.

A task that is written again stands in a new file: changes to the row it was before no longer touch it, and those to
rows of removed files are void. Ids that no stored task has change nothing.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.functions.filters import filter_tasks
from annotask.operators.changes import DELETE, PRIORITY, REJECT
from annotask.operators.mutations import REJECTED
from annotask.schema import STORED_TASK_SCHEMA, TASK_CHANGE_SCHEMA
from annotask.sinks.versions import VERSION, VersionedLog
from annotask.sources.pages import project_folder

# Up to so many ids are looked up by the files' bloom filters; a longer list is joined to the id column.
LOOKUP_IDS = 10_000
# Rows that one bitmap covers (that of Spark's bitmap functions).
BITMAP_ROWS = 32_768
# Bytes of bitmaps, or of values, that every task is given at most; about so many a row.
BROADCAST_BYTES = 32 << 20
_BITMAP_BYTES, _VALUE_BYTES = 4_400, 400
_PUSHED_IDS = "spark.sql.parquet.pushdown.inFilterThreshold"

POSITION_CHANGE_SCHEMA = T.StructType(
    [
        *(f for f in TASK_CHANGE_SCHEMA.fields if f.name != "id"),
        T.StructField("file", T.StringType()),
        T.StructField("row", T.LongType()),
    ]
)


def position_log(spark: SparkSession, path: str) -> VersionedLog:
    return VersionedLog(spark, path, POSITION_CHANGE_SCHEMA)


@contextmanager
def _id_lists_pushed(spark: SparkSession):
    """Let a list of ids reach the Parquet reader as one list, which bloom filters can answer.

    Lists longer than this setting are handed over whole; shorter ones become a chain of comparisons, nested once per
    id, whose visit overflows the stack from a few thousand ids on.
    """
    before = spark.conf.get(_PUSHED_IDS)
    spark.conf.set(_PUSHED_IDS, "1")
    try:
        yield
    finally:
        spark.conf.set(_PUSHED_IDS, before)


def _placed(spark: SparkSession, tasks_path: str, project_id) -> DataFrame | None:
    """A project's stored tasks with their file and row number; None where it has none."""
    stored = T.StructType([f for f in STORED_TASK_SCHEMA.fields if f.name != "project_id"])
    try:
        rows = spark.read.schema(stored).parquet(project_folder(tasks_path, project_id))
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    place = F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    return rows.select("*", F.lit(str(project_id)).alias("project_id"), *place)


def locate(spark: SparkSession, tasks_path: str, project_id, ids: DataFrame) -> DataFrame:
    """(id, file, row) of the project's tasks with one of the ids (a column ``id``).

    A short list reads the row groups whose bloom filter has one of them; the list is the caller's own, at
    most LOOKUP_IDS ids. A longer one reads the id column.
    """
    found = _placed(spark, tasks_path, project_id)
    if found is None:
        return spark.createDataFrame([], "id string, file string, row long")
    wanted = ids.select(F.col("id").cast("string").alias("id")).where("id is not null").distinct()
    short = [r.id for r in wanted.limit(LOOKUP_IDS + 1).collect()]
    if len(short) <= LOOKUP_IDS:
        hits = found.where(F.col("id").isin(short))
    else:
        hits = found.join(wanted, "id", "left_semi")
    return hits.select("id", F.col("_file").alias("file"), F.col("_row").alias("row"))


def record_position_changes(changes: DataFrame, tasks_path: str, path: str, project_id) -> int:
    """Resolve a project's changes (rows of the change log's layout) and append them; returns their version."""
    spark = changes.sparkSession
    own = changes.where(F.col("project_id") == F.lit(str(project_id)))
    with _id_lists_pushed(spark):
        places = locate(spark, tasks_path, project_id, own)
        return position_log(spark, path).append(own.join(places, "id"), project_id)


def deletion_bitmaps(changes: DataFrame) -> DataFrame:
    """(project_id, _file, _bucket, _gone): the deleted rows of each file, a bit each."""
    gone = changes.where(F.col("kind") == F.lit(DELETE)).select("project_id", "file", "row").distinct()
    bit = F.bitmap_construct_agg(F.bitmap_bit_position(F.col("row") + 1))
    return gone.groupBy("project_id", F.col("file").alias("_file"), F.floor(F.col("row") / BITMAP_ROWS).alias("_bucket")).agg(bit.alias("_gone"))


def _bit(bitmap: Column, position: Column) -> Column:
    octet = F.conv(F.hex(F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", octet, (position % 8).cast("int")) == 1


def read_tasks_at(spark: SparkSession, tasks_path: str, path: str, project_id, version: int | None = None, **filters) -> DataFrame:
    """A project's tasks as its position changes leave them (``version``: as that version of the log does).

    ``filters`` on unchanging columns (as of ``filter_tasks``) reach the scan.
    """
    rows = _placed(spark, tasks_path, project_id)
    if rows is None:
        return spark.createDataFrame([], STORED_TASK_SCHEMA)
    rows = filter_tasks(rows, **filters)
    changes = position_log(spark, path).read(version, project_id)
    deleted = F.col("kind") == F.lit(DELETE)
    counted = changes.agg(
        F.count_distinct(F.when(deleted, F.struct("file", F.floor(F.col("row") / BITMAP_ROWS)))).alias("bitmaps"),
        F.count_distinct(F.when(~deleted, F.struct("file", "row"))).alias("values"),
        F.max(F.when(~deleted, F.length(F.to_json("reasons")))).alias("longest"),
    ).first()

    def given(table: DataFrame, n: int, size: int) -> DataFrame:
        return F.broadcast(table) if n * size <= BROADCAST_BYTES else table

    bucket, at = F.floor(F.col("_row") / BITMAP_ROWS), F.col("_row") % BITMAP_ROWS
    bitmaps = given(deletion_bitmaps(changes), counted["bitmaps"], _BITMAP_BYTES)
    kept = rows.withColumn("_bucket", bucket).join(bitmaps, ["project_id", "_file", "_bucket"], "left")
    kept = kept.where(F.col("_gone").isNull() | ~_bit(F.col("_gone"), at))

    def latest(kind: str, value: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.struct(VERSION, "at", F.col(value).alias("value"))))

    values = changes.where(F.col("kind") != F.lit(DELETE)).groupBy("project_id", F.col("file").alias("_file"), F.col("row").alias("_row"))
    values = values.agg(latest(REJECT, "reasons").alias("_reject"), latest(PRIORITY, "priority").alias("_priority"))
    values = given(values, counted["values"], _VALUE_BYTES + (counted["longest"] or 0))
    met = kept.join(values, ["project_id", "_file", "_row"], "left")
    new = {
        "state": F.when(F.col("_reject").isNotNull(), F.lit(REJECTED)).otherwise(F.col("state")),
        "priority": F.when(F.col("_priority").isNotNull(), F.col("_priority.value")).otherwise(F.col("priority")),
        "reject_reasons": F.when(F.col("_reject").isNotNull(), F.col("_reject.value")).otherwise(F.col("reject_reasons")),
    }
    return met.select(*[new[c].alias(c) if c in new else F.col(c) for c in STORED_TASK_SCHEMA.names])
