"""Write task and delivery tables; turn landed pages into a Parquet table.

Tables are Parquet partitioned by ``project_id`` (a project filter prunes
folders). Rows are rebalanced by project first: adaptive execution puts small
projects into a task together and splits a large one over many, by measured
size, so the number of files follows the bytes and not tasks times projects.
Inside each write task rows are sorted by project and date, so Parquet
row-group statistics are tight on the date and date windows skip row groups; a
bloom filter on ``id`` lets id lookups skip row groups too.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annotask.functions.json import answers_to_json
from annotask.operators.changes import DELETE, apply_changes, change_log
from annotask.schema import AS_OF, DELIVERY_SCHEMA, PAGE_RECORD_SCHEMA, STORED_TASK_SCHEMA
from annotask.sinks.versions import VERSION, LogConflict
from annotask.sources.pages import explode_all, read_landing, read_page_files, rejects_of, rows_of


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the table layout, in order, cast to its types; absent → NULL."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _write(
    df: DataFrame, path: str, date_col: str, mode: str, max_records_per_file: int | None, by: tuple[str, ...] = ("project_id",),
    ranged: bool = False,
) -> None:
    order = ["project_id", date_col, "id"]
    writer = (
        (df.repartitionByRange(*order) if ranged else df.hint("rebalance", "project_id"))
        .sortWithinPartitions(*order)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        # Task ids are looked up one by one and in id lists; rows are sorted by
        # date, so min/max statistics cannot skip on id, a bloom filter can.
        .option("parquet.bloom.filter.enabled#id", "true")
        # As large as a row group's ids need, from 1 MB down to 256 bytes; of one size, each filter would take 1 MB.
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.bloom.filter.candidates.number#id", "13")
        .partitionBy(*by)
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    writer.parquet(path)


def write_tasks(
    df: DataFrame, path: str, mode: str = "overwrite", max_records_per_file: int | None = None, as_of: int | None = None,
    ranged: bool = False,
) -> None:
    """Write a task table; ``overwrite`` replaces only the projects present in ``df``.

    ``as_of``: the version of the change log that these tasks were read with (``changes_version``, then
    ``read_tasks(..., version=...)``): readers fold only later changes into them. ``ranged``: a project's files
    follow each other in listing order, so that a page by the rank index opens one or two of them.
    """
    rows = answers_to_json(_conform(df, STORED_TASK_SCHEMA)).withColumn(AS_OF, F.lit(as_of).cast("long"))
    _write(rows, path, "created_at", mode, max_records_per_file, ranged=ranged)


def write_deliveries(df: DataFrame, path: str, mode: str = "overwrite", max_records_per_file: int | None = None) -> None:
    _write(answers_to_json(_conform(df, DELIVERY_SCHEMA)), path, "delivered_at", mode, max_records_per_file)


def compact_changes(spark: SparkSession, tasks_path: str, changes_path: str, project_id) -> None:
    """Fold a project's changes into its part of the task table.

    One version of the log is read and folded; the tasks are written as of that
    version, and then the folders of that version that held the project alone are replaced in the
    log. What others append meanwhile is of a later version: it stays in the log and is
    folded into the rewritten tasks by every read. Deletions stay in the log: they also hold for a project
    that is left without tasks, whose folder no write replaces. A stop between the two writes does no harm,
    and of two compactions at once the second leaves the log as the first made it.
    """
    log = change_log(spark, changes_path)
    version = log.version()
    read = log.folders(version, project_id)
    changes = log.read(version, project_id)
    stored = T.StructType([*STORED_TASK_SCHEMA.fields, T.StructField(AS_OF, T.LongType())])
    tasks = spark.read.schema(stored).parquet(tasks_path)
    write_tasks(apply_changes(tasks, changes, project_id), tasks_path, as_of=version)
    own = [f for f in read if "project" in f]
    if own:
        kept = log.read(folders=own).where(F.col("kind") == DELETE)
        newest = F.max(VERSION).alias(VERSION)
        kept = kept.groupBy("project_id", "id", "kind", "reasons", "priority").agg(F.max("at").alias("at"), newest)
        try:
            log.rewrite(kept, own, project_id)
        except LogConflict:
            pass


def landing_name(landing_path: str) -> str:
    """The name under which a landing's rows are kept in a compacted table."""
    return hashlib.sha256(landing_path.rstrip("/").encode("utf-8")).hexdigest()[:16]


def compact_pages(
    spark: SparkSession,
    landing_path: str,
    out_path: str,
    record_schema: T.StructType = PAGE_RECORD_SCHEMA,
    rejects_path: str | None = None,
    lines: bool = True,
) -> None:
    """Parse landed pages (``lines``, or one body per file) once and keep the deliveries as Parquet.

    Later reads then get filter pushdown, column pruning and partition
    pruning, which JSON text cannot offer. The table is partitioned by project
    and landing: compacting a landing again replaces what it gave before, and
    other landings' rows stay. Records and bodies that give no row are written to
    ``rejects_path`` (default ``<out_path>_rejects``), by landing.
    """
    name = F.lit(landing_name(landing_path)).alias("landing")
    pages = read_landing(spark, landing_path) if lines else read_page_files(spark, landing_path)
    found = explode_all(pages, "value", record_schema, keep=("result", "page"))
    rows = answers_to_json(_conform(rows_of(found), DELIVERY_SCHEMA)).select("*", name)
    _write(rows, out_path, "delivered_at", "overwrite", None, ("project_id", "landing"))
    rejects = rejects_of(found, record_schema).select("*", name)
    rejects.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("landing").parquet(
        rejects_path or f"{out_path.rstrip('/')}_rejects"
    )
