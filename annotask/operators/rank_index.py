"""Pages of a stored table by a rank index: page k of a project opens the files that hold it, and no others.

The index has one row per file: how many rows it has, and the smallest and largest rank
that any of them can have among its project's rows in listing order. The ranks follow from the files' row counts and
first and last keys alone: a row of a file comes after all rows of the files that end before it begins, and
before those of the files that begin after it ends. So a page's rows are in the files whose span of ranks meets
the page's, files whose span ends before it only count, and the index stays exact where files overlap; the less they do,
the fewer a page opens (``write_tasks(..., ranged=True)`` writes files that do not).

The table itself is neither copied nor sorted: the index reads the key columns once, and later
only those of files that it does not know yet (files are never changed, only added and removed).
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annotask.operators.page_runs import running_within
from annotask.schema import STORED_TASK_SCHEMA
from annotask.sinks.versions import Numbered
from annotask.sources.pages import project_folder

ORDER = ("created_at", "id")


def _versions(spark: SparkSession, path: str, order: tuple[str, ...]) -> Numbered:
    return Numbered(spark, f"{path.rstrip('/')}/_rank_index/{'-'.join(order)}/versions")


def _stored(spark: SparkSession, path: str, order: tuple[str, ...], folder: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/_rank_index/{'-'.join(order)}/{folder}")


def task_files(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """A stored task table, or only some of its files."""
    reader = spark.read.schema(STORED_TASK_SCHEMA).option("basePath", path)
    return reader.parquet(*(files or [path]))


def rank_spans(files: DataFrame) -> DataFrame:
    """``files(project_id, file, n, first, last)`` with ``from_rank`` and ``to_rank``: the ranks its rows can have."""
    begin = F.struct(F.col("first").alias("key"), F.lit(0).alias("kind"), "file", F.col("n").alias("begun"), F.lit(0).cast("long").alias("ended"))
    end = F.struct(F.col("last").alias("key"), F.lit(1).alias("kind"), "file", F.lit(0).cast("long").alias("begun"), F.col("n").alias("ended"))
    events = files.select("project_id", F.explode(F.array(begin, end)).alias("e")).select("project_id", "e.*")
    begun = running_within(events, ["project_id"], ["key", "kind", "file"], "begun", "_rank", "rows_begun")
    both = running_within(begun.drop("_rank"), ["project_id"], ["key", "kind", "file"], "ended", "_rank", "rows_ended")
    spans = both.groupBy("project_id", "file").agg(
        (F.min(F.when(F.col("kind") == 0, F.col("rows_ended"))) + 1).alias("from_rank"),
        F.min(F.when(F.col("kind") == 1, F.col("rows_begun"))).alias("to_rank"),
        F.max(F.greatest("begun", "ended")).alias("n"),
    )
    return spans


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """The table's files, as it lists them: (project_id, file). No row is read."""
    listed = spark.read.format("binaryFile").option("basePath", path).load(path)
    return listed.select(F.col("project_id").cast("string").alias("project_id"), F.element_at(F.split("path", "/"), -1).alias("file"))


def update_rank_index(spark: SparkSession, path: str, order: tuple[str, ...] = ORDER) -> int:
    """Bring the index of a table written by ``write_tasks`` up to its files; returns the index's version."""
    versions = _versions(spark, path, order)
    version = versions.latest()
    before = versions.read(version)
    key = F.struct(*order)
    keyed = task_files(spark, path).select("project_id", F.col("_metadata.file_name").alias("file"), key.alias("key"))
    if before is not None:
        known = _stored(spark, path, order, before["folder"])
        # The files that are still there keep their rows of the index; the keys of the others are read.
        there = table_files(spark, path)
        keyed = _unknown(spark, path, there, known, key)
        kept = known.select("project_id", "file", "n", "first", "last").join(there, ["project_id", "file"], "left_semi")
    counted = keyed.groupBy("project_id", "file").agg(F.count("*").alias("n"), F.min("key").alias("first"), F.max("key").alias("last"))
    files = counted if before is None else kept.unionByName(counted)
    folder, root = uuid.uuid4().hex, f"{path.rstrip('/')}/_rank_index/{'-'.join(order)}"
    files.write.parquet(f"{root}/{folder}-files")
    files = spark.read.parquet(f"{root}/{folder}-files")
    spans = rank_spans(files).drop("n")
    files.join(spans, ["project_id", "file"]).sortWithinPartitions("project_id", "from_rank").write.parquet(f"{root}/{folder}")
    # Of two updates at once either is right about the files it saw.
    while not versions.put(version + 1, {"folder": folder}):
        version = versions.latest(version + 1)
    return version + 1


def _unknown(spark: SparkSession, path: str, there: DataFrame, known: DataFrame, key) -> DataFrame:
    new = there.join(known, ["project_id", "file"], "left_anti").collect()  # names, as a reader needs them
    if not new:
        empty = task_files(spark, path).limit(0)
        return empty.select("project_id", F.lit(None).cast("string").alias("file"), key.alias("key"))
    files = [f"{project_folder(path, r.project_id)}/{r.file}" for r in new]
    return task_files(spark, path, files).select("project_id", F.col("_metadata.file_name").alias("file"), key.alias("key"))


def project_files(spark: SparkSession, folder: str) -> set[str]:
    """A project's files, as a reader lists them."""
    try:
        return {f.rsplit("/", 1)[1] for f in spark.read.schema(STORED_TASK_SCHEMA).parquet(folder).inputFiles()}
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()


def indexed_page(
    spark: SparkSession, path: str, project_id, page: int, page_size: int, order: tuple[str, ...] = ORDER
) -> DataFrame:
    """Page ``page`` (from 1) of a project's rows in listing order, from the files that can hold them.

    The index is brought up to date first if the project's files are not those it knows. The rows are those
    of the stored table, without a change log. The driver holds a project's file names, as any reader's does.
    """
    if page <= 0 or page_size <= 0:
        raise ValueError("page and page_size must be positive")
    versions = _versions(spark, path, order)
    record = versions.read(versions.latest())
    folder = project_folder(path, project_id)
    there = project_files(spark, folder)
    first = (page - 1) * page_size + 1
    for attempt in range(2):
        if record is not None:
            own = _stored(spark, path, order, record["folder"]).where(F.col("project_id") == F.lit(str(project_id)))
            spans = own.select("file", "n", "from_rank", "to_rank").collect()
        else:
            spans = []
        if {s.file for s in spans} == there:
            break
        if attempt:
            raise RuntimeError("the table's files change while its page is read")
        record = versions.read(update_rank_index(spark, path, order))
    held = [f"{folder}/{s.file}" for s in spans if s.to_rank >= first and s.from_rank < first + page_size]
    if not held:
        return task_files(spark, path).limit(0)
    before = sum(s.n for s in spans if s.to_rank < first)
    keys = [F.col(c).asc_nulls_first() for c in order]
    return task_files(spark, path, held).orderBy(*keys).offset(first - 1 - before).limit(page_size)
