"""Literal substring search by a trigram index: a search opens the files that can hold the text.

The index has a row per trigram and file for one text column of a stored table. A text of three characters or more can
only stand in a file that has all its trigrams; the rows of those files are then checked against the
text itself, so the result is that of the plain filter. Files that the index does not know yet are opened as
well, and files are never changed, so an index that is behind costs time and no rows. Texts of one or
two characters open every file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annotask.functions.filters import filter_tasks
from annotask.operators.rank_index import project_files, table_files, task_files
from annotask.sinks.versions import Numbered
from annotask.sources.pages import project_folder

SIZE = 3
_POSTINGS = "project_id string, file string, gram string"


def _versions(spark: SparkSession, path: str, column: str) -> Numbered:
    return Numbered(spark, f"{path.rstrip('/')}/_substring_index/{column}/versions")


def _postings(spark: SparkSession, path: str, column: str, record: dict) -> DataFrame:
    root = f"{path.rstrip('/')}/_substring_index/{column}"
    return spark.read.schema(_POSTINGS).parquet(*(f"{root}/{folder}" for folder in record["folders"]))


def grams_of(text: Column) -> Column:
    """The distinct trigrams of a text; none for a shorter one."""
    places = F.sequence(F.lit(1), F.length(text) - (SIZE - 1))
    found = F.transform(places, lambda i: F.substring(text, i, F.lit(SIZE)))
    return F.when(F.length(text) >= SIZE, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def update_substring_index(spark: SparkSession, path: str, column: str = "client_batch_id") -> int:
    """Take in the files that the index does not know yet; returns its version.

    A file without any trigram is known by a row with an empty one. Of two updates at once, the later one starts again.
    """
    versions = _versions(spark, path, column)
    version = versions.latest()
    while True:
        record = versions.read(version) or {"folders": []}
        there = table_files(spark, path)
        new = there
        if record["folders"]:
            new = there.join(_postings(spark, path, column, record).select("project_id", "file").distinct(), ["project_id", "file"], "left_anti")
        names = [f"{project_folder(path, r.project_id)}/{r.file}" for r in new.collect()]  # as a reader needs them
        if not names:
            return version
        rows = task_files(spark, path, names).select("project_id", F.col("_metadata.file_name").alias("file"), F.col(column).alias("text"))
        grams = F.explode(F.array_union(F.array(F.lit("")), F.coalesce(grams_of(F.col("text")), F.array().cast("array<string>"))))
        folder = uuid.uuid4().hex
        posted = rows.select("project_id", "file", grams.alias("gram")).distinct()
        posted.repartitionByRange("project_id", "gram").sortWithinPartitions("project_id", "gram").write.parquet(
            f"{path.rstrip('/')}/_substring_index/{column}/{folder}"
        )
        if versions.put(version + 1, {"folders": [*record["folders"], folder]}):
            return version + 1
        version = versions.latest(version + 1)


def candidate_files(spark: SparkSession, path: str, project_id, text: str, column: str = "client_batch_id") -> list[str]:
    """The project's files that can hold the text, by the index's newest version."""
    versions, there = _versions(spark, path, column), project_files(spark, project_folder(path, project_id))
    record = versions.read(versions.latest())
    wanted = sorted({text[i : i + SIZE] for i in range(len(text) - SIZE + 1)})
    if record is None or not wanted:
        return sorted(there)
    own = _postings(spark, path, column, record).where(F.col("project_id") == F.lit(str(project_id)))
    asked = own.where(F.col("gram").isin("", *wanted)).groupBy("file").agg(F.count_distinct("gram").alias("n"))
    # One row per file of the project, as its reader lists them.
    met = {r.file: r.n for r in asked.collect()}
    return sorted(f for f in there if met.get(f, len(wanted) + 1) == len(wanted) + 1)


def tasks_containing(spark: SparkSession, path: str, project_id, text: str, column: str = "client_batch_id", **filters) -> DataFrame:
    """A project's stored tasks whose column holds the text (literally, as ``filter_tasks`` with ``contains``)."""
    files = [f"{project_folder(path, project_id)}/{f}" for f in candidate_files(spark, path, project_id, text, column)]
    if not files:
        return task_files(spark, path, None).limit(0)
    return filter_tasks(task_files(spark, path, files).where(F.contains(F.col(column), F.lit(text))), **filters)
