"""What has landed, as numbered landings: a reader's place is a number, not a set of seen files.

A landing's writer registers the files that it finished (:func:`register_files`); they become the next
landing under ``<path>/_landings``. A reader that knows landing ``n`` asks for what came after it, at a
cost that does not grow with what it has read before, and no file is passed over for its age.
Where the writer does not register, :func:`register_new` lists the folder and registers
the files that no landing names yet.

The file names of a landing are kept as a small table, whatever their number.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annotask.sinks.versions import Numbered, full_name

_LISTS = "file string"


def _numbers(spark: SparkSession, path: str) -> Numbered:
    return Numbered(spark, f"{path.rstrip('/')}/_landings/numbers")


def latest_landing(spark: SparkSession, path: str, known: int = -1) -> int:
    """Number of the newest landing, from 0; -1 before the first."""
    return _numbers(spark, path).latest(known)


def _register(spark: SparkSession, path: str, files: DataFrame) -> int:
    numbers, name = _numbers(spark, path), uuid.uuid4().hex
    files.select("file").write.parquet(f"{path.rstrip('/')}/_landings/lists/_list={name}")
    number = numbers.latest() + 1
    while not numbers.put(number, {"list": name}):
        number = numbers.latest(number) + 1
    return number


def register_files(spark: SparkSession, path: str, files: list[str] | DataFrame) -> int:
    """Make finished files (a list, or a table with a column ``file`` of full names, as ``file:/a/b``) the next
    landing; returns its number."""
    if not isinstance(files, DataFrame):
        files = spark.createDataFrame([(full_name(spark, f),) for f in files], _LISTS).coalesce(1)
    return _register(spark, path, files)


def _registered(spark: SparkSession, path: str) -> DataFrame | None:
    """The files that landings name. A list whose number was never made names none."""
    numbers = _numbers(spark, path)
    if not numbers.has(0):
        return None
    lists = spark.read.schema(f"{_LISTS}, _list string").parquet(f"{path.rstrip('/')}/_landings/lists")
    made = spark.read.schema("list string").json(numbers.path)
    return lists.join(made, F.col("_list") == F.col("list"), "left_semi").select("file")


def register_new(spark: SparkSession, path: str) -> int | None:
    """Register the folder's files that no landing names yet; the new landing's number, None without any.

    One registering call at a time: two at once may register a file twice.
    """
    try:
        found = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"))
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None  # nothing has landed yet
    known = _registered(spark, path)
    new = found if known is None else found.join(known, "file", "left_anti")
    return None if new.isEmpty() else _register(spark, path, new)


def files_of(spark: SparkSession, path: str, number: int) -> list[str]:
    """The files of a landing, for a reader to open."""
    name = _numbers(spark, path).read(number)["list"]
    rows = spark.read.schema(_LISTS).parquet(f"{path.rstrip('/')}/_landings/lists/_list={name}")
    return sorted(r.file for r in rows.distinct().collect())
