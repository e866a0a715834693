"""The pages that have landed, kept as runs and brought up to date landing by landing.

A version of the state (``sinks.versions``) holds the steps of all results and the landing that it takes in.
An update parses only the pages that landed since, merges their steps with the state's and makes
the next version; of two updates at once one makes it, and the other starts again from there.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from annotask.operators.page_runs import merge_steps, missing_pages, page_steps
from annotask.sinks.versions import Numbered
from annotask.sources.landings import files_of, latest_landing, register_new
from annotask.sources.pages import JSON_OPTIONS, PAGE_LINE_SCHEMA, page_lines, parse_pages

LANDINGS_PER_VERSION = 32
_STEPS = "result string, at long, step long"


def _versions(spark: SparkSession, state_path: str) -> Numbered:
    return Numbered(spark, f"{state_path.rstrip('/')}/versions")


def _steps(spark: SparkSession, state_path: str, folder: str | None) -> DataFrame:
    if folder is None:
        return spark.createDataFrame([], _STEPS)
    return spark.read.schema(_STEPS).parquet(f"{state_path.rstrip('/')}/steps/{folder}")


def update_page_state(spark: SparkSession, landing_path: str, state_path: str, discover: bool = True) -> int:
    """Take in what has landed since the state's version; returns the version reached (-1: nothing has landed yet)."""
    if discover:
        register_new(spark, landing_path)
    versions, version = _versions(spark, state_path), -1
    while True:
        version = versions.latest(version)
        before = versions.read(version) or {"landing": -1, "folder": None}
        newest = latest_landing(spark, landing_path, before["landing"])
        if newest == before["landing"]:
            return version
        upto = min(newest, before["landing"] + LANDINGS_PER_VERSION)
        landed = (
            page_lines(spark.read.schema(PAGE_LINE_SCHEMA).options(**JSON_OPTIONS).json(files_of(spark, landing_path, n)))
            for n in range(before["landing"] + 1, upto + 1)
        )
        new = page_steps(parse_pages(reduce(DataFrame.unionByName, landed)))
        folder = uuid.uuid4().hex
        merge_steps(_steps(spark, state_path, before["folder"]), new).write.parquet(f"{state_path.rstrip('/')}/steps/{folder}")
        versions.put(version + 1, {"landing": upto, "folder": folder})


def missing_landed_pages(spark: SparkSession, state_path: str) -> DataFrame:
    """(result, from_page, to_page) that the state's newest version lacks before each result's last page."""
    versions = _versions(spark, state_path)
    record = versions.read(versions.latest()) or {"folder": None}
    return missing_pages(_steps(spark, state_path, record["folder"]))
