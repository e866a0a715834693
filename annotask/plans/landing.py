"""Landed pages for the registered queries and the tests.

In use, a downloader lands the service's response pages. Here they are made
from task rows: numbered per result (skew-proof, see ``operators.paging``),
grouped into pages of at most ``page_size`` rows and written as lines in the
layout that ``sources.pages`` reads. Not part of the library's interface.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annotask.functions.json import is_one_json_value
from annotask.operators.paging import paginate
from annotask.sources.pages import JSON_OPTIONS


def _record(df: DataFrame, columns: list[str], json_cols: tuple[str, ...]) -> Column:
    """A row as JSON text; JSON text columns are embedded as they are spelled."""
    out = F.to_json(F.struct(*[F.col(c) for c in columns if c not in json_cols]), JSON_OPTIONS | {"ignoreNullFields": "true"})
    for c in (c for c in json_cols if c in columns):
        quoted = F.to_json(F.array(F.col(c)))
        value = F.when(is_one_json_value(c), F.col(c)).otherwise(F.substring(quoted, F.lit(2), F.length(quoted) - 2))
        lead = F.when(out == "{}", F.lit("{")).otherwise(F.concat(F.substring(out, F.lit(1), F.length(out) - 1), F.lit(",")))
        out = F.when(F.col(c).isNull(), out).otherwise(F.concat(lead, F.lit(f'"{c}":'), value, F.lit("}")))
    return out


def pack_pages(
    df: DataFrame,
    page_size: int,
    result_col: str = "project_id",
    order: tuple[str, ...] = ("created_at", "id"),
    json_cols: tuple[str, ...] = ("answers",),
) -> DataFrame:
    """(project_id, result, page, value) with value = ``{"tasks":[...]}`` in page order."""
    columns = [c for c in df.columns if c == "project_id" or c != result_col]
    paged = paginate(df.withColumn("_result", F.col(result_col).cast("string")), page_size, ("_result",), order)
    rec = F.struct(F.col("position"), _record(df, columns, json_cols).alias("j"))
    grouped = paged.groupBy(F.col("_result").alias("result"), "page").agg(
        F.min("project_id").alias("project_id"), F.sort_array(F.collect_list(rec)).alias("_recs")
    )
    body = F.concat(F.lit('{"tasks":['), F.array_join(F.col("_recs.j"), ","), F.lit("]}"))
    return grouped.select("project_id", "result", "page", body.alias("value"))


def land_pages(
    df: DataFrame, path: str, page_size: int, result_col: str = "project_id", order=("created_at", "id"), mode: str = "append"
) -> str:
    """Add packed pages to a landing of lines, by project (``overwrite``: in place of those projects' pages)."""
    pages = pack_pages(df, page_size, result_col, order)
    pages.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("project_id").json(path)
    return path
