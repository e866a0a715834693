"""Which pages are missing: runs of pages as mergeable sets of steps.

A set of pages is held as the steps of its membership: +1 at the first page of a run,
-1 at the page after its last. Steps of several sets (yesterday's state, what landed since) are
added up per page; where the running sum of a result's steps is above zero, a page is there. Bringing the sum
back to steps of 0 and 1 gives the union, so a state is merged with new pages without the pages it was made of,
and its size follows the number of gaps, not of pages.

The running sum is taken over range partitions with the sums of the tasks before added
(:func:`running_within`), and a step meets its neighbour by its rank: no task holds a whole result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annotask.session import scratch_path

_PARTITION_SHIFT = 33


def running_within(df: DataFrame, keys: list[str], order: list[str], value: str, rank_col: str = "rank", sum_col: str = "running") -> DataFrame:
    """1-based rank and running sum of ``value`` per ``keys`` in ascending ``order``, skew-proof.

    ``keys + order`` must identify a row. Rows are sorted over range partitions and written once; a
    key may span many tasks, each of which adds the counts and sums of the tasks before it.
    """
    cols = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    path = scratch_path(df.sparkSession, "running")
    df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_rid", F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_rid", _PARTITION_SHIFT))
    # One row per task and key.
    totals = rows.groupBy("_part", *keys).agg(F.count("*").alias("_n"), F.sum(value).alias("_s"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        F.col("_part").alias("_of_part"),
        *(F.col(k).alias(f"_of_{k}") for k in keys),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_before"),
        F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_s_before"),
    )
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys), F.col("_part") == F.col("_of_part"))
    inside = Window.partitionBy("_part", *keys).orderBy("_rid")
    placed = rows.select("*", F.row_number().over(inside).alias("_nth"), F.sum(value).over(inside).alias("_sum")).join(before, same)
    return placed.select(
        *df.columns, (F.col("_n_before") + F.col("_nth")).alias(rank_col), (F.col("_s_before") + F.col("_sum")).alias(sum_col)
    )


def page_steps(pages: DataFrame, result_col: str = "result", page_col: str = "page", rejected_col: str = "rejected") -> DataFrame:
    """Steps (result, at, step) of the pages that are there; a page counts once however often it came, and
    one whose every copy was rejected (``rejected_col``, where there is one) is not there. Null and
    non-positive page numbers are no pages."""
    if rejected_col in pages.columns:
        pages = pages.where(~F.coalesce(F.col(rejected_col), F.lit(False)))
    there = pages.where(F.col(page_col) >= 1).select(F.col(result_col).alias("result"), F.col(page_col).cast("long").alias("page")).distinct()
    both = F.array(F.struct(F.col("page").alias("at"), F.lit(1).alias("step")), F.struct((F.col("page") + 1).alias("at"), F.lit(-1).alias("step")))
    return merge_steps(there.select("result", F.explode(both).alias("s")).select("result", "s.at", "s.step"))


def merge_steps(*sets: DataFrame) -> DataFrame:
    """The union of several sets of pages, as steps of +1 and -1."""
    every = reduce(DataFrame.unionByName, sets)
    summed = every.groupBy("result", "at").agg(F.sum("step").alias("step")).where("step <> 0")
    running = running_within(summed, ["result"], ["at"], "step")
    # A run begins where the sum leaves zero, and ends where it comes back.
    begins, ends = F.col("running") == F.col("step"), F.col("running") == 0
    return running.where(begins | ends).select("result", "at", F.when(begins, 1).otherwise(-1).cast("long").alias("step"))


def missing_pages(steps: DataFrame) -> DataFrame:
    """Per result every interval of pages (result, from_page, to_page) before its last page that is not there."""
    ranked = running_within(steps.select("result", F.col("at").cast("long"), F.col("step").cast("long")), ["result"], ["at"], "step")
    starts = ranked.where("step = 1").select("result", "rank", F.col("at").alias("next"))
    stops = ranked.where("step = -1").select("result", (F.col("rank") + 1).alias("rank"), F.col("at").alias("from_page"))
    first = starts.where("rank = 1 and next > 1").select("result", F.lit(1).cast("long").alias("from_page"), "next")
    met = stops.alias("a").join(starts.alias("b"), F.col("a.result").eqNullSafe(F.col("b.result")) & (F.col("a.rank") == F.col("b.rank")))
    gaps = met.select("a.result", "from_page", "next").unionByName(first)
    return gaps.select("result", "from_page", (F.col("next") - 1).alias("to_page"))


def page_runs(steps: DataFrame) -> DataFrame:
    """Per result the runs of pages that are there: (result, from_page, to_page)."""
    ranked = running_within(steps.select("result", F.col("at").cast("long"), F.col("step").cast("long")), ["result"], ["at"], "step")
    starts = ranked.where("step = 1").select("result", (F.col("rank") + 1).alias("rank"), F.col("at").alias("from_page"))
    stops = ranked.where("step = -1").select("result", "rank", F.col("at").alias("after"))
    met = starts.alias("a").join(stops.alias("b"), F.col("a.result").eqNullSafe(F.col("b.result")) & (F.col("a.rank") == F.col("b.rank")))
    return met.select("a.result", "from_page", (F.col("after") - 1).alias("to_page"))
