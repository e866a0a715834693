"""Paging: exact page numbers, bounded reads, completeness of landed pages.

Page numbers need a row number within each project. A window partitioned by
project would put a whole project into one task, and one project may hold a
third of all rows. :func:`rank_within` instead range-partitions on
(key, order) so a large key spans many tasks, numbers rows inside each task,
and adds the counts of the earlier tasks of the same key. The table of
per-task counts has at most (tasks + keys) rows.

The sorted, numbered rows are read twice (for the counts and for the final
numbers), and both reads must see the same task layout. Adaptive execution
may re-plan the two reads differently (other shuffle readers, other
partition counts), so the numbered rows are written once as a Parquet table
in the shared checkpoint folder. The counts pass then reads only the key and
row-id columns, and the lineage is cut: a lost executor re-reads the same
rows instead of recomputing them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annotask.session import scratch_path

# monotonically_increasing_id() puts the partition index in the bits above 33.
_PARTITION_SHIFT = 33


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rank_within(
    df: DataFrame,
    keys: list[str] | tuple[str, ...],
    order: list[str] | tuple[str, ...],
    rank_col: str = "rank",
    num_partitions: int | None = None,
) -> DataFrame:
    """1-based row number per ``keys`` in ascending ``order``, skew-proof.

    ``keys + order`` must identify a row (end ``order`` with a unique id), so
    the numbering is a function of the data and survives recomputation after
    a lost executor. Every column of ``df`` is written to the intermediate
    table: select the columns needed downstream first.
    """
    keys, order = list(keys), list(order)
    sort_cols = [F.col(k).asc_nulls_first() for k in keys] + [_col(o).asc_nulls_first() for o in order]
    spark = df.sparkSession
    path = scratch_path(spark, "rank")
    # Without an explicit count, adaptive execution sizes the range partitions
    # from spark.sql.shuffle.partitions and the measured shuffle size.
    ranged = df.repartitionByRange(num_partitions, *sort_cols) if num_partitions else df.repartitionByRange(*sort_cols)
    (
        ranged
        .sortWithinPartitions(*sort_cols)
        .withColumn("_rid", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    ordered = spark.read.parquet(path).withColumn("_part", F.shiftright(F.col("_rid"), _PARTITION_SHIFT))
    counts = ordered.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_rid").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_part").alias("_o_part"),
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        "_first",
    )
    cond = reduce(
        lambda a, b: a & b,
        [F.col("_part") == F.col("_o_part")] + [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys],
    )
    joined = ordered.join(offsets, cond, "inner")
    return joined.withColumn(rank_col, F.col("_before") + F.col("_rid") - F.col("_first") + 1).drop(
        "_rid", "_part", "_o_part", "_before", "_first", *[f"_o_{k}" for k in keys]
    )


def paginate(
    df: DataFrame,
    page_size: int,
    keys: tuple[str, ...] = ("project_id",),
    order: tuple[str, ...] = ("created_at", "id"),
    page_col: str = "page",
    position_col: str | None = "position",
) -> DataFrame:
    """Page number (from 1) of every row, ``page_size`` rows per page per key."""
    if page_size <= 0:
        raise ValueError("page_size must be positive")
    ranked = rank_within(df, keys, order, rank_col="_rank")
    out = ranked.withColumn(page_col, (F.expr("(_rank - 1) div {}".format(int(page_size))) + 1).cast("int"))
    if position_col:
        out = out.withColumn(position_col, ((F.col("_rank") - 1) % int(page_size) + 1).cast("int"))
    return out.drop("_rank")


# Parts that a key's rows are dealt to before its first rows are chosen.
READ_PARTS = 64


def read_page(
    df: DataFrame,
    page: int,
    page_size: int,
    keys: tuple[str, ...] = ("project_id",),
    order: tuple[str, ...] = ("created_at", "id"),
) -> DataFrame:
    """One page per key: the bounded read of a single call (page 1 = first call).

    One lazy plan at every depth: each part of a key keeps its first
    ``page × page_size`` rows (a window group limit, applied in the tasks that
    read them too), and the key's window orders only what the parts kept.
    What it orders is bounded by the depth of the page, not by the key;
    reading a listing to its end is :func:`paginate`'s work.
    """
    if page <= 0 or page_size <= 0:
        raise ValueError("page and page_size must be positive")
    depth = int(page) * int(page_size)
    by = [_col(o).asc_nulls_first() for o in order]
    part = F.pmod(F.xxhash64(*[_col(o) for o in order]), F.lit(READ_PARTS))
    in_part = Window.partitionBy(*keys, "_part").orderBy(*by)
    parts = df.withColumn("_part", part).withColumn("_rn", F.row_number().over(in_part)).where(F.col("_rn") <= depth)
    in_key = Window.partitionBy(*keys).orderBy(*by)
    ranked = parts.drop("_part").withColumn("_rn", F.row_number().over(in_key)).where(F.col("_rn") <= depth)
    return ranked.where(F.col("_rn") > depth - int(page_size)).drop("_rn")


def page_completeness(
    pages: DataFrame,
    page_size: int,
    result_col: str = "result",
    page_col: str = "page",
    count_col: str = "n_tasks",
    rejected_col: str = "rejected",
) -> DataFrame:
    """Per result: are pages 1..k all there and readable, all but the last full?

    The last page must be short or empty; a full last page means a further
    page may exist (the client would ask for one more). A page that is there
    several times counts once, by its readable copy if it has one. A page whose
    body was rejected (``rejected_col``, where ``pages`` has it) makes the
    result incomplete. Two aggregations with partial merge, so no result is
    gathered in one task.
    """
    bad = F.coalesce(F.col(rejected_col), F.lit(False)) if rejected_col in pages.columns else F.lit(False)
    # One row per page: the best copy is readable and has the most tasks.
    best = F.max(F.struct((~bad).alias("readable"), F.coalesce(F.col(count_col), F.lit(0)).alias("n")))
    once = pages.groupBy(result_col, page_col).agg(best.alias("_best"), F.count(F.lit(1)).alias("_copies"))
    n = F.col("_best.n")
    agg = once.groupBy(result_col).agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.min(page_col).alias("first_page"),
        F.max(page_col).alias("last_page"),
        F.sum(n).cast("bigint").alias("n_tasks"),
        F.max_by(n, F.col(page_col)).alias("last_page_tasks"),
        F.count_if((n < page_size) & F.col("_best.readable")).alias("_n_short"),
        F.count_if(~F.col("_best.readable")).alias("rejected_pages"),
        F.sum(F.col("_copies") - 1).cast("bigint").alias("duplicate_pages"),
        F.max_by(F.col("_best.readable"), F.col(page_col)).alias("_last_readable"),
    )
    last_short = F.col("last_page_tasks") < page_size
    short_inner = F.col("_n_short") - F.when(last_short & F.col("_last_readable"), 1).otherwise(0)
    missing = F.col("last_page") - F.col("n_pages")
    sound = (missing == 0) & (F.col("first_page") == 1) & (F.col("rejected_pages") == 0)
    return agg.select(
        result_col,
        "n_pages",
        "first_page",
        "last_page",
        "n_tasks",
        missing.cast("bigint").alias("missing_pages"),
        short_inner.cast("bigint").alias("short_inner_pages"),
        "rejected_pages",
        "duplicate_pages",
        (~last_short).alias("last_page_full"),
        (sound & (short_inner == 0) & last_short).alias("complete"),
    )
