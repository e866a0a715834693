"""Mixing sources to target weights by Pareto order sampling.

Each source has a target number of words. A source whose target is ``r``
times its size first gives every document ``floor(r)`` certain copies. What
is left of the target goes to a sample without replacement of unequal
probabilities: documents are ranked by the odds of a uniform number divided by
their inclusion odds, and the sample is the head of that ranking whose words
come nearest to what is left. The size is fixed in words, so a source meets
its target up to half a document. Inclusion odds fall with the square root of
the document's words: an extra copy of one very long text does not use up its
source's share. The scale of the odds is the same throughout a source, so the
ranking needs no solving for it.

The uniform number is a hash of the id: reruns agree and no state is kept.
The head of a ranking is found in two steps, by the words of narrow rank
buckets and then inside the one bucket that holds the cut, so no task orders
a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annotask.llm.common import WORD, text_or_empty, written

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix"
# Documents of a rank bucket, about.
BUCKET_ROWS = 4096


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def uniform(id_: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from the first 52 bits of a hash of the id (null: as an empty id)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def pareto_rank(uniform_: Column, size: Column) -> Column:
    """The odds of the uniform number over the inclusion odds ``1 / sqrt(size)``."""
    return uniform_ / (F.lit(1.0) - uniform_) * F.sqrt(size.cast("double"))


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED) -> DataFrame:
    """``df`` with the columns ``size`` (words) and ``mix_rank``; columns of these names are replaced."""
    sized = df.withColumn("size", word_count(text_or_empty(text_col)))
    return sized.withColumn("mix_rank", pareto_rank(uniform(F.col(id_col), seed), F.col("size")))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """``sizes`` (source, source_size, ...) with ``target`` and ``full``.

    Sources in order of code point, null last, weigh ``weights`` in turn and
    share all words. A target stops at ``most`` times its source's size and
    the excess goes to the others by weight: sources fill up in order of
    size over weight, and the first that does not fill up sets the level for
    all that remain. One row per source is all that these windows order.
    """
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    weigh = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int"))
    first_full = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, onward = first_full.rowsBetween(W.unboundedPreceding, -1), first_full.rowsBetween(0, W.unboundedFollowing)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    limit = F.lit(float(most)) * F.col("source_size")
    level = (F.col("all_size") - F.col("given")) / F.col("weight_left")
    open_level = F.min(F.when(~F.col("full"), F.struct("fill_order", "level"))).over(everything)
    return (
        sizes.withColumn("weight", weigh)
        .withColumn("fill_order", F.row_number().over(first_full))
        .withColumn("given", F.coalesce(F.sum(limit).over(before), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(onward))
        .withColumn("all_size", F.sum("source_size").over(everything).cast("double"))
        .withColumn("level", level)
        .withColumn("full", F.col("weight") * F.col("level") >= limit)
        .withColumn("open", open_level)
        .withColumn("full", F.col("open").isNull() | (F.col("fill_order") < F.col("open.fill_order")))
        .withColumn("target", F.when(F.col("full"), limit).otherwise(F.col("weight") * F.col("open.level")))
        .drop("weight", "fill_order", "given", "weight_left", "all_size", "level", "open")
    )


def _bucket(rank: Column, typical: Column, buckets: Column) -> Column:
    """A bucket that grows with the rank; ranks near ``typical`` spread evenly."""
    scaled = rank / typical
    return F.least(F.floor(scaled / (scaled + F.lit(1.0)) * buckets), buckets - 1).cast("long")


def sampling_plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per source of ``rows`` (source, tie, size, mix_rank): its sizes,
    target, certain copies and the place where its ranking is cut."""
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.greatest(F.avg(F.sqrt(F.col("size").cast("double"))), F.lit(1e-9)).alias("typical"),
        F.ceil(F.count("*") / F.lit(bucket_rows)).cast("long").alias("buckets"),
    )
    certain = F.when(F.col("full"), F.lit(most)).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("int")
    plan = source_targets(sizes, weights, most).withColumn("certain", F.when(F.col("source_size") > 0, certain).otherwise(F.lit(0)))
    plan = plan.withColumn("left", F.greatest(F.col("target") - F.col("certain") * F.col("source_size"), F.lit(0.0)))
    plan = written(plan.drop("full"), "mix-sources")

    placed = rows.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    placed = placed.select("source", "tie", "size", "mix_rank", "left", _bucket(F.col("mix_rank"), F.col("typical"), F.col("buckets")).alias("bucket"))
    words = placed.groupBy("source", "bucket", "left").agg(F.sum("size").alias("words"))
    so_far = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    words = words.withColumn("before", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
    # The last bucket that starts at or before the cut holds it.
    cut = words.where("before <= left").groupBy("source").agg(F.max(F.struct("bucket", "before")).alias("at"))
    cut = written(cut.select(F.col("source").alias("s"), F.col("at.bucket").alias("cut_bucket"), "at.before"), "mix-cuts")

    inside = placed.join(cut, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("cut_bucket")))
    ranked = W.partitionBy("source").orderBy("mix_rank", "tie").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(ranked), F.lit(0))
    # A document is in if more than half of it lies before the cut.
    chosen = inside.withColumn("is_in", start + F.col("size") / F.lit(2.0) < F.col("left"))
    last = chosen.groupBy("source").agg(F.max(F.when(F.col("is_in"), F.struct("mix_rank", "tie"))).alias("cut"))
    return (
        plan.join(cut, plan["source"].eqNullSafe(cut["s"]), "left").drop("s", "before")
        .join(last.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
        .drop("s")
    )


def mixed(rows: DataFrame, plan: DataFrame, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``rows`` with ``source_size``, ``target`` and ``copies``: how often the mix takes the document."""
    own = [c for c in rows.columns if c not in ("source_size", "target", "copies", "mix_rank")]
    plan = plan.select(F.struct("*").alias("mix_plan"))
    met = rows.join(plan, F.col(source_col).eqNullSafe(F.col("mix_plan.source")))
    p = F.col("mix_plan")
    bucket = _bucket(F.col("mix_rank"), p["typical"], p["buckets"])
    place = F.struct(F.col("mix_rank"), F.col(id_col).alias("tie"))
    extra = (bucket < p["cut_bucket"]) | ((bucket == p["cut_bucket"]) & F.coalesce(place <= p["cut"], F.lit(False)))
    copies = p["certain"] + (F.coalesce(extra, F.lit(False)) & (p["left"] > 0)).cast("int")
    return met.select(
        *own, p["source_size"].alias("source_size"), p["target"].alias("target"), F.when(F.col("size") > 0, copies).otherwise(0).alias("copies")
    )


def mix_sources(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MAX_COPIES,
    seed: str = SEED,
    keep_text: bool = True,
) -> DataFrame:
    """``df`` with ``size``, ``source_size``, ``target`` and ``copies``.

    Null texts have no words; documents without words get no copies. Null
    is a source of its own. Rows that share id and size rank alike, and are
    taken or left together. An empty table gives an empty table. Columns of
    the added names are replaced, all others pass through (the text only
    with ``keep_text``).
    """
    rows = measured(df, id_col, text_col, seed)
    if keep_text:
        narrow = rows.select(id_col, source_col, "size", "mix_rank")
    else:
        narrow = rows = rows.drop(text_col)
    narrow = written(narrow, "mix-rows")
    sized = narrow.select(F.col(source_col).alias("source"), F.col(id_col).alias("tie"), "size", "mix_rank")
    plan = written(sampling_plan(sized, weights, most), "mix-plan")
    return mixed(rows if keep_text else narrow, plan, id_col, source_col)
