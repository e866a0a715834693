"""Exact deduplication as a stateful stream.

Rows are read as a stream whose keyed state lives on the executors' disks
(RocksDB, with its changes written to the shared checkpoint folder) and never
expires. For each digest of a normalised text the state retains the row that
stays: its stable identifier and its content locator, the row's file and place
in it, and the number of rows seen. Spark adds up the rows of a
digest within each task before they reach the state, so a large group of
copies arrives there as one row per task.

Equal digests are only a hit. Each hit's full bytes are fetched by locator and
compared with those of the row that stays; where they differ, the rows of that
digest are grouped by the texts themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annotask.llm.common import SPACE_RUN, free_name, written
from annotask.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Staged files taken into one micro-batch.
FILES_PER_BATCH = 2000
# Memory that the state stores of one executor share; the rest stays on disk.
STATE_MEMORY_MB = 256

ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def normalised(column: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(column, F.lit("")), SPACE_RUN, " ")


def sha256(column: Column) -> Column:
    return F.sha2(column, 256)


def _stateful_session(spark: SparkSession) -> SparkSession:
    """A session of its own for the stream's settings; the caller's stay as they are."""
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    store = "spark.sql.streaming.stateStore"
    session.conf.set(f"{store}.providerClass", ROCKSDB)
    session.conf.set(f"{store}.rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set(f"{store}.rocksdb.boundedMemoryUsage", "true")
    session.conf.set(f"{store}.rocksdb.maxMemoryUsageMB", str(STATE_MEMORY_MB))
    # Many small stores: no space set aside in advance for each one's logs.
    session.conf.set(f"{store}.rocksdb.allowFAllocate", "false")
    return session


def digest_state(spark: SparkSession, staged: str, schema, checkpoint: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """What the state holds once all files under ``staged`` are in: (digest, first, members).

    The stream can be run again with the same checkpoint when files have been
    added; it takes in only those, against the state kept so far.
    """
    session = _stateful_session(spark)
    rows = session.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(staged)
    # Null ids come after all others.
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("locator"))
    seen = rows.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("members"))
    running = (
        seen.writeStream.outputMode("update")
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .format("noop")
        .start()
    )
    running.awaitTermination()
    state = spark.read.format("statestore").load(checkpoint)
    first, members = state.schema["value"].dataType.fieldNames()
    return state.select(F.col("key.digest").alias("digest"), F.col(f"value.{first}").alias("first"), F.col(f"value.{members}").alias("members"))


def located(df: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with a locator, their file and row number in it: ``df`` itself if
    it is read from files, else a written copy."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        df.select(place)
    except AnalysisException:  # not read from Parquet files
        df = written(df, "dedup-rows")
    return df, place


def exact_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """Every row of ``df`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when their normalised forms are; null counts as empty. Of
    equal texts the row with the smallest id stays (null ids last); of
    rows that share that id too, the one located first, so exactly one row of
    a group is kept. An empty table gives an empty table. Columns of the added
    names are replaced, all others pass through.
    """
    spark = df.sparkSession
    rows, place = located(df)
    own = [c for c in df.columns if c not in ADDED]
    mark, at = free_name(df, "digest"), free_name(df, "locator")
    body = normalised(F.col(text_col))
    full = rows.select(*own, digest(body).alias(mark), place.alias(at))

    # Digests, ids and locators only: what the stream reads.
    staged = scratch_path(spark, "dedup-staged")
    full.select(F.col(mark).alias("digest"), F.col(id_col).alias("id"), F.col(at).alias("locator")).write.parquet(staged)
    narrow = spark.read.parquet(staged)
    state = written(digest_state(spark, staged, narrow.schema, scratch_path(spark, "dedup-state")), "dedup-groups")

    # Full bytes of hits against those of the row that stays.
    hits = state.where("members > 1").select(F.col("digest").alias(mark), "first")
    fetched = full.select(mark, at, body.alias("body")).join(hits, mark)
    again = F.col(at) != F.col("first.locator")
    fetched = written(fetched.select(F.col(mark).alias("digest"), again.alias("again"), "body"), "dedup-hits")
    stays = fetched.where("not again").select("digest", F.col("body").alias("kept_body"))
    # Written as the join leaves them, so that a large group's rows can be split.
    differ = fetched.where("again").join(stays, "digest").where("body != kept_body").select("digest")
    differ = written(differ, "dedup-collisions").distinct()

    groups = state.select(F.col("digest").alias(mark), "first", "members")
    decided = full.join(groups, mark)
    if not differ.isEmpty():
        # Rows of these digests go by their texts instead.
        apart = full.withColumn("body", body).join(differ.withColumnRenamed("digest", mark), mark, "left_semi")
        order = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(at).alias("locator"))
        texts = apart.groupBy("body").agg(F.min(order).alias("first"), F.count("*").alias("members"))
        mended = apart.join(texts, "body").select(*decided.columns)
        decided = decided.join(differ.withColumnRenamed("digest", mark), mark, "left_anti").union(mended)
    return decided.select(
        *own,
        F.col("first.id").alias("keep_id"),
        F.col("members").cast("long").alias("group_size"),
        (F.col(at) == F.col("first.locator")).alias("kept"),
        (F.col(mark) if digest is sha256 else F.sha2(body, 256)).alias("text_sha256"),
    )
