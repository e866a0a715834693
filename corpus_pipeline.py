"""A training-data pipeline over ``documents``.

Each stage takes what its predecessor kept, all columns of ``documents``, and
is written as Parquet before the next one reads it. The last stage returns
token ids in place of the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annotask.llm import bpe, exact_dedup, mixing, simhash, toxicity
from annotask.llm.common import written

# SQL has no form of the classifier or of the tokenizer; the stages are tested
# against brute-force versions.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones, does not predict toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(docs, labels).where("predicted = 0").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one of the smallest id."""
    return exact_dedup.exact_dedup(docs).where("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, one document: that of the smallest id."""
    return simhash.one_per_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    taken = mixing.mix_sources(docs).where("copies > 0")
    repeated = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed little-endian unsigned 32-bit integers) in place of the text, which they must give back."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode_texts(docs, path, public_tokenizers.PATTERN, decoded_col="_decoded")
    lost = F.raise_error(F.concat(F.lit("token ids do not give back the text of doc_id "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    whole = F.when(F.col("_decoded") == F.coalesce("text", F.lit("")), True).otherwise(lost.cast("boolean"))
    return coded.where(whole).withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long")).drop("text", "_decoded")


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
