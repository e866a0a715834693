from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from annotask.llm import mixing
from tests.llm.support import documents, rows


def plain_targets(sizes):
    """{source: size} -> {source: target}, by giving away the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * sizes[s] if s in full else Fraction(left * weight[s], open_) for s in names}
        above = {s for s in names if target[s] >= 3 * sizes[s]} - full
        if not above:
            return target
        full |= above


@pytest.mark.parametrize(
    "sizes",
    [{"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 500, "c": 5, None: 80}, {"a": 0, "b": 7}, {"z": 3}, {"a": 1, "é": 2, "\U0001f600": 900, "～": 4}],
)
def test_targets_against_repeated_resharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in rows(mixing.source_targets(df))}
    assert got == pytest.approx({s: float(t) for s, t in plain_targets(sizes).items()})


def test_copies_meet_the_targets(spark):
    docs = [(i, "w " * (1 + i * 7919 % 60), "en", "abc"[(i % 10 > 4) + (i % 10 > 8)]) for i in range(3000)] + [(5000, None, "en", None), (5001, "x y", "en", None)]
    df = documents(spark, docs)
    got = rows(mixing.mix_sources(df))
    assert len(got) == len(docs) and set(got[0]) == {*df.columns, "size", "source_size", "target", "copies"}
    for source in "abc":
        own = [r for r in got if r["source"] == source]
        taken, target = sum(r["size"] * r["copies"] for r in own), own[0]["target"]
        assert abs(taken - target) <= 60 and own[0]["source_size"] == sum(r["size"] for r in own)
        low = int(target / own[0]["source_size"])
        assert {r["copies"] for r in own} <= {low, low + 1}
    assert all(0 <= r["copies"] <= 3 for r in got) and [r["copies"] for r in got if r["doc_id"] == 5000] == [0]
    again = rows(mixing.mix_sources(df.repartition(5)))
    assert {(r["doc_id"], r["copies"]) for r in again} == {(r["doc_id"], r["copies"]) for r in got}


def test_cut_is_the_head_of_the_ranking(spark):
    draws = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise("b").alias("source"), F.col("id").alias("tie"), (F.col("id") % 50 + 1).alias("size"),
        mixing.pareto_rank(mixing.uniform(F.col("id")), F.col("id") % 50 + 1).alias("mix_rank"))
    few = mixing.mixed(draws.withColumnRenamed("tie", "doc_id"), mixing.sampling_plan(draws, bucket_rows=40))
    for source in ("hot", "b"):
        own = sorted((r for r in rows(few.join(draws.select(F.col("tie").alias("doc_id"), "mix_rank"), "doc_id")) if r["source"] == source), key=lambda r: r["mix_rank"])
        certain = min(r["copies"] for r in own)
        left, seen, want = own[0]["target"] - certain * own[0]["source_size"], 0, []
        for r in own:
            want.append(seen + r["size"] / 2 < left)
            seen += r["size"]
        assert [r["copies"] > certain for r in own] == want


def test_shorter_documents_rank_ahead(spark):
    got = spark.range(4000).select(
        (mixing.pareto_rank(mixing.uniform(F.col("id")), F.lit(4)) < 1.5).cast("int").alias("short"),
        (mixing.pareto_rank(mixing.uniform(F.col("id")), F.lit(100)) < 1.5).cast("int").alias("long")).agg(F.avg("short"), F.avg("long")).first()
    # Odds 1.5 / sqrt(size).
    assert got[0] == pytest.approx(0.75 / 1.75, abs=0.03) and got[1] == pytest.approx(0.15 / 1.15, abs=0.03)


def test_nulls_repeats_clashes_and_empty_tables(spark):
    df = documents(spark, [(None, "a b c", "en", "s"), (None, "a b c", "en", "s"), (1, "", "en", None), (2, None, None, None)])
    df = df.withColumn("size", F.lit("old")).withColumn("copies", F.lit("old")).withColumn("bucket", F.lit("mine"))
    got = rows(mixing.mix_sources(df))
    assert sorted((r["size"], r["copies"], r["bucket"]) for r in got) == [(0, 0, "mine"), (0, 0, "mine"), (3, 1, "mine"), (3, 1, "mine")]
    assert rows(mixing.mix_sources(df.where("false"))) == []


