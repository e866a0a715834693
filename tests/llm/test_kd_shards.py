import zlib

import pytest
from pyspark.sql import functions as F

from annotask.llm import kd_shards
from annotask.llm.queries import QUERIES
from tests.conftest import SF01
from tests.llm.support import documents, rows


def check(got, shards):
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r)
    for own in by_shard.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    assert set(by_shard) <= set(range(shards))
    return {s: sum(r["size"] for r in own) for s, own in by_shard.items()}


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_shards_have_near_equal_bytes(spark, shards):
    docs = [(i, "x" * (i * 7919 % 997), ["en", "de", None][i % 3], f"src{i % 11}") for i in range(4000)]
    sizes = check(rows(kd_shards.kd_shards(documents(spark, docs), shards=shards)), shards)
    mean = sum(sizes.values()) / shards
    assert len(sizes) == shards and max(abs(s - mean) for s in sizes.values()) <= max(0.02 * mean, 1000)


def test_a_group_of_copies_beyond_a_shard_is_split_evenly(spark):
    docs = [(i, "same text", "en", "a") for i in range(1500)] + [(1, "one id", "en", "a")] * 700 + [(5000 + i, "y" * (i % 30), "en", "b") for i in range(900)]
    sizes = check(rows(kd_shards.kd_shards(documents(spark, docs), shards=8)), 8)
    mean = sum(sizes.values()) / 8
    assert max(abs(s - mean) for s in sizes.values()) <= 0.03 * mean


def test_tree_against_brute_force(spark):
    data = [(i * 31 % 50, i * 17 % 300, i * 13 % 70 + 1, i) for i in range(2000)]
    df = spark.createDataFrame(data, "x long, y long, _size long, _place long").selectExpr("*", "0L as _crc", "0L as _draw")
    root, count = kd_shards.kd_tree(df, ["x", "y"], 4, tolerance=0.0)
    assert count == 2000

    def split(rows_, shards, spans):
        if len(shards) == 1:
            return {r["_place"]: shards[0] for r in rows_}
        wide = max("xy", key=lambda d: (max(r[d] for r in rows_) - min(r[d] for r in rows_)) / spans[d])
        ordered = sorted(rows_, key=lambda r: (r[wide], r["_place"]))
        goal, half, seen, cut = sum(r["_size"] for r in rows_) / 2, len(shards) // 2, 0, 0
        while seen + ordered[cut]["_size"] < goal:
            seen += ordered[cut]["_size"]
            cut += 1
        if seen + ordered[cut]["_size"] - goal < goal - seen:
            cut += 1
        return split(ordered[:cut], shards[:half], spans) | split(ordered[cut:], shards[half:], spans)

    plain = [dict(zip(("x", "y", "_size", "_place"), d)) for d in data]
    want = split(plain, range(4), {"x": 49, "y": 299})
    got = {r["_place"]: r["s"] for r in df.select("_place", root.pick(lambda n: F.lit(n.shards[0])).alias("s")).collect()}
    assert got == want


def test_target_bytes_nulls_clashes_and_empty_tables(spark):
    df = documents(spark, [(i, None if i % 2 else "abc", None, None) for i in range(40)] + [(None, "é", "en", "s")])
    df = df.withColumn("shard", F.lit("old")).withColumn("_x", F.lit(1))
    got = rows(kd_shards.kd_shards(df, shards=None, target_bytes=30))
    assert {(r["size"], r["text_crc32"]) for r in got} == {(1, 0), (4, zlib.crc32(b"abc")), (3, zlib.crc32("é".encode()))}
    assert len(check(got, 4)) == 4 and set(got[0]) == {*df.columns, "size", "text_crc32", "slot"}
    assert rows(kd_shards.kd_shards(df.where("false"))) == []


def test_query(spark):
    got = rows(QUERIES["op5_kd_shards"](spark, SF01))
    docs = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == {i: (len(t) + 1, zlib.crc32(t)) for i, t in docs.items()}
    sizes = check(got, 16)
    mean = sum(sizes.values()) / 16
    # Up to the longest document.
    assert len(sizes) == 16 and max(abs(s - mean) for s in sizes.values()) <= max(map(len, docs.values()))
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}
