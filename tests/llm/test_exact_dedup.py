from pyspark.sql import functions as F

from annotask.llm.exact_dedup import digest_state, exact_dedup
from annotask.session import scratch_path
from tests.llm.support import documents, rows, sha


def by_id(df):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in rows(df)}


def test_copies_nulls_white_space_and_clashing_columns(spark):
    df = documents(spark, [(5, "a  b"), (3, "a\tb"), (4, "a b "), (1, None), (2, ""), (9, "c"), (None, "c"), (None, "only")])
    df = df.withColumn("digest", F.lit("mine")).withColumn("locator", F.lit(1)).withColumn("kept", F.lit("old"))
    got = rows(exact_dedup(df))
    assert {(r["doc_id"], r["text"], r["keep_id"], r["group_size"], r["kept"]) for r in got} == {
        (5, "a  b", 3, 2, False), (3, "a\tb", 3, 2, True), (4, "a b ", 4, 1, True), (1, None, 1, 2, True), (2, "", 1, 2, False),
        (9, "c", 9, 2, True), (None, "c", 9, 2, False), (None, "only", None, 1, True)}
    assert {r["text_sha256"] for r in got if r["doc_id"] in (3, 5)} == {sha("a b")}
    assert got[0]["digest"] == "mine" and got[0]["locator"] == 1


def test_rows_that_repeat_keep_one(spark):
    df = documents(spark, [(1, "same")] * 4 + [(2, "same")])
    got = rows(exact_dedup(df))
    assert [r["kept"] for r in got].count(True) == 1
    assert {(r["keep_id"], r["group_size"]) for r in got} == {(1, 5)}
    assert [r["doc_id"] for r in got if r["kept"]] == [1]


def test_equal_digests_of_different_texts(spark):
    texts = [(i, f"text {i % 7}") for i in range(40)]
    weak = exact_dedup(documents(spark, texts), digest=lambda c: F.substring(F.sha2(c, 256), 1, 1))
    want = {i: (i % 7, len([t for t in texts if t[0] % 7 == i % 7]), i < 7) for i, _ in texts}
    assert by_id(weak) == want
    assert {r["text_sha256"] for r in rows(weak)} == {sha(f"text {k}") for k in range(7)}


def test_empty_table(spark):
    assert rows(exact_dedup(documents(spark, [(1, "x")]).where("false"))) == []


def test_state_goes_on_where_it_stopped(spark):
    staged, checkpoint = scratch_path(spark, "test-staged"), scratch_path(spark, "test-state")
    schema = "digest string, id long, locator struct<file:string,row:long>"
    def add(*values):
        spark.createDataFrame([(d, i, ("f", i)) for d, i in values], schema).coalesce(1).write.mode("append").parquet(staged)
        state = digest_state(spark, staged, spark.read.parquet(staged).schema, checkpoint)
        return {r["digest"]: (r["first"]["id"], r["members"]) for r in state.collect()}
    assert add(("x", 5), ("y", 6)) == {"x": (5, 1), "y": (6, 1)}
    assert add(("x", 2), ("x", 9)) == {"x": (2, 3), "y": (6, 1)}
