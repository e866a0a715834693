import base64
import collections

import pyspark.sql.functions as F
import pytest

import __spark_entry__
import corpus_pipeline
from annotask.llm import toxicity
from tests.llm.support import documents, rows
from tests.llm.test_bpe import REFERENCE, ids
from tests.llm.test_simhash import plain_components, plain_print


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus: clean documents, toxic ones, copies and near copies; two sources."""
    where = tmp_path_factory.mktemp("corpus")
    docs, labels = [], []
    for i in range(240):
        text = " ".join(f"w{(i * 37 + k * (i % 13 + 3)) % 211}" for k in range(30 + i % 50))
        toxic = i % 5 == 0
        docs.append((i, text + (" you vile thing" if toxic else ""), "en", "ab"[i % 3 == 0]))
        labels.append((i, int(toxic)))
    for i in range(240, 270):
        docs.append((i, docs[i - 200][1] + "  ", "en", "a"))
    documents(spark, docs + [(300, None, "en", "b"), (301, "", None, None)]).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{where}/labels.parquet")
    return str(where)


def test_each_stage_against_a_plain_statement(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r["doc_id"]: r for r in rows(docs)}
    columns, results = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/stage-{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns or k == 4
        results.append(rows(docs))
    toxic, exact, near, mixed, coded = results

    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = toxicity.toxicity(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    assert {r["doc_id"] for r in toxic} == {r["doc_id"] for r in rows(judged) if not r["predicted"]}
    assert not any("vile" in (r["text"] or "") for r in toxic) and len(toxic) >= 190

    first = {}
    for r in sorted(toxic, key=lambda r: r["doc_id"]):
        first.setdefault(" ".join((r["text"] or "").split(" ")).rstrip() if (r["text"] or "").strip() else "", r["doc_id"])
    assert {r["doc_id"] for r in exact} >= set(first.values())
    assert len({r["doc_id"] for r in exact}) == len(exact) == len({" ".join((r["text"] or "").split()) + "|" * (r["text"] or "").endswith(" ") for r in toxic})

    prints = [(r["doc_id"], plain_print(r["text"])) for r in exact]
    assert {r["doc_id"] for r in near} == set(plain_components(prints))
    for r in near:
        assert r == kept[r["doc_id"]]

    times = collections.Counter(r["doc_id"] for r in mixed)
    size = {r["doc_id"]: len((r["text"] or "").split()) for r in near}
    assert set(times) <= set(size) and max(times.values()) <= 3
    total = sum(size.values())
    taken = sum(size[i] * n for i, n in times.items())
    assert abs(taken - total) <= 2 * max(size.values())

    assert len(coded) == len(mixed)
    assert all(ids(r["token_ids"]) == REFERENCE.encode_ordinary(kept[r["doc_id"]]["text"] or "") for r in coded)
    assert "text" not in coded[0] and all(r["n_tokens"] * 4 == len(r["token_ids"]) for r in coded)

    whole = corpus_pipeline.run(spark, folder).select("doc_id", F.sha2("token_ids", 256).alias("h"))
    assert collections.Counter((r["doc_id"], r["h"]) for r in whole.collect()) == collections.Counter(
        (r["doc_id"], r["h"]) for r in docs.select("doc_id", F.sha2("token_ids", 256).alias("h")).collect())


def test_an_empty_table_passes_through(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0


def test_ids_that_do_not_give_back_the_text_stop_the_last_stage(spark, tmp_path, monkeypatch):
    docs = documents(spark, [(1, "ab"), (2, None), (3, ""), (4, "b é")])
    assert {r["doc_id"]: r["n_tokens"] for r in rows(corpus_pipeline.encode(spark, docs, ""))}.keys() == {1, 2, 3, 4}
    # A rank file that gives two bytes one rank.
    ranks = [(bytes([i]), 97 if i == 98 else i) for i in range(256)]
    (tmp_path / "ranks").write_bytes(b"".join(base64.b64encode(token) + b" %d\n" % rank for token, rank in ranks))
    monkeypatch.setattr(corpus_pipeline.public_tokenizers, "path", lambda name: str(tmp_path / "ranks"))
    assert ids(rows(corpus_pipeline.encode(spark, docs.where("doc_id = 2"), ""))[0]["token_ids"]) == []
    with pytest.raises(Exception, match="do not give back the text of doc_id 1"):
        corpus_pipeline.encode(spark, docs.where("doc_id = 1"), "").select("doc_id").collect()


def test_registered():
    found = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {name.split("_")[0] for name in found} and "pipeline" in found
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "mix_sources", "byte_bpe"]
