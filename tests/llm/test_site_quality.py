import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from annotask.llm import site_quality
from annotask.llm.queries import QUERIES
from tests.conftest import SF01
from tests.llm.support import documents, rows


def judged(spark, docs, labels, **options):
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    return rows(site_quality.site_quality(documents(spark, docs), labels, F.col("source"), F.col("lang"), **options))


def corpus():
    draw = random.Random(2)
    docs, labels = [], []
    for i in range(900):
        host = "good" if i < 400 else "bad" if i < 800 else f"rare{i % 50}"
        bad = draw.random() < {"good": 0.05, "bad": 0.8}.get(host, 0.3)
        words = ["word" + draw.choice("abcdefgh") * 2 for _ in range(40)]
        # A tenth of the texts show nothing of their label.
        text = " ".join(w + ("###" if bad and draw.random() < 0.7 else "") for w in words) if i % 10 else "plain text that says nothing of itself here"
        docs.append((i, text, "en", host))
        if i % 3 == 0:
            labels.append((i, int(not bad)))
    return docs, labels


def test_evidence_decides_and_sites_decide_where_it_is_silent(spark):
    docs, labels = corpus()
    got = {r["doc_id"]: r for r in judged(spark, docs, labels)}
    sure = [i for i, _ in labels if i % 10]
    assert np.mean([got[i]["kept"] == bool(dict(labels)[i]) for i in sure]) > 0.97
    silent = {r["host"]: r["score"] for i, r in got.items() if i % 10 == 0}
    rates = {r["host"]: r["site_rate"] for r in got.values()}
    assert silent["good"] > silent["bad"] and rates["good"] > 0.9 > 0.35 > rates["bad"]
    # A host of two documents stays nearer to the rate of all than either large host.
    whole = np.mean([r["score"] for r in got.values()])
    rare = [r["site_rate"] for r in got.values() if r["host"].startswith("rare")]
    assert np.mean(np.abs(np.array(rare) - whole)) < abs(rates["bad"] - whole)


def test_rates_against_a_plain_statement(spark, monkeypatch):
    monkeypatch.setattr(site_quality, "STRENGTH", (7.0, 7.0))
    docs, labels = corpus()
    docs = [(i, t, f"p{i % 4}", s) for i, t, _, s in docs]
    got = judged(spark, docs, labels)
    prior = (sum(y for _, y in labels) + 1) / (len(labels) + 2)
    alone = {r["doc_id"]: 1 / (1 + np.exp(-r["evidence"] - np.log(prior / (1 - prior)))) for r in got}
    total, host, path = [0, 0.0], {}, {}
    for r in got:
        for sums in (total, host.setdefault(r["host"], [0, 0.0]), path.setdefault((r["host"], r["path"]), [0, 0.0])):
            sums[0] += 1
            sums[1] += alone[r["doc_id"]]
    for r in got:
        a = alone[r["doc_id"]]
        rate = (total[1] - a) / (total[0] - 1)
        for n, good in (host[r["host"]], path[r["host"], r["path"]]):
            rate = (good - a + 7 * rate) / (n - 1 + 7)
        assert r["site_rate"] == pytest.approx(rate, rel=1e-6)
        logit = r["evidence"] + np.log(rate / (1 - rate))
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-logit)), rel=1e-5)


def test_nulls_repeats_missing_labels_and_empty_tables(spark):
    docs = [(1, None, None, None), (1, None, None, None), (None, "", "en", "a"), (2, "some words", None, "a")]
    got = judged(spark, docs, [(None, 1), (7, 0), (2, None)])
    assert len(got) == 4 and {r["kept"] for r in got} == {True} and {round(r["score"], 9) for r in got} == {0.5}
    df = documents(spark, docs).selectExpr("*", "1 as host", "2 as evidence")
    labels = spark.createDataFrame([(2, 1)], "doc_id long, quality int")
    assert site_quality.site_quality(df, labels, F.col("source"), F.col("lang")).count() == 4
    assert rows(site_quality.site_quality(df.where("false"), labels, F.col("source"), F.col("lang"))) == []


def test_query_agrees_with_labels(spark):
    got = {r["doc_id"]: r["kept"] for r in rows(QUERIES["op2_site_quality"](spark, SF01))}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    assert len(got) == 1000
    assert np.mean([got[i] for i, q in labels.items() if q]) > 0.99
    assert np.mean([not got[i] for i, q in labels.items() if not q]) > 0.9
