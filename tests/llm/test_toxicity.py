import math
import random
import zlib

import numpy as np
import pytest

from annotask.llm import toxicity
from annotask.llm.queries import QUERIES
from tests.conftest import SF01
from tests.llm.support import documents, rows

BAD = ("foul", "vile")


def corpus(n, seed=5):
    draw = random.Random(seed)
    words = [f"w{draw.randrange(400)}" for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        text, bad = [draw.choice(words) for _ in range(draw.randrange(5, 60))], i % 4 == 0
        if bad:
            text.insert(draw.randrange(len(text)), draw.choice(BAD))
        docs.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    return docs, labels


def test_learns_the_words_and_keeps_few_weights(spark):
    docs, labels = corpus(3000)
    got = rows(toxicity.toxicity(documents(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")))
    marked = dict(labels)
    assert {r["doc_id"]: r["held_out"] for r in got} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in docs}
    unseen = [r for r in got if r["held_out"]]
    assert np.mean([r["predicted"] == marked[r["doc_id"]] for r in unseen]) > 0.98
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got)
    coords, weights, _ = toxicity.learn([toxicity.coordinates(t) for _, t in docs[:2000]], [marked[i] for i, _ in docs[:2000]])
    strongest = set(coords[np.argsort(-weights)[:2]].tolist())
    assert strongest == {int(toxicity.coordinates(w)[0]) for w in BAD} and len(coords) < 200


def test_held_out_labels_are_never_used(spark):
    docs, labels = corpus(400)
    df = documents(spark, docs)
    wrong = [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in labels]
    a, b = ({r["doc_id"]: r["score"] for r in rows(toxicity.toxicity(df, spark.createDataFrame(x, "doc_id long, toxic int")))} for x in (labels, wrong))
    assert a == b


def test_ftrl_against_a_plain_statement():
    draw = random.Random(1)
    data = [np.array(draw.sample(range(12), 4), dtype=np.uint32) for _ in range(60)]
    labels = [int(0 in d or 3 in d) for d in data]
    z, n, alpha, beta, l1, l2 = {}, {}, 0.5, 1.0, 0.4, 0.1

    def weight(i):
        limit = 0.0 if i < 0 else l1
        if abs(z.get(i, 0.0)) <= limit:
            return 0.0
        return -math.copysign(abs(z[i]) - limit, z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(3):
        for d, y in zip(data, labels):
            at = [*map(int, d), -1]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in at:
                s = (math.sqrt(n.get(i, 0) + g * g) - math.sqrt(n.get(i, 0))) / alpha
                z[i], n[i] = z.get(i, 0) + g - s * w[i], n.get(i, 0) + g * g
    coords, weights, bias = toxicity.ftrl(data, labels, 3, l1, alpha, beta, l2)
    assert bias == pytest.approx(weight(-1))
    assert dict(zip(coords.tolist(), weights)) == pytest.approx({i: weight(i) for i in range(12) if weight(i)})


def test_calibration_recovers_scale_and_offset():
    draw = np.random.default_rng(3)
    logits = draw.normal(size=20_000) * 2
    labels = (draw.random(20_000) < 1 / (1 + np.exp(-(3 * logits + 1)))).astype(int)
    assert toxicity.calibration(logits, labels) == pytest.approx((3, 1), abs=0.15)
    assert toxicity.calibration(logits, np.zeros(20_000, int)) == (1.0, 0.0)
    apart = np.concatenate((np.full(900, -6.0), np.full(100, -2.0)))
    scale, offset = toxicity.calibration(apart, (apart > -4).astype(int))
    assert scale > 1 and scale * -2 + offset > 2 > -2 > scale * -6 + offset


def test_coordinates_hold_words_pairs_and_skips():
    got = toxicity.coordinates("One, two THREE")
    assert len(got) == 3 + 2 + 1 and len(set(got.tolist())) == 6
    assert len(toxicity.coordinates(None)) == len(toxicity.coordinates(" ,. ")) == 0
    assert set(toxicity.coordinates("two three")) <= set(got.tolist())


def test_nulls_repeats_clashes_and_missing_labels(spark):
    df = documents(spark, [(1, None), (1, ""), (None, "w"), (2, "a " * 50_000)]).selectExpr("*", "'x' as score", "3 as predicted")
    none = spark.createDataFrame([(None, 1), (2, None)], "doc_id long, toxic int")
    got = rows(toxicity.toxicity(df, none))
    assert {r["score"] for r in got} == {0.5} and len(got) == 4 and {r["predicted"] for r in got} == {0}
    assert set(got[0]) == {*df.columns, "held_out"}
    assert rows(toxicity.toxicity(df.where("false"), none)) == []


def test_query_on_held_out_rows(spark):
    got = {r["doc_id"]: r for r in rows(QUERIES["op6_toxicity"](spark, SF01))}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    clean = [got[i] for i, t in labels.items() if got[i]["held_out"] and not t]
    toxic = [got[i] for i, t in labels.items() if got[i]["held_out"] and t]
    assert len(got) == 1000 and sum(r["predicted"] for r in clean) == 0
    # A few hundred labels only here, some of texts without any toxic word.
    assert np.mean([r["score"] for r in toxic]) > np.mean([r["score"] for r in clean]) + 0.4


def recall(spark, docs, labels, max_rows):
    """Shares of toxic and of clean rows that reach the threshold, of 400 rows not learned from."""
    known, unseen = docs[:-400], docs[-400:]
    marked = spark.createDataFrame(labels, "doc_id long, label int")
    weights = toxicity.train(documents(spark, known).join(marked, "doc_id"), max_rows=max_rows)
    got = {r["doc_id"]: r["score"] >= toxicity.THRESHOLD for r in rows(toxicity.scored(documents(spark, unseen), weights))}
    return tuple(np.mean([got[i] for i, t in labels[-400:] if t == k]) for k in (1, 0))


def test_rare_labels_are_not_thinned_out(spark):
    docs, labels = corpus(8400)
    docs = [(k, t.replace("foul", f"foul{k // 80 % 3}").replace("vile", f"vile{k // 80 % 3}")) for k, t in docs]
    # One toxic row of about sixty among the rows to learn from.
    kept = [k for k in range(len(docs)) if k >= 8000 or not labels[k][1] or k % 80 == 0]
    toxic, clean = recall(spark, [docs[k] for k in kept], [labels[k] for k in kept], 400)
    assert toxic > 0.8 and clean < 0.02


def test_few_labels_are_calibrated_too(spark):
    docs, labels = corpus(560)
    toxic, clean = recall(spark, docs, labels, toxicity.MAX_TRAINING_ROWS)
    assert toxic > 0.8 and clean < 0.02
