"""Hard negatives against plain-Python statements of the rules."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from annotask.llm.hard_negatives import best_of, hard_negatives, strassen

VECTORS = "vec_id long, embedding array<float>, label int"
OUT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, every, positives=5, negatives=5, low=80, high=100, scale=256):
    kept = []
    for id_, vec, label in rows:
        if label is not None and vec is not None and all(x is not None and math.isfinite(x) for x in vec):
            kept.append((id_, [math.floor(scale * float(np.float32(x))) for x in vec], label))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    def first(found, count):
        return sorted(found, key=lambda f: (-f[1], f[0] is None, f[0] or 0))[:count]

    out = []
    for i, (anchor, vec, label) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        others = [(id_, score(vec, v), lab) for j, (id_, v, lab) in enumerate(kept) if j != i]
        for pid, ps, _ in first([o for o in others if o[2] == label], positives):
            inside = [o for o in others if o[2] != label and low * ps <= 100 * o[1] <= high * ps]
            out += [(anchor, pid, r, n[0], ps, n[1]) for r, n in enumerate(first(inside, negatives), 1)]
    return sorted(out, key=repr)


def mined(df, every, **options):
    found = hard_negatives(df, F.col("vec_id") % every == 0, **options)
    assert found.columns == list(OUT)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def data(n, dims, labels, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dims)
    return [(i, (centre + rng.normal(size=dims)).astype(np.float32).tolist(), int(rng.integers(labels))) for i in range(n)]


@given(st.integers(1, 40), st.integers(1, 40), st.integers(1, 40), st.integers(1, 9), st.integers(0, 2**32 - 1))
@settings(max_examples=60, deadline=None)
def test_strassen_is_the_product(m, k, n, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(10**6), 10**6, (m, k)), rng.integers(-(10**6), 10**6, (k, n))
    assert (strassen(a, b, leaf) == a @ b).all()


def test_strassen_is_exact_where_its_sums_wrap():
    a = np.array([[2**31, 2**31 - 1], [-(2**31), 5]] * 8, dtype=np.int64)
    b = a.T.copy()
    assert (strassen(a, b, 1).astype(object) == a.astype(object) @ b.astype(object)).all()


def test_best_of_takes_the_first_of_equals():
    scores = np.array([5, 9, 5, 5, 9, 1])
    assert best_of(scores, scores != 1, 3).tolist() == [1, 4, 0]
    assert best_of(scores, scores > 100, 3).tolist() == []


@pytest.mark.parametrize("labels", [2, 9])
def test_against_brute_force(spark, labels):
    rows = data(160, 7, labels)
    df = spark.createDataFrame(rows, VECTORS)
    # Small tiles and packs: labels end inside tiles, heaps merge across tasks.
    assert mined(df, 10, tile=13, pack=3) == brute(rows, 10)
    assert mined(df, 10) == brute(rows, 10)


def test_one_hot_label_and_ties(spark):
    rows = [(i, [1.0, float(i % 3)], 0 if i % 3 else i % 5) for i in range(90)]
    df = spark.createDataFrame(rows, VECTORS)
    assert mined(df, 30, tile=8, pack=2, low=10) == brute(rows, 30, low=10)


def test_nulls_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 1.0], 1), (1, [1.0], 1), (2, [1.0, 0.9], 2), (3, None, 1), (4, [nan, 1.0], 2), (5, [inf], 2),
        (6, [None, 1.0], 1), (7, [1.0, 1.0], None), (None, [1.0, 1.0], 2), (None, [1.0, 1.0], 1), (8, [], 2),
    ]
    df = spark.createDataFrame(rows, VECTORS)
    found = mined(df, 4, low=0)
    assert found == brute(rows, 4, low=0)
    assert any(r[3] is None for r in found) and any(r[1] is None for r in found)


def test_rows_that_repeat_are_rows_of_their_own(spark):
    rows = [(0, [1.0], 1), (0, [1.0], 1), (1, [0.9], 2), (1, [0.9], 2)]
    found = mined(spark.createDataFrame(rows, VECTORS), 5)
    assert found == sorted([(0, 0, r, 1, 65536, 256 * 230) for r in (1, 2)] * 2, key=repr)


def test_empty_and_lonely(spark):
    assert mined(spark.createDataFrame([], VECTORS), 5) == []
    assert mined(spark.createDataFrame([(0, [1.0], 1)], VECTORS), 5) == []
    assert mined(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 1)], VECTORS), 5) == []


def test_columns_that_clash(spark):
    rows = data(60, 3, 2)
    df = spark.createDataFrame(rows, VECTORS)
    for name in ("tile", "pack", "at", "id", "rank", "place"):
        df = df.withColumn(name, F.lit("x"))
    assert mined(df, 20) == brute(rows, 20)


def test_scores_beyond_64_bits_are_refused(spark):
    with pytest.raises(ValueError):
        mined(spark.createDataFrame([(0, [1e12], 1), (1, [-1e30], 1)], VECTORS), 5)
