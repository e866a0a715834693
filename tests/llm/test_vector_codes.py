"""Vector codes against a statement that measures every entry."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from annotask.llm.vector_codes import assign, hilbert_keys, shortlist, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [
        (id_, [math.floor(scale * float(np.float32(x))) for x in vec])
        for id_, vec, _ in rows
        if vec is not None and all(x is not None and math.isfinite(x) for x in vec)
    ]
    width = -(-max((len(v) for _, v in kept), default=0) // parts)
    kept = [(id_, v + [0] * (width * parts - len(v))) for id_, v in kept]
    start = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books, codes, errors = [], [""] * len(kept), [0] * len(kept)
    for part in range(parts):
        cut = [v[part * width : (part + 1) * width] for _, v in kept]
        book = [v[part * width : (part + 1) * width] for _, v in start]

        def nearest(p):
            return min((sum((x - y) ** 2 for x, y in zip(p, c)), i) for i, c in enumerate(book))

        for _ in range(rounds):
            of = [nearest(p)[1] for p in cut]
            for entry in set(of):
                own = [p for p, o in zip(cut, of) if o == entry]
                book[entry] = [sum(xs) // len(own) for xs in zip(*own)]
        for i, p in enumerate(cut):
            gap, entry = nearest(p)
            codes[i] += f"{entry:02x}"
            errors[i] += gap
        books.append(book)
    return sorted(((id_, c, e) for (id_, _), c, e in zip(kept, codes, errors)), key=repr), books


def coded(df, **options):
    out, books = vector_codes(df, **options)
    return sorted((tuple(r) for r in out.select("vec_id", "code", "code_error").collect()), key=repr), books.tolist()


def data(n, dims, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(size=dims).astype(np.float32).tolist(), int(rng.integers(3))) for i in range(n)]


@pytest.mark.parametrize("bits,dims", [(1, 2), (3, 2), (2, 3), (1, 5)])
def test_hilbert_keys_walk_the_grid_cell_by_cell(bits, dims):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@given(st.integers(0, 2**32 - 1), st.integers(1, 5), st.integers(1, 30))
@settings(max_examples=60, deadline=None)
def test_the_shortlist_never_loses_a_nearest_entry(seed, dims, entries):
    rng = np.random.default_rng(seed)
    points, book = rng.integers(-6, 6, (12, dims)), rng.integers(-9, 9, (entries, dims))
    listed = shortlist(book, points.min(axis=0), points.max(axis=0))
    chosen, gap = assign(points, book, listed)
    every = ((points[:, None] - book[None]) ** 2).sum(axis=2)
    assert chosen.tolist() == every.argmin(axis=1).tolist() and gap.tolist() == every.min(axis=1).tolist()


@pytest.mark.parametrize("block", [1, 5, 64])
def test_against_brute_force(spark, block):
    rows = data(150, 8)
    want, books = brute(rows, entries=16)
    assert coded(spark.createDataFrame(rows, VECTORS), entries=16, block=block) == (want, books)


def test_repeats_ties_and_few_rows(spark):
    rows = [(i % 7, [float(i % 2), 1.0, -float(i % 3), 0.5], 0) for i in range(40)]
    want, books = brute(rows)
    assert coded(spark.createDataFrame(rows, VECTORS), block=4) == (want, books)


def test_nulls_and_lengths(spark):
    rows = [
        (1, [0.5, -0.5, 1.0, 2.0, 3.0], 0), (2, [0.1], None), (3, None, 1), (4, [float("nan")] * 4, 1), (5, [None, 1.0], 1),
        (6, [float("inf")], 1), (None, [0.3, 0.2], 2), (7, [], 2),
    ]
    want, books = brute(rows, entries=2)
    assert len(want) == 4
    assert coded(spark.createDataFrame(rows, VECTORS), entries=2) == (want, books)


def test_empty_table_and_no_components(spark):
    assert coded(spark.createDataFrame([], VECTORS))[0] == []
    assert coded(spark.createDataFrame([(1, [], 0), (2, [], 0)], VECTORS))[0] == [(1, "00000000", 0), (2, "00000000", 0)]


def test_columns_that_clash_are_kept(spark):
    rows = data(30, 4)
    df = spark.createDataFrame(rows, VECTORS)
    for name in ("key", "part", "code", "vec", "row", "id"):
        df = df.withColumn(name, F.lit(name.upper()))
    out, _ = vector_codes(df, entries=4)
    assert set(out.columns) == {"vec_id", "label", "key", "part", "vec", "row", "id", "code", "code_error"}
    assert out.where("key = 'KEY' and part = 'PART' and vec = 'VEC' and row = 'ROW' and id = 'ID' and length(code) = 8").count() == 30
    assert sorted((tuple(r) for r in out.select("vec_id", "code", "code_error").collect()), key=repr) == brute(rows, entries=4)[0]


def test_components_beyond_64_bits_are_refused(spark):
    with pytest.raises(ValueError):
        coded(spark.createDataFrame([(0, [1e12], 1)], VECTORS))
