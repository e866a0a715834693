import itertools
import random

import xxhash

from annotask.llm import simhash
from annotask.llm.queries import QUERIES
from tests.conftest import SF001
from tests.llm.support import WORD, documents, rows


def plain_print(text, length=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    shingles = [" ".join(words[i : i + length]) for i in range(max(1, len(words) - length + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=2):
    """prints: [(id, print)] -> smallest id reachable, per row."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
            root[find(i)] = find(j)
    least = {}
    for i, (id_, _) in enumerate(prints):
        least[find(i)] = min(least.get(find(i), id_), id_)
    return [least[find(i)] for i in range(len(prints))]


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for i, j in itertools.combinations(range(64), 2):
        assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def planted(spark, prints):
    return spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long")


def roots(spark, prints, pairwise):
    found = simhash.print_roots(planted(spark, prints), 2, pairwise).collect()
    return {r["print"] % (1 << 64): r["root"] for r in found}


def test_links_of_small_and_crowded_buckets_agree_with_brute_force(spark):
    draw = random.Random(3)
    prints = set()
    for _ in range(12):  # chains and clouds around centres, and loners
        at = draw.getrandbits(64)
        for _ in range(25):
            prints.add(at)
            at ^= 1 << draw.randrange(64)
            if draw.random() < 0.7:
                at ^= 1 << draw.randrange(64)
            if draw.random() < 0.1:
                at ^= 0b111 << draw.randrange(60)
    prints = sorted(prints)
    want = plain_components([(p, p) for p in prints])
    groups = {}
    for p, w in zip(prints, want):
        groups.setdefault(w, set()).add(p)
    for pairwise in (16, 1):
        found = roots(spark, prints, pairwise)
        got = {}
        for p, r in found.items():
            got.setdefault(r, set()).add(p)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values())), pairwise


def test_one_large_cloud(spark):
    centre = 0x123456789ABCDEF0
    prints = [centre] + [centre ^ 1 << i for i in range(64)] + [centre ^ 1 << i ^ 1 << j for i in range(8) for j in range(8, 64)]
    assert len(set(roots(spark, prints, 16).values())) == 1


def test_nulls_empty_texts_ties_and_clashing_columns(spark):
    df = documents(spark, [(7, None), (3, ""), (9, " \t "), (2, "One two"), (2, "one TWO"), (4, "ÀB c d e"), (None, "quite another text here")])
    df = df.selectExpr("*", "1 as print", "'z' as fingerprint", "2 as component_id")
    got = rows(simhash.simhash_groups(df))
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(7, 3), (3, 3), (9, 3), (2, 2), (4, 4), (None, None)}
    assert len(got) == 7
    assert {r["fingerprint"] for r in got if r["doc_id"] == 4} == {f"{plain_print('ÀB c d e'):016x}"}
    stays = rows(simhash.one_per_group(df))
    assert sorted((r["doc_id"] or 0) for r in stays) == [0, 2, 3, 4]
    assert set(stays[0]) == set(df.columns)
    assert rows(simhash.simhash_groups(df.where("false"))) == [] == rows(simhash.one_per_group(df.where("false")))


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], plain_print(r["text"])) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = {i: (f"{p:016x}", c) for (i, p), c in zip(docs, plain_components(docs))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op8_simhash"](spark, SF001).collect()}
    assert got == want
