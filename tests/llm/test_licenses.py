"""License scans against a plain-Python statement that tries every block."""

import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from annotask.llm.licenses import CONTAINMENT, LICENSE_WORD, NOTICES, PHRASES, block_step, license_scan, split_words
from tests.llm.support import documents, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FACTS = ("n_words", "base", "base_labels", "labels", "license_score")


def brute(text, notices=NOTICES, phrases=PHRASES, threshold=CONTAINMENT):
    words = re.findall(LICENSE_WORD, (text or "").translate(LOWER))
    base = []
    for at in range(len(words)):
        base += [(at, label) for label, phrase in phrases if words[at : at + len(phrase.split())] == phrase.split()]
    labels, best = {label for _, label in base}, 0.0
    for label, notice in notices:
        of = split_words(notice)
        tokens, step = set(of), block_step(len(of))
        for start in range(0, len(words), step):
            held = len(tokens & set(words[start : start + 2 * step]))
            if held >= math.ceil(threshold * len(tokens) - 1e-9):
                labels.add(label)
                best = max(best, held / len(tokens))
    return len(words), base, sorted({x for _, x in base}), sorted(labels), 1.0 if base else best


def scanned(df, key="doc_id", **options):
    out = license_scan(df, **options)
    return {
        r[key]: (r["n_words"], [(p["start"], p["label"]) for p in r["base"]], *(r[c] for c in FACTS[2:])) for r in rows(out)
    }


MIT = "Released under the MIT License."
TEXTS = [
    None, "", "  \n", "no words of law here", "All rights reserved. ALL RIGHTS RESERVED all rights, reserved",
    f"Some prose. {MIT} More prose.", "Released under the License.", "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.", "cc by cc by cc cc by",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "ASSOCIATED documentation files, to deal in the software without any restriction",
    "ÄRGER über mit license the released under", "copyright " * 50 + MIT, ("word " * 997 + MIT + " ") * 30,
]


def test_against_every_block(spark):
    found = scanned(documents(spark, list(enumerate(TEXTS))))
    assert found == {i: brute(t) for i, t in enumerate(TEXTS)}
    assert found[5][3] == ["mit"] and found[6][3] == [] and found[7][3] == ["cc-by", "cc-by-nc"] and found[8][3] == ["gpl"]
    assert found[10][3] == ["mit"] and found[13][3] == ["mit"]


@given(
    st.lists(st.lists(st.sampled_from("a b c d e f g h the".split()), max_size=60).map(" ".join), min_size=1, max_size=6),
    st.sampled_from([0.3, 0.5, 0.75, 1.0]),
)
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_no_block_is_lost_at_any_threshold(spark, texts, threshold):
    notices = [("one", "a b c d"), ("two", "the e f a a b"), ("three", "g"), ("four", "the the the h g c d e f a b")]
    found = scanned(documents(spark, list(enumerate(texts))), notices=notices, threshold=threshold)
    assert found == {i: brute(t, notices, threshold=threshold) for i, t in enumerate(texts)}


def test_a_passage_inside_any_block_border(spark):
    texts = [" ".join(["x"] * n) + " " + MIT for n in range(40)]
    assert all(v[3] == ["mit"] for v in scanned(documents(spark, list(enumerate(texts)))).values())


def test_repeated_rows_and_null_ids(spark):
    df = documents(spark, [(1, MIT), (1, MIT), (None, MIT), (None, "x")])
    out = rows(license_scan(df))
    assert sorted(r["labels"] for r in out) == [[], ["mit"], ["mit"], ["mit"]]
    assert sorted((r["doc_id"] is None, r["n_words"]) for r in out) == [(False, 5), (False, 5), (True, 1), (True, 5)]


def test_empty_table_and_no_notices(spark):
    assert rows(license_scan(documents(spark, []))) == []
    found = scanned(documents(spark, [(1, MIT), (2, "all rights reserved")]), notices=())
    assert found == {1: (5, [], [], [], 0.0), 2: (3, [(0, "reserved")], ["reserved"], ["reserved"], 1.0)}
    assert scanned(documents(spark, [(1, "all rights reserved")]), phrases=())[1][1:] == ([], [], [], 0.0)


def test_clashing_columns(spark):
    df = documents(spark, [(1, MIT)])
    for name in ("key", "row", "words", "held", "labels", "n_words", "step", "block", "rank"):
        df = df.withColumn(name, F.lit(name))
    out = license_scan(df)
    (row,) = rows(out)
    assert row["labels"] == ["mit"] and row["n_words"] == 5
    assert all(row[c] == c for c in ("key", "row", "words", "held", "step", "block", "rank"))
    assert "text" not in out.columns


def test_thresholds_are_checked(spark):
    with pytest.raises(ValueError):
        license_scan(documents(spark, []), threshold=0.0)


def test_no_python_in_the_plan(spark):
    plan = license_scan(documents(spark, [(1, MIT)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
