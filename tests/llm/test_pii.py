import random
import re

import pytest

from annotask.llm import pii
from annotask.llm.queries import QUERIES
from tests.conftest import SF01
from tests.llm.support import documents, rows, sha


def plain_spans(text):
    """The fixed patterns as they are written down."""
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    spans = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            spans.append((*m.span(), "phone"))
    return sorted(spans, key=lambda s: (s[0], ["email", "ip", "card", "phone"].index(s[2])))


@pytest.mark.parametrize(
    "text",
    ["", "a.b@c.d", "a@b a@b.c.d-e, x%y@z.com%p@q.org", "@a.b a@.b a@b..c", "1.2.3 1.2.3.4 1.2.3.4.5 256.1.1.1 001.002.003.004 1.2.3.4.5.6.7.8",
     "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111114", "+1 (555) 010-9999 +12 +1234567890123456 ++49 30 123456.", "5 + 5", "é 4111111111111111 é", "a@b.c@d.e"],
)
def test_base_against_the_written_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_base_on_random_texts():
    draw = random.Random(6)
    for _ in range(4000):
        text = "".join(draw.choice("aB1234.@-+%( )é") for _ in range(draw.randrange(40)))
        assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000 + " @", "1" * 400_000, "1." * 200_000, "+1" * 200_000, "@" + "a." * 200_000):
        pii.candidate_spans(text, pii.base_spans(text))


def test_candidates_meet_no_base_span():
    text = "(ab12345), x@y.zz9 id:77-x 1.2.3.4 a1 no +49 30 1234567"
    known = pii.base_spans(text)
    assert [text[a:b] for a, b in pii.candidate_spans(text, known)] == ["ab12345", "id:77-x"]


def test_trusted_contexts_discover_identifiers(spark):
    draw = random.Random(1)
    docs = [(i, f"hello there please dial +1 {draw.randrange(200, 999)} 555 {draw.randrange(1000, 9999)} today, thanks") for i in range(60)]
    docs += [(100, "hello there please dial 020-7946-x12 today, thanks"), (101, "see item 020-7946-x12 of the list"), (102, "see item 99-77-x55 of the list")]
    got = {r["doc_id"]: r for r in rows(pii.extract_pii(documents(spark, docs)))}
    text = dict(docs)
    found = {i: [(s["kind"], text[i][s["start"] : s["end"]]) for s in r["added"]] for i, r in got.items() if r["added"]}
    # Found by its context, and then wherever it occurs; the other item is left alone.
    assert found == {100: [("phone", "020-7946-x12")], 101: [("phone", "020-7946-x12")]}
    assert all(len(got[i]["base"]) == 1 for i in range(60))


def test_scores_against_a_plain_statement(spark):
    draw = random.Random(9)
    edges = {(f"p{draw.randrange(12)}", f"i{k}", None if k % 9 == 0 else ("card" if k % 9 < 8 else "ip")) for k in range(300) for _ in range(2)}
    accepted, trusted = pii.bootstrap(spark.createDataFrame(sorted(edges, key=str), "pattern string, instance string, kind string"), trust=0.7)
    links = {(p, i) for p, i, _ in edges}
    known = {(i, k): 1.0 for _, i, k in edges if k}
    seeded, before = {i for i, _ in known}, 0
    for _ in range(pii.ROUNDS):
        shares = {}
        for p in {p for p, _ in links}:
            mine = {i for q, i in links if q == p}
            for kind in ("card", "ip"):
                have = [known[i, kind] for i in mine if (i, kind) in known]
                if len(have) >= pii.SUPPORT and sum(have) / (len(mine) + 1) >= 0.7:
                    shares[p, kind] = sum(have) / (len(mine) + 1)
        new = {}
        for i in {i for _, i in links} - seeded:
            for kind in ("card", "ip"):
                doubt = 1.0
                for p, k in shares:
                    doubt *= 1 - shares[p, k] if k == kind and (p, i) in links else 1
                if 1 - doubt >= 0.7:
                    new[i, kind] = 1 - doubt
        known = {k: v for k, v in known.items() if k[0] in seeded} | new
        if len(new) == before:
            break
        before = len(new)
    assert {(r["instance"], r["kind"]): round(r["certainty"], 9) for r in rows(accepted)} == {k: round(v, 9) for k, v in new.items()}
    assert {(r["pattern"], r["kind"]): round(r["share"], 9) for r in rows(trusted)} == {k: round(v, 9) for k, v in shares.items()}


def test_nulls_repeats_clashes_and_empty_tables(spark):
    df = documents(spark, [(1, None), (1, "a@b.cc"), (1, "a@b.cc"), (None, ""), (2, "no data")]).selectExpr("*", "1 as mentions", "2 as place")
    got = rows(pii.extract_pii(df))
    assert sorted(len(r["base"]) for r in got) == [0, 0, 0, 1, 1] and not any(r["added"] for r in got)
    assert rows(pii.extract_pii(df.where("false"))) == []


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    for r in rows(QUERIES["op7_pii"](spark, SF01)):
        spans = plain_spans(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == k for s in spans) for k in pii.KINDS]
        assert r["base_sha256"] == sha(joined)
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))
