import hashlib
import struct

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from annotask.llm import bpe
from annotask.llm.queries import QUERIES
from tests.conftest import SF001
from tests.llm.support import documents, rows

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.parse_ranks(bpe.read_vocabulary(PATH).splitlines())
CODEC = bpe.Codec(RANKS, public_tokenizers.PATTERN, max_states=2000, max_pieces=300)
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@pytest.mark.parametrize(
    "text",
    ["", " ", "a", "aaaaaaaaaaaaaaaaa", "the cat\n\n  sat ", "é" * 99, "日本語 \U0001f642\U0001f642", "ÃÂ" * 40, "x" * 3000, " " * 700,
     "don't we'll I'm 12345 £5", "tab\tand\x1cseparator\x85\xa0", "<|endoftext|>", "àb‍", "=" * 500],
)
def test_encodes_as_the_reference_library(text):
    packed = CODEC.encode(text)
    assert ids(packed) == REFERENCE.encode_ordinary(text)
    assert CODEC.decode(packed) == text


@pytest.mark.parametrize("length", range(1, bpe.SHORT_PIECE + 2))
def test_short_pieces_are_merged_and_long_ones_are_not(length, monkeypatch):
    codec, walked = CODEC, []
    codec._pieces.clear()
    encode = codec._pieces.transducer.encode
    monkeypatch.setattr(codec._pieces.transducer, "encode", lambda piece: walked.append(piece) or encode(piece))
    piece = ("zqhringsataq" * 5)[:length]
    assert ids(codec.encode(piece)) == REFERENCE.encode_ordinary(piece)
    assert bool(walked) == (length > bpe.SHORT_PIECE)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abeth ing\n'sé中\U0001f600"), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_any_text_round_trips(text):
    packed = CODEC.encode(text)
    assert ids(packed) == REFERENCE.encode_ordinary(text)
    assert CODEC.decode(packed) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(sorted(RANKS.values())), min_size=2, max_size=2))
def test_a_pair_may_follow_when_merging_gives_it_back(pair):
    transducer = CODEC._pieces.transducer
    a, b = (transducer.bytes_of[t] for t in pair)
    assert transducer.follows(*pair) == (bpe.merge_by_rank(a + b, RANKS) == [a, b])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=6)))
def test_utf8_machine_decodes_any_split(parts):
    machine = bpe.Utf8Machine()
    got = "".join(map(machine.feed, parts)) + machine.finish()
    assert got == b"".join(parts).decode("utf-8", "replace")


def test_small_caches_do_not_change_the_ids():
    tiny = bpe.Codec(RANKS, public_tokenizers.PATTERN, max_states=3, max_pieces=1)
    text = "Some words come again and again, other words do not."
    assert ids(tiny.encode(text)) == REFERENCE.encode_ordinary(text)


def test_nulls_repeats_clashing_columns_and_empty_tables(spark):
    df = documents(spark, [(1, "a b"), (1, "a b"), (2, None), (3, "")]).selectExpr("*", "'x' as token_ids", "1 as decoded")
    got = rows(bpe.encode_texts(df, PATH, public_tokenizers.PATTERN, decoded_col="decoded"))
    assert [(r["doc_id"], ids(r["token_ids"]), r["decoded"]) for r in got] == [
        (1, REFERENCE.encode_ordinary("a b"), "a b"), (1, REFERENCE.encode_ordinary("a b"), "a b"), (2, [], ""), (3, [], "")]
    assert set(got[0]) == {"doc_id", "text", "lang", "source", "n_chars", "token_ids", "decoded"}
    assert bpe.encode_texts(df.where("false"), PATH, public_tokenizers.PATTERN).count() == 0


def test_decode_ids(spark):
    coded = bpe.encode_texts(documents(spark, [(1, "été \U0001f642"), (2, None)]), PATH, public_tokenizers.PATTERN)
    got = {r["doc_id"]: r["back"] for r in rows(bpe.decode_ids(coded, PATH, text_col="back"))}
    assert got == {1: "été \U0001f642", 2: ""}


def test_query_against_the_reference_library(spark):
    want = {}
    for r in spark.read.parquet(f"{SF001}/documents.parquet").collect():
        found = REFERENCE.encode_ordinary(r["text"] or "")
        packed = struct.pack(f"<{len(found)}I", *found)
        want[r["doc_id"]] = (len(found), hashlib.sha256(packed).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op3_byte_bpe"](spark, SF001).collect()}
    assert got == want


MACHINES = {met: bpe.LazyTransducer(RANKS, max_states=3000) for met in (0, 2, 32)}
for _met, _machine in MACHINES.items():
    _machine.MET = _met


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.binary(min_size=1, max_size=30), st.text(alphabet="abeting é", min_size=1, max_size=30).map(str.encode)))
def test_machine_and_walk_give_the_merge_result(piece):
    want = [RANKS[part] for part in bpe.merge_by_rank(piece, RANKS)]
    assert MACHINES[0].walk(piece) == want
    for machine in MACHINES.values():
        # Missed, then made, then found.
        assert [machine.encode(piece) for _ in range(4)] == [want] * 4


@pytest.mark.parametrize("met", [0, 3])
def test_states_are_bounded_inside_one_piece(met):
    rng = np.random.default_rng(4)
    piece = bytes(rng.choice(list(b"abcdefghijklmnopqrstuvwxyz"), 40_000).tolist())
    machine = bpe.LazyTransducer(RANKS, max_states=500)
    machine.MET = met
    want = REFERENCE.encode_ordinary(piece.decode())
    for _ in range(5):
        assert machine.encode(piece) == want
        assert len(machine._paths) <= 500 and len(machine._missed) <= 2000


def test_every_piece_goes_through_the_transducer(monkeypatch):
    codec, met = bpe.Codec(RANKS, public_tokenizers.PATTERN), []
    transducer = codec._pieces.transducer
    encode = transducer.encode
    monkeypatch.setattr(transducer, "encode", lambda piece: met.append(piece) or encode(piece))
    # Vocabulary entries, short and long pieces, in texts that Latin-1 can hold and in others.
    for text in ("a the cat thatlyoning don't 12345 £5\n\n  é" + "zqhringsataq" * 9, "日本 the cat thatlyoning \U0001f642"):
        assert ids(codec.encode(text)) == REFERENCE.encode_ordinary(text)
    assert {"a", " the", " cat", " thatlyoning", "'t", " 12345", " £", "5", "日本", " \U0001f642"} <= {piece.decode() for piece in met}
    assert any(len(piece) > 100 for piece in met)


def test_words_make_arcs():
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    words = " ".join(f"thely{a}{b}ning" for a in "abcdefghij" for b in "klmnopqrst")
    assert ids(codec.encode(words)) == REFERENCE.encode_ordinary(words)
    assert len(codec._pieces.transducer._paths) > 1


def test_entries_go_through_the_transducer_unchanged():
    for machine in (MACHINES[0], MACHINES[32]):
        assert all(machine.encode(token) == [rank] == machine.walk(token) for token, rank in list(RANKS.items())[::7])
