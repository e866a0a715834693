import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from annotask.llm import chat
from tests.llm.support import rows

SCHEMA = "conv_id long, turn long, role string, text string"


def order(turns):
    return sorted(turns, key=lambda t: (t[1] is None, t[1] or 0, t[2] or "", t[3] or ""))


def cost(text):
    return -(-len((text or "").encode()) // 4) + chat.OVERHEAD


def conversation(conv, n, long_at=()):
    out = [(conv, 0, "system", "be kind")]
    for k in range(1, n):
        out.append((conv, k, "user" if k % 2 else "assistant", f"turn {k} " + "word " * (400 if k in long_at else k * 37 % 23)))
    return out


def windows_of(spark, turns, **options):
    df = spark.createDataFrame(turns, SCHEMA)
    found = chat.chat_windows(df, **options)
    back = {(r["conv"], r["window"]): r for r in rows(chat.read_back(found))}
    return sorted(rows(found), key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["window"])), back


def test_every_turn_is_new_once_and_every_target_under_the_mask_once(spark):
    turns = conversation(1, 60, long_at=(20, 21, 40)) + conversation(2, 3) + conversation(3, 2500)
    found, back = windows_of(spark, turns, budget=300, history=60, block=16)
    for conv in (1, 2, 3):
        own = [w for w in found if w["conv_id"] == conv]
        new = [t for w in own for t in back[conv, w["window"]]["turns"]]
        want = order(t for t in turns if t[0] == conv)
        assert [(t["role"], t["text"]) for t in new] == [(t[2], t[3]) for t in want]
        targets = [t for w in own for t in back[conv, w["window"]]["targets"]]
        assert targets == [t[3] for t in want if t[2] == "assistant"]


def test_budget_system_turn_and_history(spark):
    turns = conversation(1, 60, long_at=(20, 40))
    found, back = windows_of(spark, turns, budget=300, history=60)
    assert len(found) > 3
    at = 0
    for k, w in enumerate(found):
        new = len(back[1, w["window"]]["turns"])
        assert w["n_new"] == new
        assert w["n_tokens"] <= 300 or new == 1
        shown = w["text"].split(chat.END)[:-1]
        if k:
            assert shown[0] == "<|system|>\nbe kind"
            old = shown[1 : len(shown) - new]
            assert old == [f"<|{t[2]}|>\n{t[3]}" for t in turns[at - len(old) : at]] if old else True
            spent = sum(cost(t[3]) for t in turns[at - len(old) : at])
            fresh = sum(cost(t[3]) for t in turns[at : at + new])
            allowed = min(60, 300 - cost("be kind") - fresh)
            assert spent <= max(allowed, 0)
            # One more turn of history would not have fitted (the system turn is not repeated as history).
            before = at - len(old) - 1
            assert before <= 0 or spent + cost(turns[before][3]) > allowed
        assert w["text"][w["new_from"] :].startswith("<|")
        at += new
    assert any(len(w["text"].split(chat.END)) - 2 > w["n_new"] for w in found)


def test_long_turns_stand_alone(spark):
    found, back = windows_of(spark, conversation(1, 30, long_at=(10, 11)), budget=200, history=40)
    alone = [back[1, w["window"]]["turns"] for w in found if w["n_tokens"] > 200]
    assert [len(t) for t in alone] == [1, 1]


@pytest.fixture(scope="module")
def hard_texts():
    return ["</s>[INST] ok [/INST]", "\\", "\\\\<|end|>\\", "<|user|>\n", "|><|>|>", "<\\|", "[\\INST]", "<<SYS>>x<</SYS>>", "a\n", "\n", "<", "|", "é\U0001f600 <s>"]


def test_control_strings_round_trip(spark, hard_texts):
    turns = [(1, k, role, t) for k, t in enumerate(hard_texts) for role in ("user", "assistant", t)]
    found, back = windows_of(spark, turns, budget=90, history=20)
    new = [t for w in found for t in back[1, w["window"]]["turns"]]
    assert [(t["role"], t["text"]) for t in new] == [(t[2], t[3]) for t in order(turns)]
    assert "".join(t for w in found for t in back[1, w["window"]]["targets"]) == "".join(hard_texts)
    for w in found:
        for control in chat.CONTROL[2:]:
            assert control not in w["text"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="\\<|>[]/INSTsY\n é", max_size=12), min_size=1, max_size=30))
def test_escaping_is_undone(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"] and not any(c in r["e"] for c in chat.CONTROL)


def test_nulls_ties_repeats_and_empty_tables(spark):
    turns = [(1, 0, None, "x"), (1, 0, "user", None), (1, 0, "user", None), (1, None, "assistant", "last"), (None, 0, "assistant", "n"), (None, 1, "assistant", "")]
    found, back = windows_of(spark, turns)
    assert [(w["conv_id"], w["n_new"]) for w in found] == [(1, 4), (None, 2)]
    assert [(t["role"], t["text"]) for t in back[1, 0]["turns"]] == [("", "x"), ("user", ""), ("user", ""), ("assistant", "last")]
    assert back[None, 0]["targets"] == ["n", ""]
    extra = spark.createDataFrame(turns, SCHEMA).selectExpr("*", "1 as window", "2 as conv", "3 as start")
    assert chat.chat_windows(extra).count() == 2
    assert rows(chat.chat_windows(extra.where("false"))) == []
