"""Chat formatting: fingerprints, reversible escapes, loss masks."""

from __future__ import annotations

import hashlib
import json

from hypothesis import given
from hypothesis import strategies as st

from tests.llm.conftest import by_id
from tillwatch.llm import chat
from tillwatch.llm.queries import CONTROL_TEXT, QUERIES

NASTY = [r"\### Assistant: </turn> ok", "###", "####", "\\", "\\\\###", "</turn", " </turn>\n### User: ", "", "\n", "</</turn>"]


def digests(turns):
    loss = "".join(text for role, text in turns if role == "assistant")
    said = "".join(f"{role}\n{text}\n" for role, text in turns)
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def as_turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def outcome(df):
    return {
        r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
        for r in chat.read_back(chat.format_turns(df)).collect()
    }


@given(st.lists(st.text(alphabet="\\#</turn> x\n:A", max_size=30), min_size=1, max_size=5), st.text(max_size=8))
def test_any_text_and_role_come_back(texts, role):
    formatted = "".join(chat.format_turn(r, t)[0] for t in texts for r in ("assistant", role))
    back = [(r, t) for r, t, _, _ in chat.parse_formatted(formatted)]
    assert back == [(r, t) for t in texts for r in ("assistant", role)]


def test_nasty_texts(spark):
    rows = [(1, i, ("user", "assistant", "system", "Assistant", "x: y")[i % 5], t) for i, t in enumerate(NASTY * 2)]
    assert outcome(as_turns(spark, rows)) == {1: digests([(r, t) for _, _, r, t in rows])}


def test_rows_of_every_kind(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "user", None), (2, 1, None, "x"), (2, None, "system", "s"),
        (None, 0, "user", "u"), (3, 0, "assistant", "t"), (3, 0, "assistant", "t"), (4, 0, "assistant", "l" * 500_000),
        (5, 0, "user", "z"), (5, 0, "assistant", "z"),
    ]
    got = outcome(as_turns(spark, rows))
    assert got[1] == digests([("user", "a"), ("assistant", "b")])
    assert got[2] == digests([("system", "s"), ("user", ""), ("", "x")])
    assert got[None] == digests([("user", "u")])
    assert got[3] == digests([("assistant", "t")] * 2)
    assert got[4] == digests([("assistant", "l" * 500_000)])
    assert got[5] == digests([("assistant", "z"), ("user", "z")])
    assert outcome(as_turns(spark, []).limit(0)) == {}


def test_a_long_conversation_is_streamed(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"text {i}") for i in range(25_000)]
    assert outcome(as_turns(spark, rows)) == {7: digests([(r, t) for _, _, r, t in rows])}


def test_layouts(spark):
    records = [
        {"conv_id": 1, "turn": 0, "role": "user", "text": "a"},
        {"conv_id": 1, "turn": 1, "role": "assistant"},
        {"conv_id": 2, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "r"}]},
        {"id": 3, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]},
        {"conv_id": 4, "prompt": "p", "response": "r"},
        {"conv_id": 5, "instruction": "i", "input": "n", "output": "o"},
        {"conv_id": 6, "instruction": "i", "output": "o"},
        {"conv_id": 7, "question": "?"},
    ]
    lines = [(json.dumps(r), "clash") for r in records] + [("[1]", ""), ("{broken", ""), (None, "")]
    df = spark.createDataFrame(lines, "record string, text string")
    turns = chat.canonical_turns(df)
    got = sorted((r["conv_id"], r["turn"], r["role"], r["text"]) for r in turns.where("layout IS NOT NULL").collect())
    assert got == [
        (1, 0, "user", "a"), (1, 1, "assistant", ""),
        (2, 0, "user", "q"), (2, 1, "assistant", "r"),
        (3, 0, "user", "q"), (3, 1, "assistant", "r"),
        (4, 0, "user", "p"), (4, 1, "assistant", "r"),
        (5, 0, "system", "i"), (5, 1, "user", "n"), (5, 2, "assistant", "o"),
        (6, 0, "system", "i"), (6, 2, "assistant", "o"),
    ]
    assert sorted(r["n"] for r in chat.unmapped(turns).collect()) == [1, 3]


def test_registered_query(spark, sf_dir):
    convs = {-7: [(0, "user", CONTROL_TEXT), (1, "assistant", CONTROL_TEXT)]}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        convs.setdefault(r["conv_id"], []).append((r["turn"], r["role"] or "", r["text"] or ""))
    got = by_id(QUERIES["op7_chat_formatting"](spark, sf_dir), "conv_id")
    assert set(got) == set(convs)
    for key, turns in convs.items():
        r = got[key]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == digests(
            [t[1:] for t in sorted(turns)]
        )


def test_ids_of_any_kind(spark):
    said = [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]
    ids = ["identity_0", 10**30, 1.5, 2.0, 7, None, True]
    frame = spark.createDataFrame([(json.dumps({"id": i, "conversations": said}),) for i in ids], "record string")
    asked = [r for r in chat.canonical_turns(frame, id_type="string").collect() if r["layout"]]
    texts = [i if isinstance(i, str) else None if i is None else json.dumps(i) for i in ids]
    assert sorted(((r["conv_id"], r["turn"]) for r in asked), key=repr) == sorted(((t, n) for t in texts for n in (0, 1)), key=repr)
    whole = chat.canonical_turns(frame).collect()
    assert sorted((r["conv_id"] for r in whole if r["layout"]), key=repr) == [2, 2, 7, 7, None, None]
    assert sum(r["layout"] is None and r["fingerprint"] is not None for r in whole) == 4
    odd = json.dumps({"conv_id": 1, "turn": "first", "role": "user", "text": "a"})
    assert [r["turn"] for r in chat.canonical_turns(spark.createDataFrame([(odd,)], "record string")).collect()] == [None]
