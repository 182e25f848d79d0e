"""Chat formatting: layouts by fingerprint, exact round trips, loss masks."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd_rows import clashing
from tessera.llm import chat

TURNS = [("user", "hi </s>[INST]"), ("assistant", "a \\ <|end|> b")]
RECORDS = [
    ({"messages": [{"role": r, "content": t} for r, t in TURNS]}, "messages", TURNS),
    ({"id": 5, "messages": [{"content": [{"type": "text", "text": t}], "role": r} for r, t in TURNS]}, "message parts", TURNS),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "from and value", [("user", "q"), ("assistant", "a")]),
    ({"turns": [{"turn": 2, "role": "x", "text": "b"}, {"turn": 1, "role": None, "text": None}]}, "numbered turns", [("", ""), ("x", "b")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"system": "s", "instruction": "do", "output": "done"}, "instruction", [("system", "s"), ("user", "do"), ("assistant", "done")]),
    ({"prompt": "p", "response": "r"}, "prompt and response", [("user", "p"), ("assistant", "r")]),
    ({"prompt": "p", "completion": "c"}, "prompt and completion", [("user", "p"), ("assistant", "c")]),
    ({"question": "q", "answer": 4}, "question and answer", [("user", "q"), ("assistant", "4")]),
    ({"messages": []}, "messages", []),
    ({"messages": "no list", "other": 1}, None, None), ({}, None, None), ([1, 2], None, None), (None, None, None),
]


def test_layouts(spark):
    rows = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(RECORDS)] + [(97, None), (98, ""), (99, "{broken")]
    out = chat.format_chat(clashing(spark.createDataFrame(rows, "id long, record string"), "chat_turns", "paths"), prefix="chat_")
    got = {r["id"]: r for r in out.collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        r = got[i]
        assert r["chat_layout"] == layout
        assert (None if r["chat_turns"] is None else [tuple(t) for t in r["chat_turns"]]) == turns
        if turns is not None:
            assert chat.read_back(r["chat_formatted"]) == turns
            raw = r["chat_formatted"].encode()
            learned = [chat.unescape(raw[s["start"]:s["end"]].decode()) for s in r["chat_loss_spans"]]
            assert learned == [t for role, t in turns if role == "assistant"]
    assert all(got[i]["chat_layout"] is None and got[i]["paths"] == "own paths" for i in (97, 98, 99))


def test_a_list_item_with_an_unknown_path_changes_the_fingerprint():
    a = {"messages": [{"role": "user", "content": "x"}]}
    b = {"messages": [{"role": "user", "content": "x"}, {"role": "user", "content": "x", "weight": 1}]}
    assert chat.fingerprint(chat.paths(a)) in chat.fingerprints() and chat.fingerprint(chat.paths(b)) not in chat.fingerprints()
    assert chat.paths({"a.b": 1}) != chat.paths({"a": {"b": 1}})


def test_layouts_with_the_same_paths_are_refused():
    with pytest.raises(ValueError):
        chat.fingerprints([chat.Layout("x", fields=(("user", "a"),)), chat.Layout("y", items="a", optional=()),
                           chat.Layout("z", items="q"), chat.Layout("w", fields=(("user", "q"),))])


pieces = st.lists(st.one_of(st.sampled_from([*chat.CONTROL, "\\", "<", "[", "|", ">", "\n", "/", "end"]), st.text(max_size=4)), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(pieces, pieces), max_size=5))
def test_round_trip(turns):
    s, spans = chat.formatted(turns)
    assert chat.read_back(s) == turns
    assert len(spans) == sum(r == "assistant" for r, _ in turns)


@given(pieces)
@settings(max_examples=300, deadline=None)
def test_escaped_texts_hold_no_control_string(s):
    assert not any(c in chat.escape(s) for c in chat.CONTROL) and chat.unescape(chat.escape(s)) == s


def test_conversation_rows(spark, tmp_path):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (2, 0, "system", "s"), (2, 1, "user", "u"), (2, 2, "assistant", "x"),
            (3, 1, "tool", "t"), (3, 0, None, "n"), (4, 0, "user", "only"), (5, 0, "user", "tie b"), (5, 0, "user", "tie a"),
            (5, None, "assistant", "first"), (None, 0, "user", "no id"), (6, 0, "user", "long " * 50_000), (6, 1, "assistant", "y"),
            (7, 0, "system", "s"), (7, 1, "assistant", "\\<|end|>"), (8, 0, "human", "other role")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chat(chat.conversation_records(df)).collect()
    got = {r["conv_id"]: [tuple(t) for t in r["chat_turns"]] for r in out}
    want = {}
    for c, _, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert got == want and len({r["chat_layout"] for r in out}) >= 4
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    query = {r["conv_id"]: r for r in chat.op1_chat_fingerprints(spark, str(tmp_path)).collect()}
    assert set(query) == set(want) | {-7} and query[-7]["n_turns"] == 2 and query[-7]["loss_chars"] == len(chat.PROBE)
    assert chat.conversation_records(df.limit(0)).count() == 0
