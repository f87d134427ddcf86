"""Chat formatting: round trips, layouts found by their fingerprints, digests against plain Python."""

import hashlib
import random

import pytest

from millrace.llm import chat

BITS = [*chat._CONTROL, "\\", "<", "[", "s>", "a", "\n", "/", "é", "漢"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip():
    rng = random.Random(2)
    for _ in range(4000):
        turns = [(rng.choice(["user", "assistant", "system", "tool", "", "[:]"]),
                  "".join(rng.choice(BITS) for _ in range(rng.randint(0, 8)))) for _ in range(rng.randint(0, 4))]
        text = "".join(chat.format_turn(r, t)[0] for r, t in turns)
        assert [(r, t) for r, t, _ in chat.read_turns(text)] == turns
        assert not any(m in chat.escape(t) for _, t in turns for m in chat._CONTROL)


def test_loss_covers_assistant_texts_only():
    for role in ("user", "system", "tool", None):
        assert chat.format_turn(role, "abc")[1:] == (0, 0)
    text, start, end = chat.format_turn("assistant", "a</s>b")
    assert chat.unescape(text[start:end]) == "a</s>b"


def test_fingerprint_ignores_order():
    assert chat.fingerprint(["b", "a"]) == chat.fingerprint(["a", "b"]) != chat.fingerprint(["a"])
    assert chat.mapping_for(["instruction", "output", "input"])[1] == chat.LAYOUTS[frozenset(["instruction", "input", "output"])]
    assert chat.mapping_for(["prompt", "response", "score", "tags[]"])[1] == chat.LAYOUTS[frozenset(["prompt", "response"])]
    assert chat.mapping_for(["nothing"]) == (None, None)


def test_the_layout_stated_first_wins_among_equally_large_ones():
    stated = list(chat.LAYOUTS)
    for a in stated:
        for b in stated:
            if len(a) == len(b) and a != b:
                most = [p for p in stated if p <= a | b and len(p) == max(len(q) for q in stated if q <= a | b)]
                assert chat.mapping_for([*a, *b, "more"])[1] == chat.LAYOUTS[most[0]]
    assert chat.mapping_for(["prompt", "response", "completion"])[1] == chat.LAYOUTS[frozenset(["prompt", "completion"])]


def turns_of(df, key="id"):
    return sorted((r[key], r["turn"], r["role"], r["text"]) for r in df.collect())


@pytest.mark.parametrize("kind, row, want", [
    ("messages array<struct<role: string, content: string>>", ([("human", "q"), ("assistant", None)],),
     [(0, "user", "q"), (1, "assistant", "")]),
    ("conversations array<struct<from: string, value: string>>", ([("human", "q"), ("gpt", "a")],),
     [(0, "user", "q"), (1, "assistant", "a")]),
    ("instruction string, input string, output string", ("do", "", "done"), [(0, "user", "do"), (1, "assistant", "done")]),
    ("instruction string, input string, output string, more int", ("do", "this", None, 1),
     [(0, "user", "do\n\nthis"), (1, "assistant", "")]),
    ("prompt string, completion string", ("p", "c"), [(0, "user", "p"), (1, "assistant", "c")]),
])
def test_layouts_of_columns(spark, kind, row, want):
    df = spark.createDataFrame([(7, *row)], f"id bigint, {kind}")
    assert turns_of(chat.canonical(df, "id")) == [(7, *w) for w in want]


def test_unknown_columns_are_an_error(spark):
    with pytest.raises(ValueError):
        chat.canonical(spark.range(1), "id")


def test_json_records_of_mixed_layouts(spark):
    lines = ['{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}',
             '{"instruction": "do", "output": "done", "score": 3}', '{"question": "q", "answer": null}',
             "[1]", "no json", None, '{"other": 1}', '{"messages": []}']
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(lines)], "id bigint, json string, layout string")
    rows = {}
    for r in chat.canonical_json(df, "id", "json").collect():
        rows.setdefault(r["id"], []).append((r["role"], r["text"]))
        assert (r["layout"] is None) == (r["id"] > 2)
    assert rows[0] == [("user", "q"), ("assistant", "a")] and rows[1] == [("user", "do"), ("assistant", "done")]
    assert rows[2] == [("user", "q"), ("assistant", "")]
    assert all(rows[i] == [(None, lines[i])] for i in range(3, 8))


def given(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_digests(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 40), i, rng.choice(["user", "assistant", "system", "tool"]),
             "".join(rng.choice(BITS) for _ in range(rng.randint(0, 30)))) for i in range(2000)]
    rows += [(99, i, "assistant", "x" * 1000) for i in range(1500)] + [(50, 0, "user", None), (50, None, "assistant", "a"),
                                                                      (None, 1, None, "t"), (51, 3, "user", "same")] * 1
    rows += [(51, 3, "user", "same")]
    want = {}
    for c, t, r, x in sorted(rows, key=lambda q: (q[0] is not None, q[0], q[1] is not None, q[1], q[2] or "", q[3] or "")):
        told = want.setdefault(c, [0, "", ""])
        told[0] += 1
        told[1] += f"{r or ''}\n{x or ''}\n"
        told[2] += (x or "") if r == "assistant" else ""
    turns = chat.formatted_turns(chat.canonical(given(spark, rows), "conv_id"), "conv_id")
    got = {r["conv_id"]: r for r in chat.digests(turns, "conv_id").collect()}
    assert set(got) == set(want)
    for c, (n, told, covered) in want.items():
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (n, sha(told), len(covered), sha(covered))
    for r in chat.conversations(turns, "conv_id").collect():
        assert len(r["text"]) == got[r["conv_id"]]["formatted_chars"]
        assert "".join(chat.unescape(r["text"][s["start"]:s["end"]]) for s in r["loss"]) == want[r["conv_id"]][2]


def test_empty_table(spark):
    turns = chat.formatted_turns(chat.canonical(given(spark, []), "conv_id"), "conv_id")
    assert chat.digests(turns, "conv_id").count() == 0
