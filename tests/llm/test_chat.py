import hashlib
import tracemalloc

import pytest

from pulsemart.llm import chat
from pulsemart.llm.queries import op3_chat_formatting

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
HARD = ["\\### Assistant: </turn> ok", "", "#", "<", "\\", "\\\\h", "</turn>\n### User: x", "a\n\n b", "é😀: x"]


@pytest.mark.parametrize("text", HARD)
def test_markers_in_texts_come_back(text):
    turns = [{"role": "user", "text": text}, {"role": "a: b\\\n#", "text": text}, {"role": "", "text": ""}]
    made = chat.render(turns, chat.marked_turns)
    assert chat.parse(made.text) == turns and not made.rewrites
    for turn, (start, end) in zip(turns, made.contents, strict=True):
        assert chat.unescaped(made.text[start:end]) == turn["text"]
    assert [s for s, _ in made.turns] == [0, *(e for _, e in made.turns[:-1])]


def test_templates_that_rewrite_history():
    def last_only(messages):  # drops the thoughts of all turns but the last
        cut = lambda m, last: m["text"] if last else m["text"].split("|")[-1]
        return "".join(f"[{cut(m, k == len(messages) - 1)}]" for k, m in enumerate(messages))

    turns = [{"role": "assistant", "text": t} for t in ("same", "think|said", "end")]
    made = chat.render(turns, last_only)
    assert made.rewrites and made.text == "[same][said][end]"
    assert made.contents[0] == (1, 5) and made.turns[1] is None and made.turns[2] is None
    closing = chat.render(turns, lambda m: "".join(x["text"] for x in m) + "$")
    assert closing.rewrites


def test_a_frame_that_ends_like_the_text():
    made = chat.render([{"role": "u", "text": ">>"}, {"role": "u", "text": "o"}], lambda ms: "".join(f"<{m['text']}>" for m in ms))
    assert [made.text[a:b] for a, b in made.contents] == [">>", "o"]


def test_long_conversations_hold_two_outputs():
    turns = [{"role": "user", "text": f"{i} " + "w" * 300} for i in range(1500)]
    tracemalloc.start()
    made = chat.render(turns, chat.marked_turns)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert chat.parse(made.text) == turns and not made.rewrites and None not in made.contents
    assert peak < 20 * len(made.text)  # all prefixes would be 750 times the last one


def test_a_later_turn_that_shortens_an_earlier_one():
    cut = lambda ms: "".join(m["text"][: 9 if m is ms[-1] else 1] for m in ms)
    made = chat.render([{"role": "u", "text": t} for t in ("abc", "de", "f")], cut)
    assert made.rewrites and made.text == "adf" and made.turns == [None, None, None]


def test_rows_of_conversations(spark):
    rows = [(1, 1, "assistant", "b", "x"), (1, 0, "user", None, "x"), (None, 0, None, "n", None)]
    rows += [(2, 0, "user", "same", None)] * 2 + [(2, None, "system", "first", None)]
    got = {r["conv_id"]: r for r in chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    texts = {k: [t["text"] for t in chat.parse(r["formatted"])] for k, r in got.items()}
    assert texts == {1: ["", "b"], None: ["n"], 2: ["first", "same", "same"]}
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_against_plain_digests(spark):
    sf_dir = "/root/testdata/sf0.001"
    by = {-7: [(0, "user", HARD[0]), (1, "assistant", HARD[0])]}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        by.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    want = {}
    for conv, turns in by.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        want[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = {r["conv_id"]: tuple(r)[1:5] for r in op3_chat_formatting(spark, sf_dir).collect()}
    assert got == want
