"""Chat formatting: layouts, reversible escapes, digests."""

import hashlib
import json
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from airlake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, segment string, loss string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", None) for r in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    rows = rows + [(-1, t, r, chat.PLANTED) for t, r in enumerate(("user", "assistant"))]
    found = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, f"{r[2] or ''}\n{r[3] or ''}"))
    for conv, _, role, text in order:
        found.setdefault(conv, []).append((role or "", text or ""))
    out = set()
    for conv, turns in found.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        turns_sha = sha("".join(f"{r}\n{t}\n" for r, t in turns))
        out.add((conv, len(turns), turns_sha, len(loss), sha(loss)))
    return out


def digest(spark, rows):
    found = chat.conversation_digest(frame(spark, rows))
    columns = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    rows = found.select(*columns).collect()
    assert len(rows) == len({r[0] for r in rows})
    return set(map(tuple, rows))


NASTY = ["<|im_end|>", "<\\|", "<\\\\|im_start|>", "<", "|", "\\", "\n", "user", "<|im_start|>assistant\n", "é ", "", " "]


def test_equals_the_plain_digest(spark):
    r = random.Random(1)
    rows = [
        (r.choice([None, *range(9)]), t, r.choice(["user", "assistant", "system", "human", "gpt", None, "a\nb", "<|im_end|>\\n"]),
         r.choice([None, "".join(r.choices(NASTY, k=5))]))
        for t in range(300)
    ]
    rows += [(3, None, "user", "no turn"), (4, 1000, "user", "b"), (4, 1000, "user", "a"), (4, 1000, "user", "a")]
    rows += [(5, 1001, "assistant", "long <| " * 200_000)]
    assert digest(spark, rows) == plain(rows)


def test_empty_table_has_the_planted_conversation_only(spark):
    assert digest(spark, []) == plain([])


def test_a_hot_conversation(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(5000)] + [(2, 0, "user", "x")]
    assert digest(spark, rows) == plain(rows)


@given(st.lists(st.tuples(st.text(alphabet="<|\\\nna>im_endé"), st.text(alphabet="<|\\\nna>im_endé")), max_size=5))
def test_templates_are_read_back(turns):
    formatted, loss = chat.format_turns(turns)
    assert list(chat.read_turns(formatted)) == turns and loss == []
    assert formatted.count(chat.START) == formatted.count(chat.END) == len(turns)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), st.text(alphabet="<|\\im_end>é\n")), max_size=6))
def test_the_mask_covers_the_trained_texts(turns):
    formatted, loss = chat.format_turns(turns)
    texts = [chat.unescaped(formatted[s["start"] : s["stop"]]) for s in loss]
    assert texts == [t for r, t in turns if r == "assistant" and t]


LAYOUTS = [
    ({"role": "user", "text": "q"}, [("user", "q")]),
    ({"content": "q", "role": "gpt"}, [("gpt", "q")]),
    ({"messages": [{"role": "system", "content": "s"}, {"content": "a", "role": "assistant"}]}, [("system", "s"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]}, [("user", "q"), ("assistant", "")]),
    ({"dialog": [{"speaker": "human", "text": "q"}]}, [("user", "q")]),
    ({"prompt": "q", "completion": "a"}, [("user", "q"), ("assistant", "a")]),
    ({"system": "s", "prompt": "q", "response": "a"}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"output": "done", "input": "", "instruction": "do"}, [("user", "do"), ("assistant", "done")]),
    ({"question": "q", "answer": 5}, [("user", "q"), ("assistant", "5")]),
    ({"messages": [{"role": "user"}, {"role": "user", "content": "x"}]}, [("user", ""), ("user", "x")]),
]


def test_layouts_become_canonical_turns(spark):
    rows = [(i, 0, json.dumps(r)) for i, (r, _) in enumerate(LAYOUTS)]
    rows += [(100, 0, '{"unknown": 1}'), (101, 0, None), (102, 0, "not json"), (103, 0, "[]"), (104, 0, '{"prompt": {"a": "q"}, "completion": "a"}')]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, record string, place string")
    found = {}
    for r in sorted(chat.canonical_turns(df).collect(), key=lambda r: (r.conv_id, r.place or 0)):
        found.setdefault(r.conv_id, []).append((r.role, r.text))
    assert found == {i: t for i, (_, t) in enumerate(LAYOUTS)} | {i: [(None, None)] for i in range(100, 105)}


def test_fingerprints_follow_paths_not_values_or_order():
    def key(x):
        return chat.fingerprint(chat.field_paths(x))

    assert key({"a": 1, "b": [{"c": "x"}]}) == key({"b": [{"c": None}, {"c": 2}], "a": "y"})
    assert len({key(x) for x in ({"a": 1}, {"a": [1]}, {"a": {"b": 1}}, {"a.b": 1}, {"a": {}}, {"b": 1}, [], 1)}) == 8


def test_a_multi_turn_record_stays_together(spark):
    records = [json.dumps({"messages": [{"role": r, "content": c} for r, c in turns]}) for turns in (
        [("user", "z"), ("assistant", "a")], [("user", "b"), ("assistant", "c")])]
    df = spark.createDataFrame([(1, 0, records[0]), (1, 0, records[1])], "conv_id int, turn int, record string")
    row = chat.read_back(chat.formatted_records(df)).first()
    assert row.turns_sha256 == sha("user\nb\nassistant\nc\nuser\nz\nassistant\na\n") and row.loss_sha256 == sha("ca")


@pytest.mark.parametrize("text", ["x", chat.START + "user\nno end", chat.START + "user"])
def test_what_is_no_template_is_refused(text):
    with pytest.raises(ValueError):
        list(chat.read_turns(text))
