"""Chat formatting against plain Python."""

import re

import pytest
from brute import sha

from tillroll.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, example string, formatted int"
NASTY = ["[INST]", "[/INST]", "<s>", "</s>", "[\\INST]", "[\\\\/INST] \\", "<\\s>", "[[INST]", "<</s>", "a\\nb\nc", "", None, "\\", "[INST", "/INST]",
         "ends with [", "é😀 x", "x" * 50_000]


def esc(t):
    return re.sub(r"([\[<])(\\*)(/?(?:INST\]|s>))", lambda m: m[1] + "\\" + m[2] + m[3], t)


def expected(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        pieces = []
        for has, n, role, text in turns:
            r = esc(role.replace("\\", "\\\\").replace("\n", "\\n"))
            pieces.append((has, n, f"<s>{esc(text)}</s>" if role == "assistant" else f"[INST]{r}\n{esc(text)}[/INST]", role, text))
        pieces.sort(key=lambda p: p[:3])
        replies = [p[4] for p in pieces if p[3] == "assistant"]
        chars = sum(sum(len(p[2]) for p in pieces[:k + 1]) for k, p in enumerate(pieces) if p[3] == "assistant" or k == len(pieces) - 1)
        out[c] = (len(pieces), sha("".join(f"{p[3]}\n{p[4]}\n" for p in pieces)), len("".join(replies)), sha("".join(replies)), chars)
    return out


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)


def test_round_trip_of_awkward_conversations(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(NASTY)]
    rows += [(2, k, "user", t) for k, t in enumerate(NASTY)]  # no reply at all
    rows += [(3, 0, "assistant", "only"), (4, 0, "ro\nle\\n[INST]", "t"), (4, 1, "assistant", "</s>"), (4, 2, None, "after"),
             (5, 0, "user", "same"), (5, 0, "user", "same"), (5, None, "system", "first"), (None, 0, "user", "x"), (None, 1, "assistant", "y")]
    got = chat.digest(chat.format_conversations(conversations(spark, rows))).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == expected(rows)


def test_each_reply_is_one_example_with_all_before_it(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "user", "v"), (1, 4, "assistant", "b</s>"), (1, 5, "user", "w")]
    got = chat.format_conversations(conversations(spark, rows)).orderBy("example").collect()
    assert [r["trainable"] for r in got] == [True, True, False]
    assert [r["is_last"] for r in got] == [False, False, True]
    for short, long in zip(got, got[1:]):
        assert long["formatted"].startswith(short["formatted"])
    masked = [r["formatted"][r["mask_start"]:r["mask_start"] + r["mask_length"]] for r in got]
    assert masked == ["a", "b<\\/s>", ""]


def test_empty_table(spark):
    none = conversations(spark, [(1, 0, "user", "x")]).filter("false")
    assert chat.digest(chat.format_conversations(none)).count() == 0


@pytest.mark.parametrize("text", [t for t in NASTY if t])
def test_no_control_string_survives_escaping(text):
    assert not any(c in esc(text) for c in ("[INST]", "[/INST]", "<s>", "</s>"))
