"""Chat formatting: exact round trip and spans, against plain Python."""

import hashlib

import pytest

from vitalspark.llm import chat
from vitalspark.session import work_path

ROWS = [
    (1, 0, "system", "be </s> good"), (1, 1, "user", "a\\[INST] b"), (1, 2, "assistant", "ré \\\\</s>\n<s>x"),
    (1, 3, "user", None), (1, 4, "assistant", "two"), (1, 5, "assistant", ""),
    (2, 0, "user", "alone"), (3, 0, None, "no role"), (3, 1, "a\\n\\b\nc", "odd role\\"),
    (None, 0, "assistant", "no id"), (4, None, "user", "no turn"), (4, 1, "assistant", "x"), (4, 1, "assistant", "x"),
    (5, 0, "user", "</s>[INST] ok [/INST]"), (5, 1, "assistant", "</s>[INST] ok [/INST]"),
] + [(6, t, "user" if t % 2 == 0 else "assistant", f"turn {t} </s>") for t in range(1200)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", "'x' AS segment", "1 AS tie", "2L AS offset").repartition(7)


@pytest.fixture(scope="module")
def written(spark):
    path = work_path(spark, "chat-test")
    chat.write_chat(frame(spark, ROWS), path)
    return path


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_digests(spark, written):
    got = {r.conv_id: r for r in chat.digests(written, spark).collect()}
    assert set(got) == {r[0] for r in ROWS}
    for conv, r in got.items():
        turns = sorted([x for x in ROWS if x[0] == conv], key=lambda x: (x[1] is not None, x[1] or 0))
        loss = "".join(t or "" for _, _, role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == sha("".join(f"{role or ''}\n{t or ''}\n" for _, _, role, t in turns)), conv
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss)), conv


def test_examples_hold_all_preceding_turns(spark, written):
    convs = chat.conversations(spark.read.parquet(f"{written}/segments"))
    text = {r.conv_id: r.formatted for r in convs.collect()}
    exs = spark.read.parquet(f"{written}/examples")
    out = chat.expand_examples(convs, exs.where("conv_id = 6 OR conv_id = 1")).collect()
    assert len(out) == 600 + 3
    for r in out:
        assert text[r.conv_id].startswith(r.context)
        assert r.context.count("</s>\n") - r.context.count("\\</s>\n") >= 1
    six = sorted((r for r in out if r.conv_id == 6), key=lambda r: r.example_no)
    for k, r in enumerate(six):
        want = "".join(f"<s>{role}\nturn {t} \\</s>\n</s>\n" for _, t, role, _ in ROWS[-1200:][: 2 * k + 1])
        assert r.example_no == k and r.context == want and r.target == f"turn {2 * k + 1} \\</s>"


def test_empty(spark):
    path = work_path(spark, "chat-empty")
    chat.write_chat(frame(spark, ROWS).where("false"), path)
    assert chat.digests(path, spark).count() == 0


def test_a_very_long_turn(spark):
    text, path = "</s>[INST] " * 100_000, work_path(spark, "chat-long")
    chat.write_chat(frame(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", text)]), path)
    r = chat.digests(path, spark).first()
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(text), sha(text))
