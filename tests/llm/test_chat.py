import hashlib

import pytest
from pyspark.sql import functions as F

from llm import chat

TRICKY = [
    "\\### Assistant: </turn> ok", "</turn>\n### User: ", "ends with \\", "\\\\", "\\e\\m\\\\e", "</tu</turn>rn>", "", None, "a\nb\r\n", "### ### ",
    "x" * 200_000, "</turn", ">", "日本 \\",
]


@pytest.fixture
def conversations(spark):
    def make(rows):
        return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")

    return make


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_texts_and_roles_survive_the_round_trip(conversations):
    roles = ["user", "assistant", "tool", "", None, "### User", "Assistant", "rôle: </turn>"]
    rows = [(i, n, r, t) for i, r in enumerate(roles) for n, t in enumerate(TRICKY)]
    out = chat.formatted(conversations(rows))
    for row in out.withColumn("turns", chat.parsed(F.col("formatted"))).collect():
        assert [(t.role, t.text) for t in row.turns] == [(roles[row.conv_id] or "", t or "") for t in TRICKY]
        assert "".join(s.text for s in row.segments) == row.formatted
        assert all(s.loss is False for s in row.segments) == (roles[row.conv_id] != "assistant")
        assert row.formatted.count("</turn>\n") == len(TRICKY)


def test_digests(conversations):
    rows = [(1, 1, "assistant", "two"), (1, 0, "user", "one\\"), (1, 2, "user", None), (1, 3, "assistant", "</turn>\\"), (2, 0, "user", "q")]
    one, two = chat.digests(chat.formatted(conversations(rows))).orderBy("conv_id").collect()
    assert one.turns_sha256 == sha("user\none\\\nassistant\ntwo\nuser\n\nassistant\n</turn>\\\n")
    assert (one.n_turns, one.loss_chars, one.loss_sha256, one.valid) == (4, 11, sha("two</turn>\\"), True)
    assert (two.n_turns, two.loss_chars, two.loss_sha256, two.valid) == (1, 0, sha(""), False)


@pytest.mark.parametrize(
    "roles, valid",
    [("su a", True), ("ua", True), ("uaua", True), ("a", False), ("uu a", False), ("sa", False), ("us a", False), ("uax", False), ("s", False), ("uau", False)],
)
def test_turn_order(conversations, roles, valid):
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    rows = [(1, i, names[r], "t") for i, r in enumerate(roles.replace(" ", ""))]
    assert chat.formatted(conversations(rows)).first().valid is valid


def test_ties_repeats_and_nothing(conversations):
    rows = [(None, None, "user", "b"), (None, None, "user", "a"), (None, None, "user", "a"), (None, 0, "assistant", "c")]
    frame = conversations(rows).withColumn("turns", F.lit(1)).withColumn("segments", F.lit(2))
    (row,) = chat.digests(chat.formatted(frame)).collect()
    assert (row.conv_id, row.n_turns) == (None, 4)
    assert row.turns_sha256 == sha("user\na\nuser\na\nuser\nb\nassistant\nc\n")
    assert chat.digests(chat.formatted(conversations([]))).count() == 0


def test_another_template(conversations):
    template = chat.Template(headers={"user": "<|u|>", "assistant": "<|a|>"}, other="<|o|>", mark="<|", end="<|end|>", loss_roles=("user",))
    out = chat.formatted(conversations([(1, 0, "user", "<|a|>x"), (1, 1, "assistant", "<|end|>")]), template)
    row = out.withColumn("turns", chat.parsed(F.col("formatted"), template)).withColumn("loss", chat.loss_text(F.col("segments"), template)).first()
    assert [tuple(t) for t in row.turns] == [("user", "<|a|>x"), ("assistant", "<|end|>")] and row.loss == "<|a|>x"
