import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm import chat

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("formatted", T.StringType()), T.StructField("n_turns", T.StringType())])
PARTS = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<turn:x>", "<turn:", "</turn>", "\\", "[\\INST]", "<\\\\/s>", "</\\s>", " ", "\n", "ok", "é\U0001f600", "<", "[", "/", "INST]", "s>", "$1", "\x00"]


def conversations():
    rng = random.Random(3)
    rows = []
    for conv in range(150):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", "system", "tool", None, "", "a b>c", "user ", "turn:user"])
            rows.append((conv, turn, role, rng.choice([None, "".join(rng.choices(PARTS, k=rng.randint(0, 8)))])))
    rows += [(500, 0, "user", "x" * 400_000 + "[/INST]"), (500, 1, "assistant", "</s>[INST] ok [/INST]" * 3000)]
    rows += [(None, None, "user", "a"), (None, None, "user", "a"), (None, 1, "assistant", "b"), (501, 1, "user", "later"), (501, None, "assistant", "first")]
    return rows


def ordered(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in found.items()}


def test_every_conversation_reads_back(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    chats = chat.format_chats(df)
    assert chats.columns == ["conv_id", "n_turns", "formatted", "loss_spans", "n_escaped", "round_trip"]
    got = chats.withColumn("turns", chat.parse(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()
    want = ordered(rows)
    assert {r.conv_id for r in got} == set(want) and len(got) == len(want)
    for r in got:
        turns = want[r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == turns and r.n_turns == len(turns) and r.round_trip
        assert r.loss == "".join(t for role, t in turns if role == "assistant")
        raw = r.formatted.encode()
        learnt = [raw[s.start : s.start + s.bytes].decode() for s in r.loss_spans]
        assert len(learnt) == sum(role == "assistant" for role, _ in turns)
        for text in learnt:
            assert not any(mark in text for pair in (*chat.MARKS.values(), chat.OTHER) for mark in pair)


def test_plain_texts_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, 0, "user", "a < b [c] \\ /s>", "x", "y"), (1, 1, "assistant", "fine", "x", "y")], SCHEMA)
    row = chat.format_chats(df).first()
    assert row.formatted == "[INST] a < b [c] \\ /s> [/INST]\n<s> fine </s>\n" and row.n_escaped == 0


@pytest.mark.parametrize("text", ["[INST] a", "[INST] a [/INST]\nrest", "[INST] a </s>\n", "a[INST] b [/INST]\n", "<s> a[INST]  </s>\n", "<turn:user> a </turn>\n", "[INST]  [/INST]"])
def test_what_does_not_fit_the_grammar(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(chat.parse(F.col("t")).alias("p")).first().p is None


def test_empty(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).collect() == []
    row = chat.format_chats(spark.createDataFrame([(None,) * 6], SCHEMA)).first()
    assert (row.conv_id, row.n_turns, row.formatted) == (None, 1, "<turn:>  </turn>\n")
