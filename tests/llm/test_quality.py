import random
import re
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm import quality
from tests.llm.test_pipeline import fine

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("KEPT", T.StringType())])
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len({i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}),
    )


def texts():
    rng = random.Random(8)
    out = [None, "", " \n\t ", "one", "a b c d e", "a b c d e a b c d e", "x " * 9, "same line\nsame line\n same line", "\U0001f600 é# $% <|>", "a\x0bb\x0cc\rd\x85e\xa0f"]
    for _ in range(300):
        words = rng.choices(["a", "bb", "c#", "é", "dd\n", "\n", "e", "line of words\n"], k=rng.randint(0, 60))
        out.append(" ".join(words))
    block = " ".join(f"w{i}" for i in range(30))
    return out + [block, block + " " + block, (block + "\n") * 3000, "z" * 300_000, " ".join(str(i) for i in range(60_000)) + " 0 1 2 3 4"]


def test_measures_and_verdicts(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts())] + [(None, "null id", "x", "y")] * 2
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = quality.judge(df, order=quality.RULES).collect()
    assert got[0].__fields__ == ["doc_id", "text", *quality.MEASURES, "base_failed", "rejected_by", "kept"] and len(got) == len(rows)
    for r in got:
        assert tuple(r[m] for m in quality.MEASURES) == measured(r.text), r.text
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == fine(r.text) == (r.rejected_by is None)
    kept = quality.keep(df).collect()
    assert kept[0].__fields__ == SCHEMA.names
    assert sorted((r.doc_id, r.text) for r in kept) == sorted((r.doc_id, r.text) for r in got if r.kept)


def test_order_changes_no_verdict(spark):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts()[:120])], SCHEMA)
    verdicts = {tuple(r.kept for r in quality.judge(df, order=order).sort("doc_id").collect()) for order in (quality.RULES, quality.RULES[::-1])}
    assert len(verdicts) == 1


def test_estimates_order_by_gain(spark):
    df = spark.createDataFrame([(i, "#" if i % 2 else "plain words " * 20, "x", "y") for i in range(400)], SCHEMA)
    found = quality.estimate(df)
    assert {e.rule for e in found} == set(quality.RULES)
    assert [e.gain for e in found] == sorted((e.gain for e in found), reverse=True)
    assert {e.rule.name: e.rejects for e in found}["few_words"] == 0.5
    assert all(e.rejects == 0 for e in quality.estimate(df.limit(0)))
    assert quality.judge(df.limit(0)).collect() == [] and quality.keep(df.limit(0)).collect() == []


def test_a_rule_that_is_not_reached_is_not_evaluated(spark):
    boom = quality.Rule("boom", ("n_words",), lambda n: F.raise_error(F.lit("reached")).isNull())
    df = spark.createDataFrame([(1, "too few", "x", "y")], SCHEMA)
    assert quality.keep(df, order=[quality.RULES[0], boom]).collect() == []
