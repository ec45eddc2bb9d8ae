"""Callers' columns that are named like internal ones stay as they are."""

import pytest

from riskmart.llm import forest, lines, mixing, quality, url_filter

NAMES = ["__text", "__words", "__doc", "__rank", "__j", "__source", "__hash", "__size", "__d", "__row", "__lost", "__cut", "__h1"]
TEXT = " ".join(f"word{i}" for i in range(30))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"{TEXT} {i}", "s", "http://a.com/", *[f"{n}{i}" for n in NAMES]) for i in (1, 2)]
    return spark.createDataFrame(rows, ["doc_id", "text", "source", "url", *NAMES])


@pytest.mark.parametrize(
    "operator",
    [
        lambda df: quality.judge(df),
        lambda df: quality.keep(df),
        lambda df: lines.dedup_lines(df),
        lambda df: forest.one_of_each(df),
        lambda df: url_filter.judge(df),
        lambda df: mixing.draws(df, mixing.plan(df, shards=2)),
        lambda df: mixing.mixed(df, mixing.plan(df, shards=2)),
    ],
    ids=["judge", "keep", "dedup_lines", "one_of_each", "url", "draws", "mixed"],
)
def test_columns_stay(docs, operator):
    made = operator(docs)
    assert [c for c in made.columns if c in NAMES] == NAMES
    rows = made.collect()
    assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in NAMES)


def test_an_argument_may_name_such_a_column(docs):
    made = quality.judge(docs.drop("text").withColumnRenamed("__text", "text").withColumnRenamed("text", "__text"), "__text")
    assert "__text" in made.columns and made.count() == 2
