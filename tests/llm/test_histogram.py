import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import types as T

from riskmart.llm import histogram
from riskmart.llm.queries import QUERIES

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("length", T.StringType())])


def brute(lengths):
    total, n = sum(lengths), len(lengths)
    rows = []
    for x in sorted(set(lengths)):
        same, longer = lengths.count(x), [y for y in lengths if y >= x]
        rows.append((x, same, x * same, len(longer), sum(longer), n, total, sum(min(y, x) for y in lengths), pytest.approx(sum(y <= x for y in lengths) / n)))
    return rows


COLUMNS = ["length", "n_docs", "tokens", "docs_at_least", "tokens_at_least", "total_docs", "total_tokens", "truncated_tokens", "fits"]


def test_suffix_sums(spark):
    rng = random.Random(1)
    lengths = [rng.choice([0, 7, 7, 7, rng.randrange(40), rng.randrange(30_000)]) for _ in range(600)] + [histogram.SPAN - 1, histogram.SPAN]
    hist = histogram.histogram(spark.createDataFrame([(x,) for x in lengths], "length long").repartition(5)).persist()
    assert hist.columns == COLUMNS
    assert [tuple(r) for r in hist.sort("length").collect()] == brute(lengths)
    limits = [0, 1, 7, 8, 4096, 10**9, 7]
    got = histogram.at_limits(hist, spark.createDataFrame([(x,) for x in limits], "context int")).collect()
    assert sorted((r.context, r.fit_docs, r.truncated_tokens) for r in got) == sorted((x, sum(y <= x for y in lengths), sum(min(y, x) for y in lengths)) for x in limits)
    shares = [0.0001, 0.25, 0.5, 0.9, 1.0]
    ranked = sorted(lengths)
    got = {r.share: r.length for r in histogram.quantiles(hist, shares).collect()}
    assert got == {q: next(x for i, x in enumerate(ranked) if (sum(y <= x for y in ranked)) >= q * len(ranked) - 1e-9) for q in shares}


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "some words", "x"), (3, "some words", "x"), (3, "some words", "x"), (4, "<|endoftext|>", "x"), (5, "long text, " * 60_000, "x")]
    got = sorted(r.length for r in histogram.encoded_lengths(spark.createDataFrame(rows, SCHEMA)).collect())
    encode = histogram._encoder(histogram.TOKENIZER)
    assert got == sorted(len(encode(t or "")) for _, t, _ in rows) and got[:2] == [0, 0]
    empty = spark.createDataFrame([], SCHEMA)
    assert histogram.histogram(histogram.encoded_lengths(empty)).collect() == []
    assert histogram.histogram(spark.createDataFrame([(None,)], "length long")).first().tokens == 0


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    encode = histogram._encoder(histogram.TOKENIZER)
    assert isinstance(tiktoken.__version__, str) and public_tokenizers.path(histogram.TOKENIZER)
    lengths = [len(encode(r.text or "")) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert [tuple(r) for r in QUERIES["op10_length_histogram"](spark, sf).sort("length").collect()] == brute(lengths)
