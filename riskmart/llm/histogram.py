"""Exact length histogram: token totals, quantiles and truncated totals for every context limit."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import text_of
from riskmart.session import cut_lineage

TOKENIZER = "byte_bpe_50k.tiktoken"
#: Lengths that one task of the suffix sums takes.
SPAN = 4096


@lru_cache(maxsize=2)
def _encoder(name: str) -> Callable[[str], int]:
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def token_count(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """Tokens of a text under a byte-level BPE of `public_tokenizers`; null counts as empty."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        encode = _encoder(tokenizer)
        return pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return count(F.coalesce(text.cast("string"), F.lit("")))


def encoded_lengths(df: DataFrame, text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """One row (length) for each document, counted inside the scan: texts are not shuffled."""
    return df.select(token_count(text_of(text), tokenizer).alias("length"))


def _counted(lengths: DataFrame, column: str) -> DataFrame:
    """Documents of each length, stored: what follows reads it twice, and the texts are encoded once."""
    length = F.coalesce(F.col(column).cast("long"), F.lit(0)).alias("length")
    return cut_lineage(lengths.groupBy(length).agg(F.count(F.lit(1)).alias("n_docs")), "lengths")


def histogram(lengths: DataFrame, column: str = "length") -> DataFrame:
    """One row for each different length, with what a context of that many tokens would hold.

    length, n_docs; tokens: of documents of this length; docs_at_least, tokens_at_least: suffix
    sums over documents of this length or longer; total_docs, total_tokens; truncated_tokens:
    the corpus with every document cut to `length`; fits: share of documents of at most `length`
    tokens, so the quantile q is the least length with fits >= q.

    The count per length combines before the shuffle, so a length that a third of all documents
    share costs one row a task. Suffix sums go in two steps, inside spans of SPAN lengths and over
    the spans, so no task holds the whole histogram. A null length counts as 0; an empty table
    gives no rows.
    """
    counted = _counted(lengths, column).withColumn("tokens", F.col("length") * F.col("n_docs"))
    counted = counted.withColumn("span", F.floor(F.col("length") / SPAN))
    spans = counted.groupBy("span").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    # One row for each span of lengths: the longest document's length / SPAN at most.
    later = Window.orderBy(F.col("span").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spans = spans.select(
        "span",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_later"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_later"),
        F.sum("d").over(every).alias("total_docs"),
        F.sum("t").over(every).alias("total_tokens"),
    )
    inside = Window.partitionBy("span").orderBy(F.col("length").desc())
    sums = counted.join(spans, "span").select(
        "length",
        "n_docs",
        "tokens",
        (F.sum("n_docs").over(inside) + F.col("docs_later")).alias("docs_at_least"),
        (F.sum("tokens").over(inside) + F.col("tokens_later")).alias("tokens_at_least"),
        "total_docs",
        "total_tokens",
    )
    truncated = F.col("total_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")
    fits = (F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("total_docs")
    return sums.withColumn("truncated_tokens", truncated).withColumn("fits", fits)


def at_limits(hist: DataFrame, limits: DataFrame, column: str = "context") -> DataFrame:
    """Documents and tokens under any context limits, one row a limit, from the histogram alone.

    Limits need not occur as lengths. A join on a range over two small tables would pair them
    all; instead both are ordered together and each limit takes the last length before it.
    """
    asked = limits.select(F.col(column).cast("long").alias("length"), F.lit(True).alias("asked"))
    rows = hist.select("length", F.lit(False).alias("asked"), "docs_at_least", "tokens_at_least", "n_docs", "tokens", "total_docs", "total_tokens")
    # At most one row for each length and limit.
    before = Window.orderBy("length", "asked").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = rows.unionByName(asked, allowMissingColumns=True).select(
        "length",
        "asked",
        F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("fit_docs"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("fit_tokens"),
        F.max("total_docs").over(every).alias("total_docs"),
        F.max("total_tokens").over(every).alias("total_tokens"),
    )
    kept = F.col("fit_tokens") + F.col("length") * (F.col("total_docs") - F.col("fit_docs"))
    return seen.filter("asked").select(F.col("length").alias(column), "fit_docs", kept.alias("truncated_tokens"), "total_tokens")


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """The least length that at least each share of the documents fits into, in one pass."""
    least = [F.min(F.when(F.col("fits") >= q, F.col("length"))).alias(str(i)) for i, q in enumerate(shares)]
    pairs = F.array(*[F.struct(F.lit(q).alias("share"), F.col(str(i)).alias("length")) for i, q in enumerate(shares)])
    return hist.agg(*least).select(F.inline(pairs))
