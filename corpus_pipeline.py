"""A training corpus from `documents`: quality rules, line dedup, near-copy join, mixing, token ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import bpe, forest, lines, mixing, quality
from riskmart.llm.common import WORD
from riskmart.session import cut_lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects.

    A null or empty text has no words and goes; repeated rows stay or go together; a null in another column changes
    nothing; columns beyond those of documents stay, whatever their names; an empty table stays empty.
    """
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand elsewhere; those left without a word go. n_chars is counted anew.

    A null text has no word and goes. Rows of equal or null ids are documents of their own; rows equal in id and text
    keep the same lines, and the next stage keeps one of them. Columns named n_lines or n_removed go, others stay.
    """
    cut = lines.dedup_lines(docs).filter(F.col("text").rlike(WORD))
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies.

    The least id stays, in classes of nulls one of them; of rows equal in id and text one stays, by a hash of all columns.
    Texts of fewer than five words are alike only if they are equal. Other columns stay as they are.
    """
    return forest.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, in the mix's order.

    Null sources are a source of their own, null texts have no words; rows equal in id, source and text are drawn together.
    An empty table gives an empty mix.
    """
    return mixing.mixed(docs, mixing.plan(docs)).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, 4 bytes each, and how many. A null or empty text has none; repeated rows are encoded alike."""
    return bpe.encode(docs).select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-copy join", near_copies),
    ("mixing", mix_sources),
    ("token ids", token_ids),
]
#: SQL has neither the hashes of the mix nor the tokenizer; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's result is stored in the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
