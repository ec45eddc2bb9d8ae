"""What several operators of the subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters between words; everything else belongs to a word.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def others(df: DataFrame, made: Iterable[str]) -> list[Column]:
    """The columns of `df` that an operator passes on: all but those it makes itself."""
    taken = {c.lower() for c in made}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]


def text_of(column: str) -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once a row, for use inside lambdas."""
    return F.transform(F.array(value), body)[0]


def tidy(task):
    """A function of a task's batches that, at its end, gives back what Arrow and the C library hold but do not use.

    Workers live on when their task is over, and what they keep counts against later stages.
    """

    @wraps(task)
    def run(batches: Iterator) -> Iterator:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return run


def keeps_names(operator):
    """An operator whose internal columns begin with two underscores, made safe for callers' columns that do so too.

    Such columns are renamed before the operator sees them, and back afterwards; other tables pass unchanged.
    """

    @wraps(operator)
    def run(df: DataFrame, *args, **options):
        taken = [c for c in df.columns if c.startswith("__")]
        if not taken:
            return operator(df, *args, **options)
        prefix = "own"
        while any(c.lower().startswith(prefix) for c in df.columns):
            prefix += "_"
        aside = {c: f"{prefix}{i}" for i, c in enumerate(taken)}
        renamed = df.select(*[F.col(f"`{c}`").alias(aside.get(c, c)) for c in df.columns])
        named = lambda x: aside.get(x, x) if isinstance(x, str) else x
        made = operator(renamed, *map(named, args), **{k: named(v) for k, v in options.items()})
        back = {new: c for c, new in aside.items()}
        return made.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in made.columns])

    return run
