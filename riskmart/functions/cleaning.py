"""Cleaning of dirty columns. Every function maps Columns to a Column and stays in codegen.

ANSI mode is on, so a bad value must be asked for as null: `try_cast`, `try_divide`.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The categories the mart accepts.
PAYMENT_BEHAVIOURS = [
    "High_spent_Large_value_payments",
    "High_spent_Medium_value_payments",
    "High_spent_Small_value_payments",
    "Low_spent_Large_value_payments",
    "Low_spent_Medium_value_payments",
    "Low_spent_Small_value_payments",
]
CREDIT_MIXES = ["Bad", "Good", "Standard"]
UNKNOWN = "Unknown"

AGE_RANGE = (0, 150)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_to_int(c: str | Column) -> Column:
    """Text to int, dropping a fraction (`3.0` is 3); anything else is null."""
    return F.regexp_replace(F.trim(_col(c)), r"\.\d*$", "").try_cast("int")


def clean_number(c: str | Column, to: str = "float") -> Column:
    """A number with underscores scattered through it."""
    return F.replace(_col(c).cast("string"), F.lit("_"), F.lit("")).try_cast(to)


def digits(c: str | Column) -> Column:
    """The digits and points of a value as a double; a sign is lost."""
    return F.regexp_replace(_col(c).cast("string"), "[^0-9.]", "").try_cast("double")


def null_if(c: str | Column, condition: Column) -> Column:
    return F.when(condition, F.lit(None)).otherwise(_col(c))


def whitelist(c: str | Column, allowed: Iterable[str], other: str = UNKNOWN) -> Column:
    return F.when(_col(c).isin(list(allowed)), _col(c)).otherwise(other)


def clean_category(c: str | Column, other: str = UNKNOWN) -> Column:
    """Trim; blank, all-underscore, `None` and null become `other`."""
    trimmed = F.trim(_col(c))
    return F.coalesce(null_if(trimmed, trimmed.rlike(r"^(_*|None)\z")), F.lit(other))


def flag_and_fill(c: Column, sentinel: Column | int) -> tuple[Column, Column]:
    """(value with the sentinel for null, 1/0 missing flag)."""
    fill = sentinel if isinstance(sentinel, Column) else F.lit(sentinel)
    return F.coalesce(c, fill), c.isNull().cast("int")


def clean_bounded_int(
    c: str | Column, bounds: tuple[int, int] = AGE_RANGE, strip_first: bool = False
) -> tuple[Column, Column]:
    """Int within bounds and a missing flag; outside or unreadable becomes the upper bound.

    By default a value with an underscore counts as unreadable. `strip_first` removes the
    underscores before the cast.
    """
    low, high = bounds
    text = _col(c).cast("string")
    value = text_to_int(F.replace(text, F.lit("_"), F.lit("")) if strip_first else text)
    return flag_and_fill(null_if(value, ~value.between(low, high)), high)


def enforce_schema(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns in one projection; other columns pass through."""
    by_name = {name.lower(): (name, to) for name, to in types.items()}
    present = {f.name.lower() for f in df.schema.fields}
    missing = [name for name in types if name.lower() not in present]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    return df.select(*[_typed(f, *by_name.get(f.name.lower(), (f.name, None))) for f in df.schema.fields])


def _typed(field: T.StructField, name: str, to: str | None) -> Column:
    source = F.col(f"`{field.name}`")
    if to is None:
        return source
    if to == "int" and isinstance(field.dataType, T.StringType):
        return text_to_int(source).alias(name)
    return source.try_cast(to).alias(name)


def complete_rows(df: DataFrame, n: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Rows without any null; the first `n` by `order`, or by all columns, where a sample to look at is wanted."""
    complete = df.na.drop()
    return complete if n is None else complete.orderBy(*(order or df.columns)).limit(n)
