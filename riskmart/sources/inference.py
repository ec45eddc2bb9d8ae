"""Column types of text sources, found in one pass over all files.

Each value falls on a rung: int, bigint, double, date, timestamp or text. A column's type is the least one that holds all
rungs seen: whole numbers widen to doubles, dates to timestamps, everything else to text. What a task keeps for a
column are counts, the rungs seen and the least value of the widest, so that parts merge in any order and the result does not depend
on partitions. Patterns are matched by Arrow, for a batch's different values at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rungs from narrow to wide; a column without values is text.
RUNGS = ("int", "bigint", "double", "date", "timestamp", "string")
_NUMBERS, _TIMES = RUNGS[:3], RUNGS[3:5]

_WHOLE = r"^[+-]?[0-9]+\z"
_NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?\z"


def _value(c: str) -> Column:
    """A value without spaces around it; a blank one is missing."""
    trimmed = F.trim(F.col(f"`{c}`").cast("string"))
    return F.when(trimmed != "", trimmed)


def _on_calendar(day: str) -> bool:
    year, month, number = map(int, day.split("-"))
    if month == 2:
        return 1 <= number <= 28 + (year % 4 == 0 and (year % 100 != 0 or year % 400 == 0))
    return 1 <= month <= 12 and 1 <= number <= 30 + (month in (1, 3, 5, 7, 8, 10, 12))


def _on_clock(time: str) -> bool:
    return int(time[:2]) < 24 and int(time[3:5]) < 60 and int(time[6:8]) < 60


def rungs(values: pa.Array) -> np.ndarray:
    """For each text value the place in RUNGS of the narrowest type that holds it. Whole numbers beyond 64 bits are doubles."""
    found = np.full(len(values), RUNGS.index("string"))

    def those(at: np.ndarray, pattern: str) -> tuple[pa.Array, np.ndarray]:
        """Values of `at` under a pattern, and where they are."""
        fits = pc.match_substring_regex(values.take(pa.array(at)), pattern).to_numpy(zero_copy_only=False)
        return values.take(pa.array(at[fits])), at[fits]

    def left() -> np.ndarray:
        return np.flatnonzero(found == RUNGS.index("string"))

    whole, at = those(left(), _WHOLE)
    found[at] = RUNGS.index("int")  # up to nine characters always are
    long = pc.binary_length(whole).to_numpy(zero_copy_only=False) > 9
    for i, text in zip(at[long].tolist(), whole.filter(pa.array(long)).to_pylist()):
        digits = text.lstrip("+-").lstrip("0")
        n = int(text[0].replace("+", "") + (digits or "0") if text[0] in "+-" else digits or "0") if len(digits) < 20 else 1 << 64
        found[i] = RUNGS.index("int" if -(1 << 31) <= n < 1 << 31 else "bigint" if -(1 << 63) <= n < 1 << 63 else "double")
    found[those(left(), _NUMBER)[1]] = RUNGS.index("double")
    for text, i in zip(*(x.tolist() for x in those(left(), _DATE))):
        if _on_calendar(text):
            found[i] = RUNGS.index("date")
    for text, i in zip(*(x.tolist() for x in those(left(), _TIME))):
        if _on_calendar(text[:10]) and _on_clock(text[11:]):
            found[i] = RUNGS.index("timestamp")
    return found


_PARTIAL = "position int, n_rows long, n_values long, seen int, least string"


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows and values of each column, its rungs as bits, and the least value of the widest one behind a digit that puts wide rungs first."""
    totals: dict[int, list] = {}
    for batch in batches:
        for i, column in enumerate(batch.columns, 1):
            total = totals.setdefault(i, [i, 0, 0, 0, None])
            values = pc.utf8_trim(column, characters=" ").drop_null()
            values = values.filter(pc.not_equal(values, ""))
            total[1] += batch.num_rows
            total[2] += len(values)
            if not len(values):
                continue
            values = values.unique()
            found = rungs(values)
            for k in np.unique(found).tolist():
                total[3] |= 1 << k
            widest = int(found.max())
            least = f"{len(RUNGS) - widest}{pc.min(values.filter(pa.array(found == widest))).as_py()}"
            # Code points and bytes in UTF-8 are in the same order.
            total[4] = least if total[4] is None else min(total[4], least)
    if totals:
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*totals.values()), types)], [c.split(" ")[0] for c in _PARTIAL.split(", ")])


def _widest(present: dict[str, Column]) -> Column:
    numbers, times = (reduce(lambda a, b: a | b, [present[r] for r in rungs]) for rungs in (_NUMBERS, _TIMES))
    typed = F.when(present["string"] | (numbers & times) | ~(numbers | times), "string")
    for r in ("timestamp", "date", "double", "bigint"):
        typed = typed.when(present[r], r)
    return typed.otherwise("int")


def inferred_types(df: DataFrame) -> DataFrame:
    """A row for each column of `df`, read as text: position, column, type, n_values, n_missing, widened_by.

    `widened_by` is the least value, by code point, of the widest rung, where a column has values of several rungs: the
    one that keeps it from a narrower type. Null and blank values are missing. A table without rows has text columns.
    """
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(f"v{i}") for i, c in enumerate(df.columns)])
    none = df.sparkSession.createDataFrame([(i, 0, 0, 0, None) for i in range(1, len(df.columns) + 1)], _PARTIAL)
    # A row for each task and column.
    partials = texts.mapInArrow(_partials, _PARTIAL).unionAll(none)
    merged = partials.groupBy("position").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.bit_or("seen").alias("seen"), F.min("least").alias("least")
    )
    present = {r: F.col("seen").bitwiseAND(1 << k) > 0 for k, r in enumerate(RUNGS)}
    return merged.select(
        "position",
        F.element_at(F.array(*[F.lit(c) for c in df.columns]).cast("array<string>"), F.col("position")).alias("column"),
        _widest(present).alias("type"),
        "n_values",
        (F.col("n_rows") - F.col("n_values")).alias("n_missing"),
        F.when(F.bit_count("seen") > 1, F.expr("substring(least, 2)")).alias("widened_by"),
    )


def inferred_schema(df: DataFrame) -> T.StructType:
    """The types of `inferred_types` as a schema."""
    found = inferred_types(df).select("position", "column", "type").collect()
    return T.StructType([T.StructField(r["column"], T.DataType.fromDDL(r["type"])) for r in sorted(found)])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns under an inferred schema, in one projection; missing values are null, also blank text."""
    return df.select(*[_value(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def schema_report(df: DataFrame) -> DataFrame:
    """A row for each column of a table: position, column, its declared type, n_present and n_null."""
    columns = [
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            F.count(F.col(f"`{f.name}`")).alias("n_present"),
        )
        for i, f in enumerate(df.schema.fields, 1)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*columns).alias("columns")).select("n_rows", F.inline("columns"))
    return counted.select("position", "column", "type", "n_present", (F.col("n_rows") - F.col("n_present")).alias("n_null"))
