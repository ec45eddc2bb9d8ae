"""Exact median per snapshot in bounded steps, and filling with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskmart.schemas import SNAPSHOT

# Bands per doubling of the magnitude. 32-bit floats span 2^-149 .. 2^128, which gives at most
# 2 * 277 * 128 bands, and a band holds at most 2^17 different floats.
BANDS_PER_DOUBLING = 128
_OFFSET = 150 * BANDS_PER_DOUBLING


def _band(v: Column) -> Column:
    """Order-preserving coarse key of a 32-bit float."""
    size = F.least(F.log2(F.abs(v.cast("double"))), F.lit(128.0))
    position = F.floor(size * BANDS_PER_DOUBLING) + _OFFSET
    return F.when(v == 0, F.lit(0)).when(v > 0, position).otherwise(-position).cast("int")


def snapshot_medians(df: DataFrame, columns: Sequence[str], by: str = SNAPSHOT) -> DataFrame:
    """Lower median of 32-bit float columns per snapshot: (by, column, median).

    No task ever holds a snapshot's values. First the values are counted by band, map-side, and
    a running count over the bands (a bounded number per snapshot) finds the one with the
    middle row. Then only that band's values are counted one by one. Null and NaN do not count.
    """
    if not isinstance(df.schema[by].dataType, T.DateType):
        raise TypeError(f"{by} is not a date")  # a calendar bounds what is broadcast
    for c in columns:
        if not isinstance(df.schema[c].dataType, T.FloatType):
            raise TypeError(f"{c} is not a 32-bit float")
    # -0.0 + 0.0 is 0.0, one value for both zeros.
    values = (
        df.select(by, *[(F.col(c) + F.lit(0.0).cast("float")).alias(c) for c in columns])
        .unpivot([by], list(columns), "column", "value")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .withColumn("band", _band(F.col("value")))
    )
    group = [by, "column"]
    every = Window.partitionBy(*group)
    up_to = every.orderBy("band").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.floor((F.sum("n").over(every) + 1) / 2)
    bands = (
        values.groupBy(*group, "band")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*group, "band", "n", F.sum("n").over(up_to).alias("seen"), middle.alias("middle"))
        .filter((F.col("middle") > F.col("seen") - F.col("n")) & (F.col("middle") <= F.col("seen")))
        .select(*group, "band", (F.col("middle") - F.col("seen") + F.col("n")).alias("rank"))
    )
    # One row per snapshot date and column.
    in_band = values.join(F.broadcast(bands), [*group, "band"])
    up_to_value = every.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        in_band.groupBy(*group, "value", "rank")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("seen", F.sum("n").over(up_to_value))
        .filter(F.col("seen") >= F.col("rank"))
        .groupBy(*group)
        .agg(F.min("value").cast("double").alias("median"))
    )


def impute_median(df: DataFrame, columns: Sequence[str], by: str = SNAPSHOT) -> DataFrame:
    """Fill nulls with the snapshot's median; the filled columns become doubles.

    A snapshot without any value keeps its nulls.
    """
    medians = snapshot_medians(df, columns, by)
    wide = medians.groupBy(by).agg(
        *[F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"__median_{c}") for c in columns]
    )
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"__median_{c}")) for c in columns}
    return (
        df.join(F.broadcast(wide), by, "left")
        .select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])
    )
