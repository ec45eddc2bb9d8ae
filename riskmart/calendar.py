"""Month spine and the training calendar, as column expressions Catalyst can fold."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.schemas import SNAPSHOT


def as_date(value: str | date | Column) -> Column:
    """A date literal, so that comparisons with it reach the scan."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def months_between_bounds(bounds: DataFrame, start: str, end: str, name: str = SNAPSHOT) -> DataFrame:
    """First of every month from `start`'s month to `end`, for each row of `bounds`."""
    first = F.trunc(F.col(start), "MM")
    return bounds.select(F.explode(F.sequence(first, F.col(end), F.expr("interval 1 month"))).alias(name))


def month_spine(spark: SparkSession, start: str | date, end: str | date, name: str = SNAPSHOT) -> DataFrame:
    bounds = spark.range(1).select(as_date(start).alias("start"), as_date(end).alias("end"))
    return months_between_bounds(bounds, "start", "end", name)


def month_spine_of(df: DataFrame, column: str = SNAPSHOT) -> DataFrame:
    """Month spine over the dates a table holds."""
    bounds = df.agg(F.min(column).alias("start"), F.max(column).alias("end"))
    return months_between_bounds(bounds, "start", "end", column)


@dataclass(frozen=True)
class TrainingWindows:
    """Closed date ranges: out-of-time sample just before the train date, train/test before that."""

    train_date: Column
    oot_months: int = 2
    train_test_months: int = 12

    @property
    def oot_start(self) -> Column:
        return F.add_months(self.train_date, -self.oot_months)

    @property
    def oot_end(self) -> Column:
        return F.date_sub(self.train_date, 1)

    @property
    def train_test_start(self) -> Column:
        return F.add_months(self.oot_start, -self.train_test_months)

    @property
    def train_test_end(self) -> Column:
        return F.date_sub(self.oot_start, 1)

    def columns(self) -> list[Column]:
        return [
            self.train_test_start.alias("train_test_start_date"),
            self.train_test_end.alias("train_test_end_date"),
            self.oot_start.alias("oot_start_date"),
            self.oot_end.alias("oot_end_date"),
        ]


def training_windows(train_date: str | date | Column, oot_months: int = 2, train_test_months: int = 12) -> TrainingWindows:
    return TrainingWindows(as_date(train_date), oot_months, train_test_months)
