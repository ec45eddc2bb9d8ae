"""Delinquency and default-label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmart.functions.features import divide


def installments_missed(overdue: Column, due: Column, zero_due_is_missed: bool = False) -> Column:
    """Overdue amount in instalments, rounded up; 0 where it cannot be told.

    `zero_due_is_missed` counts one instalment where something is overdue but nothing is due.
    """
    missed = F.coalesce(F.ceil(divide(overdue, due)).try_cast("int"), F.lit(0))
    if zero_due_is_missed:
        missed = F.when((overdue > 0) & (F.coalesce(due, F.lit(0.0)) == 0), 1).otherwise(missed)
    return missed


def first_missed_date(snapshot_date: Column, missed: Column) -> Column:
    return F.when(missed > 0, F.add_months(snapshot_date, -missed))


def days_past_due(snapshot_date: Column, overdue: Column, first_missed: Column) -> Column:
    return F.when(overdue > 0, F.datediff(snapshot_date, first_missed)).otherwise(0)


def past_due_flag(dpd: Column, threshold: int) -> Column:
    """1 at or beyond the threshold, else 0; an unknown number of days is 0."""
    return F.coalesce((dpd >= threshold).cast("int"), F.lit(0))


def label_definition(dpd: int, mob: int) -> str:
    return f"{dpd}dpd_{mob}mob"
