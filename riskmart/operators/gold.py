"""Label store and feature stores."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.labels import label_definition, past_due_flag
from riskmart.operators.joins import outer_chain
from riskmart.schemas import CUSTOMER, LOAN, SNAPSHOT
from riskmart.sources import store

KEYS = [CUSTOMER, SNAPSHOT]


def label_store(silver_loans: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """1 for loans at least `dpd` days past due at month `mob` on book, 0 for the others."""
    return silver_loans.filter(F.col("mob") == mob).select(
        LOAN,
        CUSTOMER,
        past_due_flag(F.col("dpd"), dpd).alias("label"),
        F.lit(label_definition(dpd, mob)).alias("label_def"),
        SNAPSHOT,
    )


def static_features(attributes: DataFrame, financials: DataFrame) -> DataFrame:
    """Attributes with the financials of the same customer and snapshot.

    The right side has a row for each key, so a hot key can only be on the left, where adaptive
    execution splits it. The same holds for the joins of version 2 below.
    """
    return attributes.join(financials, KEYS, "left")


def attributes_needed(
    attributes: DataFrame, clickstream: DataFrame, start: str | date | None, end: str | date | None, days: Iterable[date] | None = None
) -> DataFrame:
    """The attribute rows that version 2 of the store reads for the snapshots of a range, or of a list.

    Those of the range itself, and of any snapshot for customers with clicks in it: what is
    joined and written for one snapshot then does not grow with the history.
    """
    clicked = clickstream.select(CUSTOMER).distinct().withColumn("__clicked", F.lit(True))
    built = store.in_range(start, end) if days is None else store.on_days(days)
    return attributes.join(clicked, CUSTOMER, "left").filter(built | F.col("__clicked")).drop("__clicked")


def feature_store_v1(clickstream: DataFrame, attributes: DataFrame, financials: DataFrame) -> DataFrame:
    """Everything known of a customer in a snapshot, from whichever sources have it."""
    return outer_chain([clickstream, financials, attributes], KEYS)


def feature_store_v2(
    clickstream: DataFrame, static: DataFrame, start: str | date | None = None, end: str | date | None = None
) -> DataFrame:
    """Click rows with the customer's static features, and static rows without clicks.

    A click row joins the static features of every snapshot of its customer, one output row
    each, so `static` holds all snapshots even if only some are built; it has at most one row
    of a customer for each snapshot. The static rows of a built snapshot whose customer has no
    clicks in it follow with null click features. All snapshots from `start` to `end` are built
    in one pass.
    """
    clicks, built = (store.between(df, start, end) for df in (clickstream, static))
    clicked = clicks.join(static.drop(SNAPSHOT), CUSTOMER, "left")
    unclicked = built.join(clicks.select(KEYS), KEYS, "left_anti")
    return clicked.unionByName(unclicked, allowMissingColumns=True)
