"""Default rates by bin, by month on book and over time, and feature profiles.

The analyses pair every feature row of a customer with every label of the customer. Only sums
and counts of the pairs are needed, so each side is aggregated per customer before the join and
the totals are products: no pair is ever built and a customer with many rows shrinks to one.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.calendar import as_date, month_spine
from riskmart.functions import features as X
from riskmart.functions.labels import past_due_flag
from riskmart.schemas import CUSTOMER, LOAN, SNAPSHOT


def first_label(labels: DataFrame) -> DataFrame:
    """One label per customer: the earliest snapshot's, then the first loan's."""
    earliest = F.min(F.struct(SNAPSHOT, LOAN, "label"))["label"]
    return labels.groupBy(CUSTOMER).agg(earliest.alias("label"))


def with_outcome(features: DataFrame, labels: DataFrame, dedup: bool = False) -> DataFrame:
    """Feature rows with the customer's labels as `default`, of any date.

    A customer with many labels does not multiply its rows: there is one row per outcome, and
    `labels` says how many labels it stands for.
    """
    outcome = (first_label(labels) if dedup else labels).withColumnRenamed("label", "default")
    counted = outcome.groupBy(CUSTOMER, "default").agg(F.count(F.lit(1)).alias("labels"))
    # Two rows per customer at most on this side; adaptive execution splits hot feature keys.
    return features.join(counted, CUSTOMER, "inner")


def rates_by_bin(features: DataFrame, labels: DataFrame, bin_column: Column, dedup: bool = False) -> DataFrame:
    """Mean label per bin over all pairs of a feature row and a label of its customer."""
    binned = features.select(CUSTOMER, bin_column.alias("bin")).groupBy(CUSTOMER, "bin").agg(
        F.count(F.lit(1)).cast("double").alias("rows")
    )
    outcome = (first_label(labels) if dedup else labels).groupBy(CUSTOMER).agg(
        F.count("label").cast("double").alias("labels"), F.sum("label").cast("double").alias("bad")
    )
    return (
        binned.join(outcome, CUSTOMER, "inner")
        .groupBy("bin")
        .agg(F.try_divide(F.sum(F.col("rows") * F.col("bad")), F.sum(F.col("rows") * F.col("labels"))).alias("default_rate"))
    )


def on_domain(rates: DataFrame, domain: Sequence[str], key: str = "bin") -> DataFrame:
    """Every bin of the domain once, in order, null where there is no data."""
    bins = rates.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(b) for b in domain])).alias("bin_order", key)
    )
    listed = rates.filter(F.col(key).isin(list(domain)))  # one row per bin at most
    return bins.join(F.broadcast(listed), key, "left").orderBy("bin_order")


def default_rate_by_bin(
    features: DataFrame,
    labels: DataFrame,
    bin_column: Column,
    domain: Sequence[str],
    dedup: bool = False,
) -> DataFrame:
    rates = rates_by_bin(features, labels, bin_column, dedup)
    return on_domain(rates, domain).select(
        "bin_order", "bin", (F.col("default_rate") * 100).alias("default_rate_pct")
    )


def default_rate_by_dti(financials: DataFrame, labels: DataFrame) -> DataFrame:
    """Debt-to-income of customers with an income. The quotient is a 32-bit float, so one that
    is exactly an edge in decimals may fall in the bin above."""
    earning = financials.filter(F.col("Annual_Income") > 0)
    dti = X.divide("Outstanding_Debt", "Annual_Income").cast("float").cast("double")
    return default_rate_by_bin(earning, labels, X.cut(dti, X.DTI_EDGES, X.DTI_BINS), X.DTI_BINS, dedup=True)


def default_rate_by_delay(financials: DataFrame, labels: DataFrame) -> DataFrame:
    delay = X.average_delay("Delay_from_due_date", "Num_of_Delayed_Payment")
    return default_rate_by_bin(financials, labels, X.bin_delay(delay), X.DELAY_BINS)


def default_rate_by_inquiry(financials: DataFrame, labels: DataFrame, gapless: bool = False) -> DataFrame:
    rate = X.ratio("Num_Credit_Inquiries", "Credit_History_Age_num")
    return default_rate_by_bin(financials, labels, X.bin_inquiry(rate, gapless), X.INQUIRY_BINS)


def default_rate_by_emi(
    financials: DataFrame,
    labels: DataFrame,
    edges: Sequence[float] = tuple(X.EMI_EDGES),
    bins: Sequence[str] = tuple(X.EMI_BINS),
) -> DataFrame:
    burden = X.ratio("Total_EMI_per_month", "Monthly_Inhand_Salary")
    return default_rate_by_bin(financials, labels, X.bin_emi(burden, edges, bins), bins)


def final_instalments(silver_loans: DataFrame, instalment: int = 10) -> DataFrame:
    """Loans at their last instalment, the cohort of outcomes that no longer change."""
    return silver_loans.filter(F.col("installment_num") == instalment)


def bad_rate_by_mob(
    silver_loans: DataFrame, dpd: int = 30, started_before: str | date | None = "2024-01-01"
) -> DataFrame:
    """Share of instalments at least `dpd` days past due, by month on book, of completed loans."""
    if started_before is not None:
        silver_loans = silver_loans.filter(F.col("loan_start_date") < as_date(started_before))
    flag = past_due_flag(F.col("dpd"), dpd)
    return silver_loans.groupBy("mob").agg(F.avg(flag).alias("bad_rate")).orderBy("mob")


def default_rate_over_time(labels: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Monthly mean label on a full calendar, null in months without labels."""
    monthly = labels.groupBy(F.trunc(SNAPSHOT, "MM").alias("month")).agg(F.avg("label").alias("default_rate"))
    # One row per calendar month on either side.
    spine = month_spine(labels.sparkSession, start, end, "month")
    return spine.join(F.broadcast(monthly), "month", "left").orderBy("month")


def feature_profile(clickstream: DataFrame, labels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean of each click feature by outcome: one row per feature, one column per outcome."""
    sums = {c: f"{c}__sum" for c in columns}
    counts = {c: f"{c}__n" for c in columns}
    per_customer = clickstream.groupBy(CUSTOMER).agg(
        *[F.sum(F.col(c).cast("double")).alias(sums[c]) for c in columns],
        *[F.count(c).cast("double").alias(counts[c]) for c in columns],
    )
    outcomes = labels.groupBy(CUSTOMER, F.col("label").alias("default")).agg(
        F.count(F.lit(1)).cast("double").alias("labels")
    )
    means = (
        per_customer.join(outcomes, CUSTOMER, "inner")
        .groupBy("default")
        .agg(
            *[
                F.try_divide(
                    F.sum(F.col(sums[c]) * F.col("labels")), F.sum(F.col(counts[c]) * F.col("labels"))
                ).alias(c)
                for c in columns
            ]
        )
    )
    # One row per outcome from here on.
    return (
        means.unpivot(["default"], list(columns), "period", "mean_count")
        .groupBy(X.column_number("period").alias("period_num"))
        .pivot("default", [0, 1])
        .agg(F.first("mean_count").alias("mean"), F.count(F.lit(1)).alias("n"))
        # An outcome that nobody has counts 0; one whose values are all missing has no mean.
        .select(
            "period_num",
            *[
                F.when(F.coalesce(f"{outcome}_n", F.lit(0)) == 0, F.lit(0.0)).otherwise(F.col(f"{outcome}_mean")).alias(name)
                for outcome, name in ((0, "Non-Default"), (1, "Default"))
            ],
        )
        .orderBy("period_num")
    )
