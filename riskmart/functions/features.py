"""Feature expressions: durations, ratios, multi-hot counts, row means, bins."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmart.functions.cleaning import _col, digits

# Loan types counted in the comma list of a customer's loans.
LOAN_KINDS = [
    "Auto Loan",
    "Credit-Builder Loan",
    "Debt Consolidation Loan",
    "Home Equity Loan",
    "Mortgage Loan",
    "Not Specified",
    "Payday Loan",
    "Personal Loan",
    "Student Loan",
]

# Bin edges and labels of the analyses.
DTI_EDGES = [0.0, 0.05, 0.10, 0.15, 0.20, float("inf")]
DTI_BINS = ["<5%", "5–10%", "10–15%", "15–20%", ">20%"]
DELAY_EDGES = [7.0, 15.0, 30.0]
DELAY_BINS = ["≤ 6", "7–14", "15–29", "≥ 30"]
INQUIRY_BINS = ["0", "1–2", "3+"]
EMI_EDGES = [0.20, 0.40, 0.50]
EMI_BINS = ["<20", "20–39", "40–49", "≥50"]
EMI_EDGES_V1 = [0.20, 0.30, 0.50]
EMI_BINS_V1 = ["<20", "20–29", "30–49", "≥50"]


def divide(a: str | Column, b: str | Column) -> Column:
    """Double division; null when the divisor is zero."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def ratio(a: str | Column, b: str | Column, on_missing: float = 0.0) -> Column:
    """Division where no result (zero divisor, null or NaN) gives `on_missing`."""
    quotient = divide(a, b)
    return F.coalesce(F.nanvl(quotient, F.lit(on_missing)), F.lit(on_missing))


def row_mean(columns: Sequence[str | Column]) -> Column:
    """Mean across columns as float; null if any is null."""
    return (reduce(add, [_col(c) for c in columns]) / F.lit(len(columns))).cast("float")


def parse_duration_years(c: str | Column) -> Column:
    """`22 Years and 1 Months` in years as float; null unless both parts are there."""

    def part(unit: str) -> Column:
        return F.regexp_extract(_col(c), rf"(\d+)\s+{unit}s?", 1).try_cast("int")

    return (part("Year") + part("Month") / F.lit(12)).cast("float")


def days_per_late_payment(
    delay: str | Column, late_payments: str | Column, guard: bool = True, keep_sign: bool = False
) -> Column:
    """Days of delay per late payment.

    Guarded: a missing delay is 0 and a missing or non-positive count is 1, both read by their
    digits, so a negative delay counts by its size. `keep_sign` floors it at 0 instead and
    works on the numbers. Unguarded: plain division.
    """
    if not guard:
        return divide(delay, late_payments)
    if keep_sign:
        days, count = _col(delay).cast("double"), _col(late_payments).cast("double")
        days = F.greatest(days, F.lit(0.0))
    else:
        days, count = digits(delay), digits(late_payments)
    return F.coalesce(days, F.lit(0.0)) / F.when(count > 0, count).otherwise(1.0)


def split_list(c: str | Column) -> Column:
    """`A, B, and C` as an array; the word `and` also separates."""
    return F.split(F.regexp_replace(_col(c), r"\s+and\s+", ","), r",\s*")


def count_column(value: str) -> str:
    return value.replace("-", "_").replace(" ", "_") + "_count"


def multi_hot_counts(
    c: str | Column, values: Iterable[str] = tuple(LOAN_KINDS), on_null: int = -1, other: str = "Unknown_count"
) -> dict[str, Column]:
    """How often each value occurs in a list column, and a flag for lists with none of them.

    A null list counts `on_null` for every value: -1 marks it apart from an empty list (and
    leaves the flag 0), 0 treats it as empty (and sets the flag).
    """
    items = split_list(c)
    counts = {
        count_column(v): F.coalesce(F.size(items) - F.size(F.array_remove(items, v)), F.lit(on_null))
        for v in values
    }
    known = reduce(add, counts.values())
    return {**counts, other: (known == 0).cast("int")}


def cut(value: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins with the lowest edge included; null outside."""
    v = _col(value)
    chain = F.when(v.isNull() | F.isnan(v) | (v < edges[0]), F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels, strict=True):
        chain = chain.when(v <= edge, label)
    return chain


def bin_below(value: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-closed bins: label k below edge k, the last label for everything else, null too."""
    v = _col(value)
    chain = F
    for edge, label in zip(edges, labels[:-1], strict=True):
        chain = chain.when(v < edge, F.lit(label))
    return chain.otherwise(labels[-1])


def average_delay(delay: str | Column, late_payments: str | Column) -> Column:
    """Days per late payment for the analysis; 0 without late payments."""
    return F.when(_col(late_payments) > 0, divide(delay, late_payments)).otherwise(0.0)


def bin_delay(average: Column) -> Column:
    return bin_below(average, DELAY_EDGES, DELAY_BINS)


def bin_inquiry(rate: Column, gapless: bool = False) -> Column:
    """0, 1 to 2, and everything else `3+`; `gapless` puts rates above 0 and below 3 in the middle."""
    zero, few, many = INQUIRY_BINS
    middle = (rate > 0) & (rate < 3) if gapless else rate.between(1, 2)
    return F.when(rate == 0, zero).when(middle, few).otherwise(many)


def bin_emi(burden: Column, edges: Sequence[float] = tuple(EMI_EDGES), labels: Sequence[str] = tuple(EMI_BINS)) -> Column:
    return bin_below(burden, edges, labels)


def column_number(name: str | Column) -> Column:
    """`fe_7` to 7."""
    return F.regexp_extract(_col(name), r"_(\d+)$", 1).try_cast("int")
