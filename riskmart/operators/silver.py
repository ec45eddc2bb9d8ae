"""Bronze to silver, one projection per table, for any range of snapshots at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions import cleaning as C
from riskmart.functions import features as X
from riskmart.functions import labels as L
from riskmart.operators.imputation import impute_median
from riskmart.schemas import (
    ATTRIBUTE_TYPES,
    CLICKSTREAM_TYPES,
    DIRTY_NUMBERS,
    FINANCIAL_TYPES,
    LOAN_TYPES,
    SNAPSHOT,
)


def clickstream(bronze: DataFrame) -> DataFrame:
    typed = C.enforce_schema(bronze, CLICKSTREAM_TYPES)
    return typed.withColumn("fe_1_5_mean", X.row_mean([f"fe_{i}" for i in range(1, 6)]))


def attributes(bronze: DataFrame, strip_first: bool = False) -> DataFrame:
    """Occupation cleaned, Age replaced by Age_num and Age_missing."""
    age_type = {"Age": "string"} if strip_first else {}
    typed = C.enforce_schema(bronze, {**ATTRIBUTE_TYPES, **age_type})
    age, missing = C.clean_bounded_int("Age", strip_first=strip_first)
    return typed.withColumns(
        {"Occupation": C.clean_category("Occupation"), "Age_num": age, "Age_missing": missing}
    ).drop("Age")


def financials_numeric(bronze: DataFrame) -> DataFrame:
    """Types enforced and the dirty numbers read as floats."""
    typed = C.enforce_schema(bronze, FINANCIAL_TYPES)
    return typed.withColumns({c: C.clean_number(c) for c in DIRTY_NUMBERS})


def financials(
    bronze: DataFrame, version: int = 2, null_list_is_empty: bool = False, keep_sign: bool = False
) -> DataFrame:
    """Imputed, whitelisted and derived financial features.

    Version 1 divides delay by late payments without a guard and keeps the list of loans.
    """
    imputed = impute_median(financials_numeric(bronze), ["Changed_Credit_Limit"], SNAPSHOT)
    per_late = X.days_per_late_payment(
        "Delay_from_due_date", "Num_of_Delayed_Payment", guard=version >= 2, keep_sign=keep_sign
    )
    counts = X.multi_hot_counts("Type_of_Loan", on_null=0 if null_list_is_empty else -1)
    derived = imputed.withColumns(
        {
            "Payment_Behaviour": C.whitelist("Payment_Behaviour", C.PAYMENT_BEHAVIOURS),
            "Credit_Mix": C.whitelist("Credit_Mix", C.CREDIT_MIXES),
            "days_overdue_per_late_payment": per_late,
            "Credit_History_Age_num": X.parse_duration_years("Credit_History_Age"),
            "debt_to_income_ratio": X.divide("Outstanding_Debt", "Annual_Income"),
            "monthly_repayment_to_income": X.divide("Total_EMI_per_month", "Monthly_Inhand_Salary"),
            **counts,
        }
    ).withColumn("credit_inquiries_per_year", X.divide("Num_Credit_Inquiries", "Credit_History_Age_num"))
    return derived.drop("Credit_History_Age", *(["Type_of_Loan"] if version >= 2 else []))


def loans(bronze: DataFrame, zero_due_is_missed: bool = False) -> DataFrame:
    """Delinquency of every loan instalment: month on book, instalments missed, days past due.

    Missing numbers become 0, after the missed instalments have been counted.
    """
    typed = C.enforce_schema(bronze, LOAN_TYPES).withColumn("mob", F.col("installment_num"))
    missed = L.installments_missed(F.col("overdue_amt"), F.col("due_amt"), zero_due_is_missed)
    counted = typed.withColumn("installments_missed", missed).na.fill(0)
    dated = counted.withColumn(
        "first_missed_date", L.first_missed_date(F.col(SNAPSHOT), F.col("installments_missed"))
    )
    return dated.withColumn(
        "dpd", L.days_past_due(F.col(SNAPSHOT), F.col("overdue_amt"), F.col("first_missed_date"))
    )
