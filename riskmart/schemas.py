"""Declared schemas of the source tables. Nothing is inferred on read.

Raw files hold text: numbers may carry stray characters, so a source is read as strings (only
the snapshot date is typed, for pruning) and gets its types in the silver step.
"""

from __future__ import annotations

from pyspark.sql import types as T

SNAPSHOT = "snapshot_date"
CUSTOMER = "Customer_ID"
LOAN = "loan_id"

STRING, INT, FLOAT, DATE = "string", "int", "float", "date"

CLICK_FEATURES = [f"fe_{i}" for i in range(1, 21)]

# Column names and types of the sources.
LOAN_TYPES = {
    LOAN: STRING,
    CUSTOMER: STRING,
    "loan_start_date": DATE,
    "tenure": INT,
    "installment_num": INT,
    "loan_amt": FLOAT,
    "due_amt": FLOAT,
    "paid_amt": FLOAT,
    "overdue_amt": FLOAT,
    "balance": FLOAT,
    SNAPSHOT: DATE,
}

CLICKSTREAM_TYPES = {**{c: FLOAT for c in CLICK_FEATURES}, CUSTOMER: STRING, SNAPSHOT: DATE}

ATTRIBUTE_TYPES = {CUSTOMER: STRING, "Age": INT, "SSN": STRING, "Occupation": STRING, SNAPSHOT: DATE}

# Numbers that arrive as text with stray underscores.
DIRTY_NUMBERS = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_of_Loan",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
]

FINANCIAL_TYPES = {
    CUSTOMER: STRING,
    "Num_Bank_Accounts": INT,
    "Num_Credit_Card": INT,
    "Interest_Rate": INT,
    "Delay_from_due_date": INT,
    "Num_Credit_Inquiries": INT,
    "Payment_of_Min_Amount": STRING,
    "Payment_Behaviour": STRING,
    "Type_of_Loan": STRING,
    "Credit_Mix": STRING,
    **{c: STRING for c in DIRTY_NUMBERS},
    "Credit_History_Age": STRING,
    SNAPSHOT: DATE,
}

SOURCES = {
    "loans": LOAN_TYPES,
    "clickstream": CLICKSTREAM_TYPES,
    "attributes": ATTRIBUTE_TYPES,
    "financials": FINANCIAL_TYPES,
}


def raw_schema(source: str, order: list[str] | None = None) -> T.StructType:
    """Schema of a source's CSV files: text, with the snapshot date typed."""
    columns = order or list(SOURCES[source])
    return T.StructType(
        [T.StructField(c, T.DateType() if c.lower() == SNAPSHOT else T.StringType()) for c in columns]
    )
