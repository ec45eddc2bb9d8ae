"""Adapters: the sources of the mart as SQL over the tables of a test scale factor.

One text per source. The tables are named in braces; the text runs on Spark (with DataFrames
bound to the names) and, with the plain table names put in, on any ANSI SQL engine. The dirt is a
function of the key, so it is the same at every run and every scale.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

LOANS = """
SELECT CAST(l.l_orderkey AS STRING) AS loan_id, CAST(o.o_custkey AS STRING) AS Customer_ID,
  CAST(o.o_orderdate AS DATE) AS loan_start_date, 7 AS tenure, l.l_linenumber AS installment_num,
  CAST(l.l_extendedprice AS FLOAT) AS loan_amt,
  CAST(CASE WHEN l.l_partkey % 97 = 0 THEN 0 ELSE l.l_extendedprice / l.l_quantity END AS FLOAT) AS due_amt,
  CAST(l.l_extendedprice * (1 - l.l_discount) AS FLOAT) AS paid_amt,
  CAST(CASE WHEN l.l_returnflag = 'R' THEN l.l_extendedprice * l.l_discount ELSE 0 END AS FLOAT) AS overdue_amt,
  CAST(l.l_extendedprice * (1 + l.l_tax) AS FLOAT) AS balance,
  CAST(date_trunc('month', l.l_shipdate) AS DATE) AS snapshot_date
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""

# Event types in the order of the click features, five per quarter of the day.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
CLICK_COUNTS = ",\n  ".join(
    f"sum(CASE WHEN event_type = '{kind}' AND hour(ts) BETWEEN {6 * quarter} AND {6 * quarter + 5} THEN 1 ELSE 0 END)"
    f" AS fe_{5 * quarter + position}"
    for quarter in range(4)
    for position, kind in enumerate(EVENT_TYPES, start=1)
)

CLICKSTREAM = """
SELECT CAST(user_id AS STRING) AS Customer_ID, CAST(date_trunc('week', ts) AS DATE) AS snapshot_date,
  """ + CLICK_COUNTS + """
FROM {events} GROUP BY 1, 2
"""

MONTHLY_FEATURES = """
SELECT CAST(o.o_custkey AS STRING) AS Customer_ID,
  CAST(date_trunc('month', l.l_shipdate) AS DATE) AS snapshot_date,
  count(*) AS fe_1, CAST(sum(CAST(l.l_quantity AS INT)) AS BIGINT) AS fe_2, max(l.l_linenumber) AS fe_3,
  sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS fe_4, count(DISTINCT l.l_suppkey) AS fe_5
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
GROUP BY 1, 2
"""

# Customers with the number of their snapshot; every seventh has a second one, with other values. Each
# column below has a modulus of its own, so that it is independent of the snapshot and of the others.
_HELD = """(
  SELECT c_custkey, c_mktsegment, c_custkey % 101 % 4 AS snap, 0 AS again FROM {customer}
  UNION ALL
  SELECT c_custkey, c_mktsegment, (c_custkey % 101 + 1) % 4 AS snap, 1 AS again FROM {customer} WHERE c_custkey % 7 = 3) c"""

_SNAPSHOT = """CASE snap WHEN 0 THEN DATE '2024-01-01' WHEN 1 THEN DATE '2024-01-08'
       WHEN 2 THEN DATE '2024-01-15' ELSE DATE '2024-01-22' END AS snapshot_date"""

ATTRIBUTES = f"""
SELECT CAST(c_custkey AS STRING) AS Customer_ID,
  CASE WHEN c_custkey % 11 = 0 THEN concat(CAST(18 + (c_custkey + again) % 60 AS STRING), '_')
       WHEN c_custkey % 23 = 0 THEN '8698' WHEN c_custkey % 29 = 0 THEN '-500'
       ELSE CAST(18 + (c_custkey + again) % 60 AS STRING) END AS Age,
  concat('000-00-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) AS SSN,
  CASE WHEN c_custkey % 13 = 0 THEN '_______' WHEN c_custkey % 17 = 0 THEN 'None'
       WHEN c_custkey % 19 = 0 THEN concat('  ', c_mktsegment, ' ') ELSE c_mktsegment END AS Occupation,
  {_SNAPSHOT}
FROM {_HELD}
"""

FINANCIALS = f"""
SELECT CAST(c_custkey AS STRING) AS Customer_ID,
  CAST(c_custkey % 9 AS INT) AS Num_Bank_Accounts, CAST(c_custkey % 8 AS INT) AS Num_Credit_Card,
  CAST(1 + c_custkey % 30 AS INT) AS Interest_Rate, CAST((c_custkey + 3 * again) % 60 - 5 AS INT) AS Delay_from_due_date,
  CAST(c_custkey % 14 AS INT) AS Num_Credit_Inquiries,
  CASE c_custkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END AS Payment_of_Min_Amount,
  CASE c_custkey % 107 % 4 WHEN 0 THEN 'High_spent_Large_value_payments' WHEN 1 THEN 'Low_spent_Small_value_payments'
       WHEN 2 THEN 'High_spent_Medium_value_payments' ELSE '!@9#%8' END AS Payment_Behaviour,
  CASE c_custkey % 103 % 4 WHEN 0 THEN 'Good' WHEN 1 THEN 'Bad' WHEN 2 THEN 'Standard' ELSE '_' END AS Credit_Mix,
  CASE c_custkey % 6 WHEN 0 THEN 'Auto Loan, Credit-Builder Loan, and Home Equity Loan'
       WHEN 1 THEN 'Payday Loan and Payday Loan' WHEN 2 THEN 'Not Specified' WHEN 3 THEN 'Something Else'
       WHEN 4 THEN 'Student Loan, Personal Loan, and Mortgage Loan' ELSE NULL END AS Type_of_Loan,
  concat(CAST(CASE WHEN c_custkey % 41 = 0 THEN 0 ELSE 20000 + (c_custkey * 37) % 90000 END AS STRING),
         CASE WHEN c_custkey % 7 = 0 THEN '_' ELSE '' END) AS Annual_Income,
  CAST(CASE WHEN c_custkey % 43 = 0 THEN 0 ELSE 1500 + (c_custkey * 13) % 6000 END AS STRING) AS Monthly_Inhand_Salary,
  concat(CAST(c_custkey % 9 AS STRING), CASE WHEN c_custkey % 10 = 0 THEN '_' ELSE '' END) AS Num_of_Loan,
  CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE concat(CAST((c_custkey * 3 + 5 * snap) % 20 - 1 AS STRING), CASE WHEN c_custkey % 9 = 0 THEN '_' ELSE '' END) END AS Num_of_Delayed_Payment,
  CASE WHEN c_custkey % 12 = 0 THEN '_' ELSE CAST((c_custkey + 5 * again) % 31 + 40 * snap AS STRING) END AS Changed_Credit_Limit,
  concat(CAST((c_custkey * 53 + 700 * again) % 25000 AS STRING), CASE WHEN c_custkey % 21 = 0 THEN '_' ELSE '' END) AS Outstanding_Debt,
  CAST(20 + c_custkey % 30 AS STRING) AS Credit_Utilization_Ratio,
  CAST((c_custkey * 7) % 3000 AS STRING) AS Total_EMI_per_month,
  CASE WHEN c_custkey % 25 = 0 THEN '__10000__' ELSE CAST((c_custkey * 3) % 700 AS STRING) END AS Amount_invested_monthly,
  CAST((c_custkey * 11) % 900 AS STRING) AS Monthly_Balance,
  CASE WHEN c_custkey % 16 = 0 THEN 'NA' ELSE concat(CAST(c_custkey % 33 AS STRING), ' Years and ', CAST(c_custkey % 12 AS STRING), ' Months') END AS Credit_History_Age,
  {_SNAPSHOT}
FROM {_HELD}
"""

ADAPTERS = {
    "loans": LOANS,
    "clickstream": CLICKSTREAM,
    "monthly_features": MONTHLY_FEATURES,
    "attributes": ATTRIBUTES,
    "financials": FINANCIALS,
}


def tables_of(text: str) -> list[str]:
    """Tables a text reads."""
    return sorted({name for _, name, _, _ in Formatter().parse(text) if name})


def read_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A source table over the test tables in `folder`."""
    text = ADAPTERS[name]
    return spark.sql(text, **read_tables(spark, folder, tables_of(text)))


def plain_sql(name: str) -> str:
    """The adapter with plain table names."""
    text = ADAPTERS[name]
    return text.format(**{table: table for table in tables_of(text)}).strip()
