"""The registered queries as SQL for an independent engine over the same tables.

Written from the definition of each result, not from the DataFrame plan: plain joins that build
every pair, exact quantiles, rank sums.
"""

from __future__ import annotations

from riskmart.functions.cleaning import CREDIT_MIXES, PAYMENT_BEHAVIOURS
from riskmart.functions.features import (
    DELAY_BINS,
    DTI_BINS,
    EMI_BINS,
    EMI_BINS_V1,
    INQUIRY_BINS,
    LOAN_KINDS,
    count_column,
)
from riskmart.schemas import DIRTY_NUMBERS
from riskmart.sources.adapters import plain_sql

TRAIN_DATE = "DATE '2001-09-01'"
CLICKS = [f"fe_{i}" for i in range(1, 21)]


def _listed(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _with(select: str, *ctes: str) -> str:
    """A query over the named intermediate tables, in the order they build on each other."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for parent in PARENTS.get(name, ()):
            need(parent)
        if name not in wanted:
            wanted.append(name)

    for name in ctes:
        need(name)
    body = ",\n".join(f"{name} AS (\n{CTES[name]}\n)" for name in wanted)
    return f"WITH {body}\n{select}"


def _silver_loans(missed: str) -> str:
    return f"""
SELECT *, CAST(CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date) ELSE 0 END AS INT) AS dpd
FROM (
  SELECT *, CASE WHEN installments_missed > 0
                 THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
  FROM (
    SELECT loan_id, Customer_ID, loan_start_date, coalesce(tenure, 0) AS tenure,
      coalesce(installment_num, 0) AS installment_num, coalesce(loan_amt, 0) AS loan_amt,
      coalesce(due_amt, 0) AS due_amt, coalesce(paid_amt, 0) AS paid_amt, coalesce(overdue_amt, 0) AS overdue_amt,
      coalesce(balance, 0) AS balance, snapshot_date, coalesce(installment_num, 0) AS mob,
      CAST({missed} AS INT) AS installments_missed
    FROM loans))"""


MISSED = "coalesce(ceil(CAST(overdue_amt AS DOUBLE) / nullif(CAST(due_amt AS DOUBLE), 0)), 0)"

HISTORY_YEARS = """CAST(TRY_CAST(regexp_extract(Credit_History_Age, '(\\d+)\\s+Years?', 1) AS INT)
    + TRY_CAST(regexp_extract(Credit_History_Age, '(\\d+)\\s+Months?', 1) AS INT) / 12.0::DOUBLE AS FLOAT)"""

LATE_DAYS = """coalesce(CAST(abs(Delay_from_due_date) AS DOUBLE), 0)
    / CASE WHEN abs(Num_of_Delayed_Payment) > 0 THEN CAST(abs(Num_of_Delayed_Payment) AS DOUBLE) ELSE 1 END"""
LATE_DAYS_FIXED = """coalesce(greatest(CAST(Delay_from_due_date AS DOUBLE), 0), 0)
    / CASE WHEN Num_of_Delayed_Payment > 0 THEN CAST(Num_of_Delayed_Payment AS DOUBLE) ELSE 1 END"""
LATE_DAYS_V1 = "CAST(Delay_from_due_date AS DOUBLE) / nullif(CAST(Num_of_Delayed_Payment AS DOUBLE), 0)"


def _divided(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


def _loan_counts(on_null: int) -> str:
    items = "string_split_regex(regexp_replace(Type_of_Loan, '\\s+and\\s+', ',', 'g'), ',\\s*')"
    counts = {
        count_column(v): f"coalesce(CAST(len(list_filter({items}, lambda x: x = '{v}')) AS INT), {on_null})"
        for v in LOAN_KINDS
    }
    total = " + ".join(counts.values())
    columns = ",\n  ".join(f"{c} AS {name}" for name, c in counts.items())
    return f"{columns},\n  CASE WHEN {total} = 0 THEN 1 ELSE 0 END AS Unknown_count"


def _whitelisted(column: str, allowed: list[str]) -> str:
    return f"CASE WHEN {column} IN ({_listed(allowed)}) THEN {column} ELSE 'Unknown' END AS {column}"


def _silver_financials(late_days: str, keep: str = "") -> str:
    plain = [c for c in DIRTY_NUMBERS if c != "Changed_Credit_Limit"]
    return f"""
SELECT f.Customer_ID, Num_Bank_Accounts, Num_Credit_Card, Interest_Rate, Delay_from_due_date, Num_Credit_Inquiries,
  Payment_of_Min_Amount, {_whitelisted('Payment_Behaviour', PAYMENT_BEHAVIOURS)},
  {_whitelisted('Credit_Mix', CREDIT_MIXES)}, {keep}
  {', '.join(plain)},
  coalesce(CAST(Changed_Credit_Limit AS DOUBLE), m.median) AS Changed_Credit_Limit, f.snapshot_date,
  {late_days} AS days_overdue_per_late_payment,
  {HISTORY_YEARS} AS Credit_History_Age_num,
  {_divided('Outstanding_Debt', 'Annual_Income')} AS debt_to_income_ratio,
  {_divided('Total_EMI_per_month', 'Monthly_Inhand_Salary')} AS monthly_repayment_to_income,
  {_divided('Num_Credit_Inquiries', HISTORY_YEARS)} AS credit_inquiries_per_year,
  {_loan_counts(-1)}
FROM numeric_financials f LEFT JOIN (
  SELECT snapshot_date, CAST(quantile_disc(Changed_Credit_Limit, 0.5) AS DOUBLE) AS median
  FROM numeric_financials GROUP BY 1) m ON f.snapshot_date = m.snapshot_date"""


def _silver_attributes(age: str) -> str:
    return f"""
SELECT Customer_ID, SSN,
  CASE WHEN trim(Occupation) IS NULL OR regexp_full_match(trim(Occupation), '_*|None') THEN 'Unknown'
       ELSE trim(Occupation) END AS Occupation, snapshot_date,
  CASE WHEN TRY_CAST({age} AS INT) BETWEEN 0 AND 150 THEN TRY_CAST({age} AS INT) ELSE 150 END AS Age_num,
  CASE WHEN TRY_CAST({age} AS INT) BETWEEN 0 AND 150 THEN 0 ELSE 1 END AS Age_missing
FROM attributes"""


_MEAN_5 = " + ".join(f"CAST(fe_{i} AS FLOAT)" for i in range(1, 6))

CTES = {
    **{name: plain_sql(name) for name in ("loans", "clickstream", "attributes", "financials", "monthly_features")},
    "silver_loans": _silver_loans(MISSED),
    "silver_loans_fixed": _silver_loans(
        f"CASE WHEN overdue_amt > 0 AND coalesce(due_amt, 0) = 0 THEN 1 ELSE {MISSED} END"
    ),
    "label_store": """
SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def, snapshot_date
FROM silver_loans WHERE mob = 6""",
    "silver_clicks": f"""
SELECT {', '.join(f'CAST({c} AS FLOAT) AS {c}' for c in CLICKS)}, Customer_ID, snapshot_date,
  CAST(CAST({_MEAN_5} AS DOUBLE) / 5 AS FLOAT) AS fe_1_5_mean
FROM clickstream""",
    "silver_attributes": _silver_attributes("Age"),
    "silver_attributes_fixed": _silver_attributes("replace(Age, '_', '')"),
    "numeric_financials": f"""
SELECT * REPLACE ({', '.join(f"TRY_CAST(replace({c}, '_', '') AS FLOAT) AS {c}" for c in DIRTY_NUMBERS)})
FROM financials""",
    "silver_financials": _silver_financials(LATE_DAYS),
    "silver_financials_v1": _silver_financials(LATE_DAYS_V1, keep="Type_of_Loan,"),
    "static": """
SELECT a.*, f.* EXCLUDE (Customer_ID, snapshot_date)
FROM silver_attributes a LEFT JOIN silver_financials f
  ON a.Customer_ID = f.Customer_ID AND a.snapshot_date = f.snapshot_date""",
    "gold_v2": """
SELECT c.*, s.* EXCLUDE (Customer_ID, snapshot_date)
FROM silver_clicks c LEFT JOIN static s ON c.Customer_ID = s.Customer_ID
UNION ALL BY NAME
SELECT * FROM static s WHERE NOT EXISTS (
  SELECT 1 FROM silver_clicks c WHERE c.Customer_ID = s.Customer_ID AND c.snapshot_date = s.snapshot_date)""",
    "first_label": """
SELECT Customer_ID, label FROM (
  SELECT Customer_ID, label,
    row_number() OVER (PARTITION BY Customer_ID ORDER BY snapshot_date, loan_id, label) AS position
  FROM label_store) WHERE position = 1""",
    "training_labels": f"""
SELECT *, snapshot_date >= {TRAIN_DATE} - INTERVAL 2 MONTH AS late,
  md5(concat('88|', loan_id, '|', CAST(snapshot_date AS STRING))) AS hash
FROM label_store WHERE snapshot_date BETWEEN {TRAIN_DATE} - INTERVAL 14 MONTH AND {TRAIN_DATE} - INTERVAL 1 DAY""",
    "training_rows": """
SELECT l.* EXCLUDE (late, hash), m.fe_1, m.fe_2, m.fe_3, CAST(m.fe_4 AS BIGINT) AS fe_4, m.fe_5,
  CASE WHEN late THEN 'oot'
       WHEN rank() OVER (PARTITION BY late, label ORDER BY hash) <= round(0.8 * count(*) OVER (PARTITION BY late, label)) THEN 'train'
       ELSE 'test' END AS split
FROM training_labels l LEFT JOIN monthly_features m
  ON l.Customer_ID = m.Customer_ID AND l.snapshot_date = m.snapshot_date""",
}

PARENTS = {
    "silver_loans": ["loans"],
    "silver_loans_fixed": ["loans"],
    "label_store": ["silver_loans"],
    "silver_clicks": ["clickstream"],
    "silver_attributes": ["attributes"],
    "silver_attributes_fixed": ["attributes"],
    "numeric_financials": ["financials"],
    "silver_financials": ["numeric_financials"],
    "silver_financials_v1": ["numeric_financials"],
    "static": ["silver_attributes", "silver_financials"],
    "gold_v2": ["silver_clicks", "static"],
    "first_label": ["label_store"],
    "training_labels": ["label_store"],
    "training_rows": ["training_labels", "monthly_features"],
}


def _rates(features: str, bin_case: str, domain: list[str], outcome: str = "label_store", where: str = "TRUE") -> str:
    """Mean label per bin over all pairs of a feature row and a label, on the whole domain."""
    bins = ", ".join(f"({i}, '{b}')" for i, b in enumerate(domain))
    return _with(
        f"""
SELECT d.bin_order, d.bin, round(r.rate * 100, 6) AS default_rate_pct
FROM (VALUES {bins}) d(bin_order, bin) LEFT JOIN (
  SELECT {bin_case} AS bin, avg(l.label) AS rate
  FROM {features} f JOIN {outcome} l ON f.Customer_ID = l.Customer_ID
  WHERE {where} GROUP BY 1) r ON d.bin = r.bin
ORDER BY 1""",
        features,
        outcome,
    )


def _inquiry_case(middle: str) -> str:
    rate = f"coalesce({_divided('Num_Credit_Inquiries', 'Credit_History_Age_num')}, 0)"
    zero, few, many = INQUIRY_BINS
    return f"CASE WHEN {rate} = 0 THEN '{zero}' WHEN {middle.format(rate=rate)} THEN '{few}' ELSE '{many}' END"


def _emi_case(edges: list[str], bins: list[str]) -> str:
    burden = f"coalesce({_divided('Total_EMI_per_month', 'Monthly_Inhand_Salary')}, 0)"
    arms = " ".join(f"WHEN {burden} < {e}::DOUBLE THEN '{b}'" for e, b in zip(edges, bins))
    return f"CASE {arms} ELSE '{bins[-1]}' END"


DTI = f"CAST(CAST({_divided('Outstanding_Debt', 'Annual_Income')} AS FLOAT) AS DOUBLE)"
DTI_CASE = (
    f"CASE WHEN {DTI} < 0 THEN NULL "
    + " ".join(f"WHEN {DTI} <= {e}::DOUBLE THEN '{b}'" for e, b in zip(["0.05", "0.1", "0.15", "0.2"], DTI_BINS))
    + f" ELSE '{DTI_BINS[-1]}' END"
)
DELAY = (
    "CASE WHEN Num_of_Delayed_Payment > 0 "
    "THEN CAST(Delay_from_due_date AS DOUBLE) / CAST(Num_of_Delayed_Payment AS DOUBLE) ELSE 0 END"
)
DELAY_CASE = (
    "CASE " + " ".join(f"WHEN {DELAY} < {e} THEN '{b}'" for e, b in zip([7, 15, 30], DELAY_BINS))
    + f" ELSE '{DELAY_BINS[-1]}' END"
)


def _medians(table: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT snapshot_date, '{c}' AS \"column\", CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median "
        f"FROM {table} WHERE {c} IS NOT NULL GROUP BY 1"
        for c in columns
    )


def _imputed(c: str) -> str:
    return f"coalesce(CAST({c} AS DOUBLE), CAST(quantile_disc({c}, 0.5) OVER (PARTITION BY snapshot_date) AS DOUBLE)) AS {c}"


def _gold_v1() -> str:
    """Full joins written out: rows of each side on common keys, with the sides in order."""
    return _with(
        """
SELECT * FROM silver_clicks
FULL JOIN silver_financials_v1 USING (Customer_ID, snapshot_date)
FULL JOIN silver_attributes USING (Customer_ID, snapshot_date)""",
        "silver_clicks",
        "silver_financials_v1",
        "silver_attributes",
    )


def _profile() -> str:
    arms = "\nUNION ALL\n".join(
        f"SELECT {i} AS period_num, CAST(c.fe_{i} AS DOUBLE) AS v, l.label "
        "FROM silver_clicks c JOIN label_store l ON c.Customer_ID = l.Customer_ID"
        for i in range(1, 21)
    )
    return _with(
        f"""
SELECT period_num, round(coalesce(avg(v) FILTER (WHERE label = 0), 0), 6) AS "Non-Default",
  round(coalesce(avg(v) FILTER (WHERE label = 1), 0), 6) AS "Default"
FROM ({arms}) GROUP BY 1 ORDER BY 1""",
        "silver_clicks",
        "label_store",
    )


def _scaled() -> str:
    z = ", ".join(
        f"round((CAST(fe_{i} AS DOUBLE) - m_{i}) / CASE WHEN s_{i} = 0 THEN 1 ELSE s_{i} END, 6) AS fe_{i}"
        for i in range(1, 6)
    )
    stats = ", ".join(f"avg(CAST(fe_{i} AS DOUBLE)) AS m_{i}, stddev_pop(CAST(fe_{i} AS DOUBLE)) AS s_{i}" for i in range(1, 6))
    return _with(
        f"""
SELECT loan_id, Customer_ID, snapshot_date, label, split, {z}
FROM training_rows, (SELECT {stats} FROM training_rows WHERE split = 'train')""",
        "training_rows",
    )


AUC = """
SELECT split, round(area, 6) AS auc, round(2 * area - 1, 3) AS gini FROM (
  SELECT split, (sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)))::DOUBLE AS area FROM (
    SELECT split, pos, neg, sum(neg) OVER (PARTITION BY split ORDER BY score) - neg AS below FROM (
      SELECT split, coalesce(fe_2, 0) AS score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg
      FROM training_rows GROUP BY 1, 2)) GROUP BY 1)
UNION ALL SELECT 'defaults', NULL, NULL UNION ALL SELECT 'empty', NULL, NULL"""


def _counts(source: str) -> str:
    return _with(f"SELECT snapshot_date, count(*) AS row_count FROM {source} GROUP BY 1", source)


def _loan_keys(where: str) -> str:
    return _with(f"SELECT loan_id, Customer_ID, snapshot_date, installment_num FROM loans WHERE {where}", "loans")


# Columns of the sources in the order of their SQL.
_ATTRIBUTE_COLUMNS = "Customer_ID Age SSN Occupation snapshot_date"
_FINANCIAL_COLUMNS = (
    "Customer_ID Num_Bank_Accounts Num_Credit_Card Interest_Rate Delay_from_due_date Num_Credit_Inquiries Payment_of_Min_Amount "
    "Payment_Behaviour Credit_Mix Type_of_Loan Annual_Income Monthly_Inhand_Salary Num_of_Loan Num_of_Delayed_Payment "
    "Changed_Credit_Limit Outstanding_Debt Credit_Utilization_Ratio Total_EMI_per_month Amount_invested_monthly Monthly_Balance "
    "Credit_History_Age snapshot_date"
)
_LOAN_COLUMNS = (
    "loan_id Customer_ID loan_start_date tenure installment_num loan_amt due_amt paid_amt overdue_amt balance snapshot_date"
)


def _inferred(sources: dict[str, str]) -> str:
    """Every value of every column as a row with its rung; then types by column."""
    values = "\n  UNION ALL\n  ".join(
        f"SELECT '{source}' AS source, {position} AS position, '{c}' AS name, nullif(trim(CAST({c} AS VARCHAR)), '') AS v FROM {source}"
        for source, columns in sources.items()
        for position, c in enumerate(columns.split(), 1)
    )
    return _with(
        f"""SELECT source, CAST(position AS INT) AS position, name AS "column",
  CASE WHEN max(rung) IS NULL OR max(rung) = 6 OR (min(rung) < 4 AND max(rung) > 3) THEN 'string'
       ELSE ['int', 'bigint', 'double', 'date', 'timestamp'][max(rung)] END AS type,
  count(v) AS n_values, count(*) - count(v) AS n_missing,
  CASE WHEN min(rung) < max(rung) THEN arg_min(v, (-rung, v)) END AS widened_by
FROM (
SELECT *, CASE
  WHEN v IS NULL THEN NULL
  WHEN regexp_full_match(v, '[+-]?[0-9]+') AND TRY_CAST(v AS INT) IS NOT NULL THEN 1
  WHEN regexp_full_match(v, '[+-]?[0-9]+') AND TRY_CAST(v AS BIGINT) IS NOT NULL THEN 2
  WHEN regexp_full_match(v, '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN 3
  WHEN regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST(v AS DATE) IS NOT NULL THEN 4
  WHEN regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[ T][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}([.][0-9]{{1,6}})?')
    AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL THEN 5
  ELSE 6 END AS rung
FROM (
  {values}))
GROUP BY 1, 2, 3""",
        *sources,
    )


def _report(table: str, columns: str) -> str:
    return _with(
        "\nUNION ALL\n".join(
            f"""SELECT {position} AS position, '{c}' AS "column",
  CASE typeof(any_value({c})) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(typeof(any_value({c}))) END AS type,
  count({c}) AS n_present, count(*) - count({c}) AS n_null FROM {table}"""
            for position, c in enumerate(columns.split(), 1)
        ),
        table,
    )


_FINANCIAL_SILVER = _with("SELECT * FROM silver_financials", "silver_financials")
_GOLD_V2 = _with("SELECT * FROM gold_v2", "gold_v2")
_LABELS = _with("SELECT * FROM label_store", "label_store")
_ATTRIBUTES = _with("SELECT * FROM silver_attributes", "silver_attributes")


def _numeric(select: str) -> str:
    return _with(f"SELECT Customer_ID, {select} FROM numeric_financials", "numeric_financials")


def _outcome(outcome: str) -> str:
    return _with(
        f"""SELECT f.Customer_ID, Annual_Income, Outstanding_Debt, l.label AS "default", l.labels
FROM numeric_financials f JOIN (
  SELECT Customer_ID, label, count(*) AS labels FROM {outcome} GROUP BY 1, 2) l ON f.Customer_ID = l.Customer_ID""",
        "numeric_financials",
        outcome,
    )


def _boosted(trees: int, depth: int, step: float, weight: float, gamma: float, alpha: float, lam: float) -> str:
    """Boosted trees in SQL, split by split: every cut of every feature, missing values on either side."""
    unit, features = 1 << 24, range(1, 6)
    soft = lambda g: f"greatest(abs({g}) - {alpha}, 0)"
    score = lambda g, h: f"({soft(g)} * {soft(g)} / ({h} + {lam}))"
    code = "CASE s.f " + " ".join(f"WHEN {f} THEN c{f}" for f in features) + " END"
    steps = [
        "keyed AS MATERIALIZED (SELECT *, row_number() OVER () AS rid FROM training_rows)",
        "points AS (" + " UNION ALL ".join(f"SELECT {f} AS f, CAST(fe_{f} AS DOUBLE) AS v FROM keyed WHERE split = 'train' AND fe_{f} IS NOT NULL" for f in features) + ")",
        "ranked AS (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) AS place, count(*) OVER (PARTITION BY f) AS n FROM points)",
        "edges AS MATERIALIZED (SELECT DISTINCT f, v FROM ranked JOIN range(1, 64) t(i) ON place = ceil(i * n / 64.0))",
        "m0 AS MATERIALIZED (SELECT rid, split = 'train' AS seen, CAST(label AS DOUBLE) AS y, 0.0::DOUBLE AS m, "
        + ", ".join(f"CASE WHEN fe_{f} IS NULL THEN 0 ELSE 1 + (SELECT count(*) FROM edges WHERE f = {f} AND v < fe_{f}) END AS c{f}" for f in features)
        + " FROM keyed)",
    ]
    for t in range(trees):
        steps.append(
            f"r{t}_0 AS MATERIALIZED (SELECT * EXCLUDE (p), round((p - y) * {unit})::BIGINT AS g, round(p * (1 - p) * {unit})::BIGINT AS h, 1 AS node"
            f" FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM m{t}))"
        )
        for level in range(depth):
            rows, sums = f"r{t}_{level}", f"h{t}_{level}"
            one = " UNION ALL ".join(f"SELECT node, {f} AS f, c{f} AS code, sum(g) AS g, sum(h) AS h FROM {rows} WHERE seen GROUP BY ALL" for f in features)
            steps.append(f"{sums} AS MATERIALIZED ({one})")
            steps.append(
                f"""s{t}_{level} AS MATERIALIZED (
  SELECT node, f, cut, side FROM (
    SELECT *, 0.5 * ({score("gl", "hl")} + {score("(gt - gl)", "(ht - hl)")} - {score("gt", "ht")}) - {gamma} AS gain FROM (
      SELECT node, f, cut, side, gt, ht, (a + side * g0) / {unit}.0::DOUBLE AS gl, (b + side * h0) / {unit}.0::DOUBLE AS hl FROM (
        SELECT n.node, n.f, n.cut, gt, ht, g0, h0,
          sum(coalesce(x.g, 0)) OVER w AS a, sum(coalesce(x.h, 0)) OVER w AS b
        FROM (SELECT node, f, cut, sum(g) / {unit}.0::DOUBLE AS gt, sum(h) / {unit}.0::DOUBLE AS ht,
                coalesce(sum(g) FILTER (code = 0), 0) AS g0, coalesce(sum(h) FILTER (code = 0), 0) AS h0
              FROM {sums}, range(1, 65) c(cut) GROUP BY ALL) n
        LEFT JOIN {sums} x ON x.node = n.node AND x.f = n.f AND x.code = n.cut
        WINDOW w AS (PARTITION BY n.node, n.f ORDER BY n.cut)), range(0, 2) d(side)))
  WHERE hl >= {weight} AND ht - hl >= {weight} AND gain > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, cut, side DESC) = 1)"""
            )
            left = f"CASE WHEN {code} = 0 THEN s.side = 1 ELSE {code} <= s.cut END"
            steps.append(
                f"r{t}_{level + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node), CASE WHEN s.f IS NULL THEN r.node WHEN {left} THEN 2 * r.node ELSE 2 * r.node + 1 END AS node"
                f" FROM {rows} r LEFT JOIN s{t}_{level} s ON r.node = s.node)"
            )
        last = f"r{t}_{depth}"
        steps.append(
            f"w{t} AS MATERIALIZED (SELECT node, -(sign(g) * {soft('g')}) / (h + {lam}) * {step} AS w"
            f" FROM (SELECT node, sum(g) / {unit}.0::DOUBLE AS g, sum(h) / {unit}.0::DOUBLE AS h FROM {last} WHERE seen GROUP BY node))"
        )
        steps.append(f"m{t + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (g, h, node, m), m + w AS m FROM {last} r JOIN w{t} USING (node))")
    first = _with("", "training_rows").rstrip()
    chain = ",\n".join(steps)
    return f"""{first},
{chain}
SELECT loan_id, Customer_ID, snapshot_date, split, round(1 / (1 + exp(-m)), 9) AS score FROM keyed JOIN m{trees} USING (rid)"""


ORACLES: dict[str, str] = {
    "loan_delinquency": _with("SELECT * FROM silver_loans", "silver_loans"),
    "loan_delinquency_fixed": _with("SELECT * FROM silver_loans_fixed", "silver_loans_fixed"),
    "default_labels": _LABELS,
    "label_backfill": _LABELS,
    "bad_rate_by_mob": _with(
        """
SELECT mob, round(avg(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END), 8) AS bad_rate
FROM silver_loans WHERE loan_start_date < DATE '2000-01-01' GROUP BY 1 ORDER BY 1""",
        "silver_loans",
    ),
    "default_rate_over_time": _with(
        """
SELECT s.month, round(r.rate, 8) AS default_rate
FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS DATE) AS month) s
LEFT JOIN (SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS month, avg(label) AS rate
           FROM label_store GROUP BY 1) r ON s.month = r.month ORDER BY 1""",
        "label_store",
    ),
    "month_spine": _with(
        """
SELECT CAST(unnest(generate_series(date_trunc('month', a), b, INTERVAL 1 MONTH)) AS DATE) AS snapshot_date
FROM (SELECT min(snapshot_date) AS a, max(snapshot_date) AS b FROM loans)""",
        "loans",
    ),
    "snapshot_counts": _counts("loans"),
    "snapshot_extract": _loan_keys("snapshot_date = DATE '2000-03-01'"),
    "snapshot_ingest": _loan_keys("snapshot_date = DATE '2000-03-01'"),
    "date_range": _loan_keys("snapshot_date BETWEEN DATE '2000-07-01' AND DATE '2001-08-31'"),
    "bronze_backfill": _counts("loans"),
    "unpublished_rewrite": _counts("loans"),
    "rerun_backfill": _with(
        "SELECT snapshot_date, count(*) AS row_count FROM loans WHERE snapshot_date <> DATE '2000-03-01' GROUP BY 1", "loans"
    ),
    "csv_source": _ATTRIBUTES,
    "streamed_csv": _ATTRIBUTES,
    "stored_counts": _with(
        """SELECT snapshot_date, count(*) AS row_count, min(loan_start_date) AS min_loan_start_date, max(loan_start_date) AS max_loan_start_date,
  min(installment_num) AS min_installment_num, max(installment_num) AS max_installment_num FROM loans GROUP BY 1""",
        "loans",
    ),
    "inferred_types": _inferred({"attributes": _ATTRIBUTE_COLUMNS, "financials": _FINANCIAL_COLUMNS, "loans": _LOAN_COLUMNS}),
    "schema_report": _report("numeric_financials", _FINANCIAL_COLUMNS),
    "first_complete_rows": _with(
        """SELECT Customer_ID, snapshot_date, Type_of_Loan, Num_of_Delayed_Payment FROM financials
WHERE Type_of_Loan IS NOT NULL AND Num_of_Delayed_Payment IS NOT NULL ORDER BY Customer_ID, snapshot_date LIMIT 25""",
        "financials",
    ),
    "mixed_bronze": """
SELECT snapshot_date, count(*) AS row_count FROM (
  SELECT CAST(ts AS DATE) AS snapshot_date FROM events
  UNION ALL
  SELECT CAST(ts AS DATE) FROM events
  WHERE event_type = 'view' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20') GROUP BY 1""",
    "final_instalments": _with(
        "SELECT loan_id, Customer_ID, snapshot_date, mob, dpd FROM silver_loans WHERE installment_num = 7", "silver_loans"
    ),
    "streamed_bronze": "SELECT CAST(ts AS DATE) AS snapshot_date, count(*) AS row_count FROM events GROUP BY 1",
    "changed_snapshot": _with(
        """
SELECT unnest(['bronze/financials', 'silver/financials', 'gold/feature_store']) AS table_name, DATE '2024-01-08' AS snapshot_date
UNION SELECT 'gold/feature_store', snapshot_date FROM clickstream
WHERE Customer_ID IN (SELECT Customer_ID FROM financials WHERE snapshot_date = DATE '2024-01-08')""",
        "clickstream",
        "financials",
    ),
    "feature_backfill": _GOLD_V2,
    "clickstream_silver": _with("SELECT * FROM silver_clicks", "silver_clicks"),
    "attributes_silver": _ATTRIBUTES,
    "attributes_silver_fixed": _with("SELECT * FROM silver_attributes_fixed", "silver_attributes_fixed"),
    "financials_silver": _FINANCIAL_SILVER,
    "financials_silver_v1": _with("SELECT * FROM silver_financials_v1", "silver_financials_v1"),
    "financials_numeric": _numeric("snapshot_date, " + ", ".join(DIRTY_NUMBERS)),
    "median_imputation": _numeric(
        f"snapshot_date, {_imputed('Changed_Credit_Limit')}, {_imputed('Num_of_Delayed_Payment')}"
    ),
    "snapshot_medians": _with(_medians("numeric_financials", DIRTY_NUMBERS), "numeric_financials"),
    "loan_amount_medians": _with(_medians("silver_loans", ["loan_amt", "due_amt", "balance"]), "silver_loans"),
    "category_whitelist": _with(
        f"""SELECT Customer_ID, {_whitelisted('Payment_Behaviour', PAYMENT_BEHAVIOURS)},
  {_whitelisted('Credit_Mix', CREDIT_MIXES)} FROM financials""",
        "financials",
    ),
    "history_age_years": _with(
        f"SELECT Customer_ID, {HISTORY_YEARS} AS Credit_History_Age_num FROM financials", "financials"
    ),
    "late_payment_days": _numeric(f"{LATE_DAYS} AS days_overdue_per_late_payment"),
    "late_payment_days_fixed": _numeric(f"{LATE_DAYS_FIXED} AS days_overdue_per_late_payment"),
    "late_payment_days_v1": _numeric(f"{LATE_DAYS_V1} AS days_overdue_per_late_payment"),
    "income_ratios": _with(
        """SELECT Customer_ID, debt_to_income_ratio, monthly_repayment_to_income, credit_inquiries_per_year
FROM silver_financials""",
        "silver_financials",
    ),
    "loan_type_counts": _with(f"SELECT Customer_ID, {_loan_counts(-1)} FROM financials", "financials"),
    "loan_type_counts_fixed": _with(f"SELECT Customer_ID, {_loan_counts(0)} FROM financials", "financials"),
    "static_features": _with("SELECT * FROM static", "static"),
    "gold_features_v1": _gold_v1(),
    "gold_features_v2": _GOLD_V2,
    "complete_rows": _with("SELECT * FROM gold_v2 WHERE COLUMNS(*) IS NOT NULL", "gold_v2"),
    "default_rate_by_dti": _rates("numeric_financials", DTI_CASE, DTI_BINS, "first_label", "Annual_Income > 0"),
    "default_rate_by_delay": _rates("numeric_financials", DELAY_CASE, DELAY_BINS),
    "default_rate_by_inquiry": _rates("silver_financials", _inquiry_case("{rate} BETWEEN 1 AND 2"), INQUIRY_BINS),
    "default_rate_by_inquiry_fixed": _rates("silver_financials", _inquiry_case("{rate} < 3"), INQUIRY_BINS),
    "default_rate_by_emi": _rates("numeric_financials", _emi_case(["0.2", "0.4", "0.5"], EMI_BINS), EMI_BINS),
    "default_rate_by_emi_v1": _rates("numeric_financials", _emi_case(["0.2", "0.3", "0.5"], EMI_BINS_V1), EMI_BINS_V1),
    "feature_profile": _profile(),
    "features_with_outcome": _outcome("label_store"),
    "features_with_first_outcome": _outcome("first_label"),
    "train_calendar": _with(
        """
SELECT DISTINCT snapshot_date,
  CAST(snapshot_date - INTERVAL 14 MONTH AS DATE) AS train_test_start_date,
  CAST(snapshot_date - INTERVAL 2 MONTH - INTERVAL 1 DAY AS DATE) AS train_test_end_date,
  CAST(snapshot_date - INTERVAL 2 MONTH AS DATE) AS oot_start_date,
  CAST(snapshot_date - INTERVAL 1 DAY AS DATE) AS oot_end_date
FROM loans""",
        "loans",
    ),
    "training_set": _with("SELECT * FROM training_rows", "training_rows"),
    "stratified_split": _with(
        "SELECT split, label, count(*) AS row_count FROM training_rows GROUP BY 1, 2", "training_rows"
    ),
    "split_stats": _with(
        "SELECT split, count(*) AS row_count, round(avg(label), 8) AS default_rate FROM training_rows GROUP BY 1",
        "training_rows",
    ),
    "scaled_features": _scaled(),
    "auc_gini": _with(AUC, "training_rows"),
    "boosted_scores": _boosted(trees=3, depth=2, step=0.3, weight=2, gamma=0.05, alpha=0.5, lam=1.5),
    "model_metrics": _with(
        f"""
SELECT 'credit_model_2001_09_01' AS model_version, {TRAIN_DATE} AS train_date,
  DATE '2000-07-01' AS train_test_start_date, DATE '2001-06-30' AS train_test_end_date,
  DATE '2001-07-01' AS oot_start_date, DATE '2001-08-31' AS oot_end_date,
  split, count(*) AS row_count, round(avg(label), 2) AS default_rate, 1 AS same_after_reload
FROM training_rows GROUP BY split""",
        "training_rows",
    ),
    "train_and_score": _with(
        """
SELECT Customer_ID, snapshot_date, 'credit_model_2001_09_01' AS model_name, 1 AS in_range FROM monthly_features""",
        "monthly_features",
    ),
}
