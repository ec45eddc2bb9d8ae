import pytest
from pyspark.sql import functions as F

from riskmart.functions import features as X
from tests.test_cleaning import one


def test_duration(spark):
    found = one(spark, "x string", X.parse_duration_years("x"), "22 Years and 1 Months", "5 Years", None, "NA", "1 Year and 6 Month")
    assert found == [pytest.approx(22.083334), None, None, None, 1.5]


def test_late_payment_days(spark):
    rows = [(-5, 2.0), (10, 0.0), (None, None), (10, -1.0), (10, 4.0)]
    schema = "d int, n float"
    assert one(spark, schema, X.days_per_late_payment("d", "n"), *rows) == [2.5, 10.0, 0.0, 10.0, 2.5]
    assert one(spark, schema, X.days_per_late_payment("d", "n", keep_sign=True), *rows) == [0.0, 10.0, 0.0, 10.0, 2.5]
    assert one(spark, schema, X.days_per_late_payment("d", "n", guard=False), *rows) == [-2.5, None, None, -10.0, 2.5]


def test_loan_counts(spark):
    lists = ["Auto Loan, Auto Loan, and Payday Loan", "Something Else", None, "Payday Loan and Payday Loan"]
    counts = X.multi_hot_counts("x")
    found = one(spark, "x string", F.struct(*[c.alias(n) for n, c in counts.items()]), *lists)
    assert (found[0]["Auto_Loan_count"], found[0]["Payday_Loan_count"], found[0]["Unknown_count"]) == (2, 1, 0)
    assert tuple(found[1]) == (0,) * 9 + (1,)
    assert tuple(found[2]) == (-1,) * 9 + (0,)
    assert found[3]["Payday_Loan_count"] == 2
    empty = X.multi_hot_counts("x", on_null=0)
    assert tuple(one(spark, "x string", F.struct(*[c.alias(n) for n, c in empty.items()]), None)[0]) == (0,) * 9 + (1,)


def test_ratio(spark):
    assert one(spark, "a float, b float", X.ratio("a", "b"), (1.0, 2.0), (1.0, 0.0), (None, 1.0), (float("nan"), 1.0)) == [
        0.5, 0.0, 0.0, 0.0,
    ]


def test_row_mean(spark):
    assert one(spark, "a float, b float", X.row_mean(["a", "b"]), (1.0, 2.0), (None, 2.0)) == [1.5, None]


def test_cut_is_right_closed(spark):
    found = one(spark, "x double", X.cut("x", X.DTI_EDGES, X.DTI_BINS), 0.0, 0.05, 0.050001, -0.1, 0.2, 9.0, None, float("inf"))
    assert found == ["<5%", "<5%", "5–10%", None, "15–20%", ">20%", None, ">20%"]


def test_delay_bins_are_left_closed(spark):
    found = one(spark, "x double", X.bin_delay(F.col("x")), -1.0, 6.99, 7.0, 15.0, 30.0, None)
    assert found == ["≤ 6", "≤ 6", "7–14", "15–29", "≥ 30", "≥ 30"]


def test_average_delay(spark):
    assert one(spark, "d int, n float", X.average_delay("d", "n"), (10, 4.0), (10, 0.0), (10, None), (None, 2.0)) == [
        2.5, 0.0, 0.0, None,
    ]


def test_inquiry_bins_have_gaps(spark):
    rates = [0.0, 0.5, 1.0, 2.0, 2.5, 3.0]
    assert one(spark, "x double", X.bin_inquiry(F.col("x")), *rates) == ["0", "3+", "1–2", "1–2", "3+", "3+"]
    assert one(spark, "x double", X.bin_inquiry(F.col("x"), gapless=True), *rates) == ["0", "1–2", "1–2", "1–2", "1–2", "3+"]


def test_emi_bins(spark):
    rates = [0.19, 0.2, 0.35, 0.45, 0.5]
    assert one(spark, "x double", X.bin_emi(F.col("x")), *rates) == ["<20", "20–39", "20–39", "40–49", "≥50"]
    first = X.bin_emi(F.col("x"), X.EMI_EDGES_V1, X.EMI_BINS_V1)
    assert one(spark, "x double", first, *rates) == ["<20", "20–29", "30–49", "30–49", "≥50"]


def test_column_number(spark):
    assert one(spark, "x string", X.column_number("x"), "fe_7", "fe_20", "fe") == [7, 20, None]
