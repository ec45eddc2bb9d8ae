from datetime import date

import pytest
from pyspark.sql import functions as F

from riskmart.functions import cleaning as C
from riskmart.operators import silver
from tests.rows import frame, values


def one(spark, schema, column, *inputs):
    """Results of a column expression, in the order of the inputs."""
    df = frame(spark, f"i int, {schema}", *[(i, *(x if isinstance(x, tuple) else (x,))) for i, x in enumerate(inputs)])
    return [r[0] for r in df.orderBy("i").select(column.alias("v")).collect()]


def test_dirty_numbers(spark):
    found = one(spark, "x string", C.clean_number("x"), "1234.5_", "_", None, "__10000__", "12a", "-3")
    assert found == [1234.5, None, None, 10000.0, None, -3.0]


def test_text_to_int(spark):
    found = one(spark, "x string", C.text_to_int("x"), "28", " 3.0 ", "28_", "", None, "99999999999", "-500")
    assert found == [28, 3, None, None, None, None, -500]


def test_digits_lose_the_sign(spark):
    assert one(spark, "x string", C.digits("x"), "-5", "7.5", "_", None) == [5.0, 7.5, None, None]


def test_whitelist(spark):
    assert one(spark, "x string", C.whitelist("x", C.CREDIT_MIXES), "Good", "_", None) == ["Good", "Unknown", "Unknown"]


def test_category(spark):
    found = one(spark, "x string", C.clean_category("x"), "  Lawyer ", "____", "None", "", None, "None_")
    assert found == ["Lawyer", "Unknown", "Unknown", "Unknown", "Unknown", "None_"]


@pytest.mark.parametrize("strip_first, dirty", [(False, (150, 1)), (True, (28, 0))])
def test_age(spark, strip_first, dirty):
    age, missing = C.clean_bounded_int("x", strip_first=strip_first)
    found = one(spark, "x string", F.struct(age, missing), "28", "28_", "8698", "-500", None, "150", "0")
    assert [tuple(r) for r in found] == [(28, 0), dirty, (150, 1), (150, 1), (150, 1), (150, 0), (0, 0)]


def test_enforce_schema_keeps_other_columns_and_order(spark):
    df = frame(spark, "a string, b string, c string", ("3.0", "x", "2024-01-31"), ("z", None, "nope"))
    typed = C.enforce_schema(df, {"A": "int", "c": "date"})
    assert typed.dtypes == [("A", "int"), ("b", "string"), ("c", "date")]
    assert values(typed) == sorted([(3, "x", date(2024, 1, 31)), (None, None, None)], key=repr)
    with pytest.raises(ValueError):
        C.enforce_schema(df, {"missing": "int"})


def test_complete_rows(spark):
    df = frame(spark, "a int, b string", (1, "x"), (None, "y"), (2, None), (3, "z"))
    assert values(C.complete_rows(df)) == [(1, "x"), (3, "z")]
    assert values(C.complete_rows(df, 1)) == [(1, "x")]
    assert values(C.complete_rows(df, 1, ["b"])) == [(1, "x")]


def test_attributes_pass_other_columns(spark):
    df = frame(
        spark,
        "Customer_ID string, Name string, Age string, SSN string, Occupation string, snapshot_date string",
        ("c1", "Ann", "28", "1", " Lawyer", "2024-01-01"),
    )
    row = silver.attributes(df).first().asDict()
    assert row == {
        "Customer_ID": "c1", "Name": "Ann", "SSN": "1", "Occupation": "Lawyer",
        "snapshot_date": date(2024, 1, 1), "Age_num": 28, "Age_missing": 0,
    }
