import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from riskmart.functions import features as X
from riskmart.operators import analysis
from tests.rows import frame, values


def days(n):
    return date(2024, 1 + n, 1)


@pytest.fixture(scope="module")
def tables(spark):
    """Customers with several feature rows and labels; one customer holds a third of both."""
    rng = random.Random(11)
    pick = lambda: "hot" if rng.random() < 0.34 else f"c{rng.randrange(30)}"
    features = [
        (pick(), rng.choice([None, 0.0, 1000.0, 20000.0]), rng.choice([None, 0.0, 900.0, 1000.0, 3000.0, 9000.0]),
         rng.choice([None, -5, 3, 30]), rng.choice([None, 0.0, 1.0, 4.0]))
        for _ in range(300)
    ]
    labels = [(f"l{i}", pick(), rng.randrange(2), "30dpd_6mob", days(rng.randrange(6))) for i in range(200)]
    return (
        frame(spark, "Customer_ID string, Annual_Income float, Outstanding_Debt float, Delay_from_due_date int, Num_of_Delayed_Payment float", *features),
        frame(spark, "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date", *labels),
    )


def all_pairs(features, labels, dedup=False):
    outcome = analysis.first_label(labels) if dedup else labels.select("Customer_ID", "label")
    return features.join(outcome.withColumnRenamed("label", "default"), "Customer_ID")


def brute_rates(features, labels, bin_column, dedup=False):
    pairs = all_pairs(features.withColumn("bin", bin_column), labels, dedup)
    return {r["bin"]: r["rate"] for r in pairs.groupBy("bin").agg(F.avg("default").alias("rate")).collect()}


def test_aggregated_join_equals_all_pairs(tables):
    features, labels = tables
    bin_column = X.bin_delay(X.average_delay("Delay_from_due_date", "Num_of_Delayed_Payment"))
    expected = brute_rates(features, labels, bin_column)
    found = {r["bin"]: r["default_rate_pct"] for r in analysis.default_rate_by_delay(features, labels).collect()}
    assert list(found) == X.DELAY_BINS
    for b, rate in found.items():
        assert rate == (None if b not in expected else pytest.approx(expected[b] * 100))


@pytest.mark.parametrize("dedup", [False, True])
def test_outcomes_stand_for_all_pairs(tables, dedup):
    features, labels = tables
    weighted = analysis.with_outcome(features, labels, dedup)
    expanded = weighted.select(*features.columns, "default", F.explode(F.sequence(F.lit(1).cast("long"), "labels"))).drop("col")
    assert values(expanded, *features.columns, "default") == values(all_pairs(features, labels, dedup), *features.columns, "default")
    assert weighted.count() <= 2 * features.count()


def test_dti_uses_one_label_per_customer(tables):
    features, labels = tables
    dti = X.divide("Outstanding_Debt", "Annual_Income").cast("float").cast("double")
    expected = brute_rates(features.filter("Annual_Income > 0"), labels, X.cut(dti, X.DTI_EDGES, X.DTI_BINS), dedup=True)
    found = {r["bin"]: r["default_rate_pct"] for r in analysis.default_rate_by_dti(features, labels).collect()}
    assert list(found) == X.DTI_BINS
    assert {b: r for b, r in found.items() if r is not None} == {
        b: pytest.approx(r * 100) for b, r in expected.items() if b is not None
    }


def test_dti_edge_is_a_32_bit_quotient(spark, tables):
    """1000 / 20000 as a 32-bit float is just above 0.05."""
    labels = frame(spark, "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date", ("l", "c", 1, "x", days(0)))
    features = frame(spark, "Customer_ID string, Annual_Income float, Outstanding_Debt float", ("c", 20000.0, 1000.0))
    found = {r["bin"]: r["default_rate_pct"] for r in analysis.default_rate_by_dti(features, labels).collect()}
    assert found == {"<5%": None, "5–10%": 100.0, "10–15%": None, "15–20%": None, ">20%": None}


def test_first_label_is_the_earliest(spark):
    labels = frame(
        spark,
        "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date",
        ("b", "c", 1, "x", days(1)), ("a", "c", 0, "x", days(2)), ("z", "d", 0, "x", days(0)), ("y", "d", 1, "x", days(0)),
    )
    assert values(analysis.first_label(labels)) == [("c", 1), ("d", 1)]


def test_bad_rate_by_mob(spark):
    rows = frame(
        spark,
        "mob int, dpd int, loan_start_date date",
        (1, 0, days(0)), (1, 30, days(0)), (0, 31, days(0)), (0, 90, date(2025, 1, 1)), (2, None, days(0)),
    )
    cohort = analysis.bad_rate_by_mob(rows, started_before="2024-06-01")
    assert [tuple(r) for r in cohort.collect()] == [(0, 1.0), (1, 0.5), (2, 0.0)]


def test_default_rate_over_time_fills_the_calendar(spark):
    labels = frame(spark, "label int, snapshot_date date", (1, date(2024, 1, 1)), (0, date(2024, 1, 15)), (1, date(2024, 3, 1)))
    found = analysis.default_rate_over_time(labels, "2023-12-01", "2024-03-01").collect()
    assert [(r["month"].month, r["default_rate"]) for r in found] == [(12, None), (1, 0.5), (2, None), (3, 1.0)]


def test_feature_profile_equals_all_pairs(spark, tables):
    _, labels = tables
    rng = random.Random(5)
    clicks = frame(
        spark,
        "Customer_ID string, fe_1 float, fe_2 float",
        *[("hot" if i % 3 == 0 else f"c{rng.randrange(30)}", rng.choice([None, 1.0, 5.0]), float(i)) for i in range(100)],
    )
    pairs = all_pairs(clicks, labels)
    found = analysis.feature_profile(clicks, labels, ["fe_1", "fe_2"]).collect()
    assert [r["period_num"] for r in found] == [1, 2]
    for row in found:
        for column, outcome in (("Non-Default", 0), ("Default", 1)):
            mean = pairs.filter(F.col("default") == outcome).agg(F.avg(f"fe_{row['period_num']}")).first()[0]
            assert row[column] == pytest.approx(mean)


def test_feature_profile_without_an_outcome_is_zero(spark):
    labels = frame(spark, "loan_id string, Customer_ID string, label int", ("l", "c", 0))
    clicks = frame(spark, "Customer_ID string, fe_1 float", ("c", 2.0))
    assert [tuple(r) for r in analysis.feature_profile(clicks, labels, ["fe_1"]).collect()] == [(1, 2.0, 0.0)]


def test_feature_profile_keeps_an_undefined_mean(spark):
    labels = frame(spark, "loan_id string, Customer_ID string, label int", ("l", "c", 0), ("m", "d", 1))
    clicks = frame(spark, "Customer_ID string, fe_1 float", ("c", 2.0), ("d", None))
    assert [tuple(r) for r in analysis.feature_profile(clicks, labels, ["fe_1"]).collect()] == [(1, 2.0, None)]
