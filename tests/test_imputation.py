import math
from datetime import date

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskmart.operators.imputation import impute_median, snapshot_medians
from tests.rows import frame, values

D1, D2 = date(2024, 1, 1), date(2024, 2, 1)


def lower_median(xs):
    known = sorted(np.float32(x) for x in xs if x is not None and not math.isnan(x))
    return float(known[(len(known) - 1) // 2]) if known else None


floats = st.one_of(
    st.none(),
    st.floats(width=32),
    st.sampled_from([0.0, -0.0, 1.0, 1.0000001, -1.0, 1e-45, 3.4e38, -3.4e38, float("inf"), -float("inf")]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([D1, D2]), floats), min_size=1, max_size=40))
def test_median_of_any_floats(spark, rows):
    df = frame(spark, "snapshot_date date, x float", *rows)
    found = {r["snapshot_date"]: r["median"] for r in snapshot_medians(df, ["x"]).collect()}
    for day in (D1, D2):
        assert found.get(day) == lower_median([x for d, x in rows if d == day])


def test_median_of_many_near_values(spark):
    rng = np.random.default_rng(7)
    xs = (1000 + rng.normal(size=4001)).astype(np.float32)
    df = frame(spark, "snapshot_date date, x float", *[(D1, float(x)) for x in xs]).repartition(6)
    assert snapshot_medians(df, ["x"]).first()["median"] == lower_median(xs)


def test_fill_by_snapshot(spark):
    rows = [(D1, 1.0), (D1, 2.0), (D1, 3.0), (D1, 4.0), (D1, None), (D2, 1.0), (D2, None), (D2, 5.0), (D2, 7.0), (D2, 9.0)]
    filled = impute_median(frame(spark, "snapshot_date date, x float", *rows), ["x"])
    assert dict(filled.dtypes)["x"] == "double"
    expected = [(d, x if x is not None else {D1: 2.0, D2: 5.0}[d]) for d, x in rows]
    assert values(filled) == sorted(expected, key=repr)


def test_snapshot_without_values_keeps_nulls(spark):
    filled = impute_median(frame(spark, "snapshot_date date, x float", (D1, None), (D2, 3.0)), ["x"])
    assert values(filled) == sorted([(D1, None), (D2, 3.0)], key=repr)


def test_only_dates_and_floats(spark):
    with pytest.raises(TypeError):
        snapshot_medians(frame(spark, "snapshot_date string, x float", ("a", 1.0)), ["x"])
    with pytest.raises(TypeError):
        snapshot_medians(frame(spark, "snapshot_date date, x double", (D1, 1.0)), ["x"])
