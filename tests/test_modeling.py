import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.calendar import training_windows
from riskmart.operators import modeling, scoring
from riskmart.plans import jobs
from riskmart.session import scratch_path
from riskmart.sources import store
from tests.rows import frame, values

TRAIN_DATE = "2024-09-01"
SMALL = {"draws": 2, "folds": 2, "grid": {"maxIter": [2, 3], "maxDepth": [2], "stepSize": [0.1]}}


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    months = [date(2023 + m // 12, m % 12 + 1, 1) for m in range(5, 21)]
    labels, features = [], []
    for i in range(600):
        day, customer = rng.choice(months), f"c{i}"
        signal = rng.gauss(0, 1)
        labels.append((f"l{i}", customer, int(signal + rng.gauss(0, 0.5) > 0), "30dpd_6mob", day))
        if i % 10:
            features.append((signal, rng.choice([None, 1.0, 2.0]), 7.0, customer, day))
    return (
        frame(spark, "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date", *labels),
        frame(spark, "fe_1 double, fe_2 double, fe_3 double, Customer_ID string, snapshot_date date", *features),
    )


@pytest.fixture(scope="module")
def banked(spark, tables):
    bank = scratch_path(spark, "bank")
    return bank, jobs.train_model(*tables, TRAIN_DATE, bank, **SMALL)


def test_training_set_keeps_labels_without_features(tables):
    labels, features = tables
    data = modeling.training_set(labels, features, TRAIN_DATE)
    assert data.count() == store.between(labels, "2023-07-01", "2024-08-31").count()
    assert data.filter(F.col("fe_1").isNull()).count() > 0
    by_split = {r["split"]: r for r in data.groupBy("split").agg(F.min("snapshot_date"), F.max("snapshot_date")).collect()}
    assert tuple(by_split["oot"])[1:] == (date(2024, 7, 1), date(2024, 8, 1))
    assert by_split["train"][2] <= date(2024, 6, 30)


def test_date_range_reaches_the_scan(spark, tables):
    roots = [scratch_path(spark, n) for n in ("labels", "features")]
    for df, root in zip(tables, roots):
        store.write_snapshots(df, root)
    data = modeling.training_set(*[store.read_table(spark, r) for r in roots], TRAIN_DATE)
    plan = data._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) >= 2
    for scan in scans:
        assert ">= 2023-07-01" in scan[scan.index("PartitionFilters") :]


def test_split_share_by_label(spark):
    rows = spark.range(20_000).select(
        F.col("id").cast("string").alias("loan_id"), F.lit(date(2024, 1, 1)).alias("snapshot_date"), (F.col("id") % 5 == 0).cast("int").alias("label")
    )
    split = modeling.assign_split(rows, training_windows(TRAIN_DATE))
    for row in split.groupBy("label").agg(F.avg((F.col("split") == "train").cast("int")).alias("share")).collect():
        assert row["share"] == 0.8
    assert values(split) == values(modeling.assign_split(rows.repartition(7), training_windows(TRAIN_DATE)))


def _brute_last(rows, share):
    """By label: the hash of the row at round(share * n) in order, null if that is 0."""
    by = {}
    for label, h in rows:
        by.setdefault(label, []).append(h)
    wanted = {label: int(share * len(hs) + 0.5) for label, hs in by.items()}
    return {label: sorted(hs)[wanted[label] - 1] for label, hs in by.items() if wanted[label]}


@pytest.mark.parametrize("share, limit", [(0.0, 1), (0.0004, 1), (0.5, 1), (0.8, 20), (1.0, 1 << 17)])
def test_descent_finds_the_row(spark, monkeypatch, share, limit):
    """With one digit a level the descent has several; no slice holds more rows than the limit, but rows of one hash."""
    monkeypatch.setattr(modeling, "SLICE_ROWS", limit)
    monkeypatch.setattr(modeling, "DIGITS", 1)
    rng = random.Random(3)
    hashes = [f"{rng.getrandbits(128):032x}" for _ in range(4000)] + ["8" * 32] * 300
    rows = [(rng.choice([0, 0, 0, 1, None]), h) for h in hashes] + [(7, "a" * 32)] * 50
    df = frame(spark, "label int, hash string", *rows)
    slices = modeling._slices(df, share).collect()
    assert all(r["n"] <= limit or len(r["lead"]) == modeling.HASH_DIGITS for r in slices)
    if limit == 1 and share == 0.5:
        assert min(len(r["lead"]) for r in slices) >= 3
    assert {r["of_label"]: r["last"] for r in modeling._last_hashes(df, share).collect()} == _brute_last(rows, share)


def test_scaler_uses_population_deviation_and_skips_missing(spark):
    xs = [1.0, 2.0, 4.0, None, float("nan")]
    scaler = modeling.fit_scaler(frame(spark, "fe_1 double, fe_2 double", *[(x, 5.0) for x in xs]), ["fe_1", "fe_2"])
    assert scaler.mean["fe_1"] == pytest.approx(np.mean([1, 2, 4]))
    assert scaler.deviation == {"fe_1": pytest.approx(np.std([1, 2, 4])), "fe_2": 1.0}
    scaled = scaler.apply(frame(spark, "fe_1 double, fe_2 double, k string", (4.0, 5.0, "a"), (None, 6.0, "b")))
    first = scaled.filter("k = 'a'").first()
    assert first["fe_1"] == pytest.approx(1.3363062) and first["fe_2"] == 0.0
    assert scaled.filter("k = 'b'").first()["fe_1"] is None


def test_auc_counts_ties_half(spark):
    scored = frame(spark, "s double, label int", *zip([0.1, 0.4, 0.35, 0.8, 0.4, 0.4, 0.9, 0.2], [0, 0, 1, 1, 1, 0, 1, 1]))
    assert modeling.auc(scored, "s") == pytest.approx(0.666667, abs=1e-6)
    assert modeling.gini(0.75) == 0.5


def test_auc_needs_both_classes(spark):
    positives = frame(spark, "s double, label int", (0.1, 1), (0.9, 1))
    assert modeling.auc(positives, "s") is None and modeling.auc(positives.limit(0), "s") is None
    assert modeling.gini(None) is None


def test_auc_of_many_scores_equals_the_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows = spark.range(20_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("split"),
        F.round(F.rand(1), 3).alias("s"),
        (F.rand(2) < 0.3).cast("double").alias("label"),
    )
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    found = {r["split"]: r["auc"] for r in modeling.auc_by_split(rows, "s").collect()}
    for split, area in found.items():
        evaluator = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="label", numBins=0)
        assert area == pytest.approx(evaluator.evaluate(rows.filter(F.col("split") == split)), abs=1e-9)


def test_draws_are_different_points_of_the_grid():
    from pyspark.ml.classification import GBTClassifier

    points = modeling.draw_params(GBTClassifier(), 20)
    assert len({tuple(sorted((p.name, v) for p, v in point.items())) for point in points}) == 20


def test_model_learns_and_survives_the_bank(spark, tables, banked):
    bank, trained = banked
    card = modeling.load_card(spark, bank, trained.version).first()
    assert trained.version == "credit_model_2024_09_01"
    assert card["auc"]["oot"] > 0.8 and card["gini"]["oot"] == modeling.gini(card["auc"]["oot"])
    assert sum(card["rows"].values()) == modeling.training_set(*tables, TRAIN_DATE).count()
    assert card["oot_end_date"] == date(2024, 8, 31) and card["hp_params"]["maxDepth"] == "2"
    again = modeling.evaluate(modeling.load_model(bank, trained.version), modeling.training_set(*tables, TRAIN_DATE), ["oot"])
    assert again["oot"] == pytest.approx(card["auc"]["oot"])


def test_scoring_a_range_equals_single_snapshots(spark, tables, banked):
    bank, trained = banked
    features, root = tables[1], scratch_path(spark, "scores")
    ranged = jobs.score_range(features, bank, trained.version, root, "2024-01-01", "2024-03-01")
    model = modeling.load_model(bank, trained.version)
    singles = [scoring.score(model, features, trained.version, day, day) for day in ("2024-01-01", "2024-02-01", "2024-03-01")]
    joined = singles[0].unionAll(singles[1]).unionAll(singles[2])
    columns = ["Customer_ID", "snapshot_date", "model_name", "model_predictions"]
    assert joined.columns == columns
    assert values(ranged, *columns) == values(joined) and ranged.count() > 0
    assert ranged.filter(~F.col("model_predictions").between(0, 1)).count() == 0
    rescored = jobs.score_range(features, bank, trained.version, root, "2024-02-01", "2024-02-01")
    assert values(rescored, *columns) == values(singles[1])
    assert values(store.read_table(spark, f"{root}/gold/model_predictions"), *columns) == values(joined)
