"""Boosted trees against a booster written from the definition, row by row."""

import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.operators import boosting, modeling
from riskmart.session import scratch_path

COLUMNS = ["fe_1", "fe_2", "fe_3"]


def rows_of(n, seed=1):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        x = [rng.gauss(0, 1), rng.choice([None, 0.0, 1.0, 2.0]), rng.random() if i % 7 else float("nan")]
        made.append((f"l{i}", "2024-01-01", *x, float(x[0] + (x[1] or -1) * 0.5 + rng.gauss(0, 1) > 0)))
    return made


def frame(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "loan_id string, snapshot_date string, fe_1 double, fe_2 double, fe_3 double, label double")
    return df.repartition(parts)


def missing(v):
    return v is None or math.isnan(v)


def soft(g, p):
    return math.copysign(max(abs(g) - p.regAlpha, 0), g)


def brute(rows, edges, p):
    """Nested tuples (feature, cut, missing left, left, right) or leaf values; every cut of every feature is tried."""
    x, y = [r[2:5] for r in rows], [r[5] for r in rows]
    margins, trees = [0.0] * len(rows), []

    def score(g, h):
        return soft(g, p) ** 2 / (h + p.regLambda)

    def goes_left(v, cut, side):
        return side if missing(v) else v <= cut

    def build(at, depth, g, h):
        total = sum(g[i] for i in at), sum(h[i] for i in at)
        best, found = 1e-9, None
        for f in range(3) if depth < p.maxDepth else ():
            for cut in [*edges[f], math.inf]:
                for side in (True, False):
                    left = [i for i in at if goes_left(x[i][f], cut, side)]
                    gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                    gr, hr = total[0] - gl, total[1] - hl
                    if min(hl, hr) < p.minChildWeight or len(left) in (0, len(at)):
                        continue
                    gain = 0.5 * (score(gl, hl) + score(gr, hr) - score(*total)) - p.minInfoGain
                    if gain > best + 1e-9:
                        best, found = gain, (f, cut, side, left)
        if found is None:
            return -soft(total[0], p) / (total[1] + p.regLambda) * p.stepSize
        f, cut, side, left = found
        right = sorted(set(at) - set(left))
        return f, cut, side, build(left, depth + 1, g, h), build(right, depth + 1, g, h)

    def value(tree, v):
        while isinstance(tree, tuple):
            tree = tree[3] if goes_left(v[tree[0]], tree[1], tree[2]) else tree[4]
        return tree

    for _ in range(p.maxIter):
        share = [1 / (1 + math.exp(-m)) for m in margins]
        g, h = [s - t for s, t in zip(share, y)], [s * (1 - s) for s in share]
        trees.append(build(list(range(len(rows))), 0, g, h))
        margins = [m + value(trees[-1], v) for m, v in zip(margins, x)]
    return trees, margins


def nested(rows, t, node=1):
    _, _, feature, cut, side, leaf = next(r for r in rows if r[:2] == (t, node))
    return leaf if feature is None else (COLUMNS.index(feature), cut, side, nested(rows, t, 2 * node), nested(rows, t, 2 * node + 1))


def same(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    return a[:3] == b[:3] and same(a[3], b[3]) and same(a[4], b[4]) if isinstance(a, tuple) else abs(a - b) < 1e-5


PLAIN = modeling.Scaler(dict.fromkeys(COLUMNS, 0.0), dict.fromkeys(COLUMNS, 1.0))
PARAMS = [
    boosting.Params(maxIter=4, maxDepth=3, stepSize=0.3),
    boosting.Params(maxIter=7, maxDepth=2, stepSize=0.1, minInfoGain=0.1, minChildWeight=5, regAlpha=1.0, regLambda=2.0),
    boosting.Params(maxIter=3, maxDepth=3, stepSize=0.5, minChildWeight=0.5, regAlpha=0.1, regLambda=1.5),
]


@pytest.mark.parametrize("params", PARAMS)
def test_equals_a_booster_by_definition(spark, monkeypatch, params):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 40)
    monkeypatch.setattr(boosting, "ROUNDS_KEPT", 2)
    rows = rows_of(200)
    data = modeling.binned(frame(spark, rows), COLUMNS)
    model = modeling.fit_trees(data, params, PLAIN)
    want, margins = brute(rows, data.edges, params)
    for t, tree in enumerate(want):
        assert same(nested(model.rows, t), tree), (t, nested(model.rows, t), tree)
    scored = {r["loan_id"]: r["p"] for r in model.probability(frame(spark, rows), "p").collect()}
    walked = {r["loan_id"]: r["walk"] for r in model.walked(frame(spark, rows), ["loan_id"]).collect()}
    for row, m in zip(rows, margins):
        assert scored[row[0]] == pytest.approx(1 / (1 + math.exp(-m)), abs=1e-5)
        assert walked[row[0]] == pytest.approx(scored[row[0]], abs=1e-12)
    if params == PARAMS[0]:  # here splits of both sides occur
        assert {r[4] for r in model.rows} == {True, False, None}


def test_edges_are_quantiles(spark):
    values = [random.Random(3).gauss(0, 1) for _ in range(999)]
    df = spark.createDataFrame([(v, 5.0, None) for v in values], "a double, b double, c double")
    a, b, c = boosting.bin_edges(df, ["a", "b", "c"])
    ordered = sorted(values)
    assert a == sorted({ordered[math.ceil(i * 999 / boosting.BINS) - 1] for i in range(1, boosting.BINS)}) and b == [5.0] and c == []


def grown(spark, rows, fits, parts, **sizes):
    data = modeling.binned(frame(spark, rows, parts), COLUMNS, folds=3)
    return boosting.grow(data.blocks, fits, 3, 42)


def test_trees_do_not_depend_on_partitions_blocks_or_groups(spark, monkeypatch):
    """Nor on what grows beside them; a shorter fit is a prefix of a longer one."""
    rows = rows_of(400, 2)
    one = boosting.Params(maxIter=6, maxDepth=3, subsamplingRate=0.6, featureSubsetStrategy=0.7, regAlpha=0.1)
    fits = [boosting.Fit(replace(one, **change), k) for change in ({}, {"maxDepth": 2}, {"maxIter": 3}, {"stepSize": 0.01}) for k in (-1, 0, 2)]
    together = grown(spark, rows, fits, 1)
    for name, size in (("BLOCK_ROWS", 23), ("FITS_TOGETHER", 5), ("ROUNDS_KEPT", 1)):
        monkeypatch.setattr(boosting, name, size)
    assert grown(spark, rows, fits, 7) == together
    assert grown(spark, rows, [fits[4]], 2) == [together[4]]
    assert together[6] == together[0][:3] and len(together[0]) == 6
    assert together[0] != together[1]


@pytest.mark.parametrize("along", [0, 1_000_000])
def test_the_search_equals_one_fit_after_the_other(spark, monkeypatch, along):
    """Means of areas of held-out rows, each model grown alone on the rows of the other folds."""
    monkeypatch.setattr(modeling, "GROWN_ALONG", along)
    rows = rows_of(600, 5)
    grid = {"maxIter": [2, 4], "maxDepth": [1, 3], "stepSize": [0.3], "subsamplingRate": [0.8], "regLambda": [1, 2]}
    df = frame(spark, rows)
    data = modeling.binned(df, COLUMNS, folds=3)
    search = modeling.search_trees(data, draws=5, folds=3, grid=grid)
    assert len(search.points) == 5 == len({tuple(p.items()) for p in search.points})
    fold = modeling.hash_bucket("42-fold", ["loan_id", "snapshot_date"], 3)
    for point, area in list(zip(search.points, search.areas))[:3]:
        areas = []
        for k in range(3):
            (trees,) = boosting.grow(data.blocks, [boosting.Fit(boosting.Params(**point), k)], 3, 42)
            model = modeling.TreeModel(PLAIN, boosting.tree_rows(trees, COLUMNS, data.edges))
            areas.append(modeling.auc(model.probability(df.filter(fold == k), "p"), "p"))
        assert area == pytest.approx(sum(areas) / 3, abs=1e-9)
    assert search.areas[search.points.index(search.best)] == max(search.areas)
    assert search.trees == boosting.grow(data.blocks, [boosting.Fit(boosting.Params(**search.best))], 3, 42)[0]


def test_the_grid_has_all_points():
    assert math.prod(len(v) for v in modeling.SEARCH_GRID.values()) == 1728
    points = modeling.draw_points(100, modeling.SEARCH_GRID)
    assert len(points) == 100 == len({tuple(p.items()) for p in points}) and points == modeling.draw_points(100, modeling.SEARCH_GRID)


def test_samples_have_their_share():
    hashes = np.random.default_rng(0).integers(0, 2**64, 100_000, dtype=np.uint64)
    a, b = (boosting.sampled(hashes, t, 0.6, 42) for t in (0, 1))
    assert abs(a.mean() - 0.6) < 0.01 and abs((a & b).mean() - 0.36) < 0.01
    assert boosting.sampled(hashes, 0, 1.0, 42).all()
    chosen = [boosting.columns_of(t, 0.6, 10, 42) for t in range(20)]
    assert {len(c) for c in chosen} == {6} and len({tuple(c) for c in chosen}) > 5


def test_one_class_and_no_rows(spark):
    ones = [(*r[:5], 1.0) for r in rows_of(50)]
    for rows in (ones, ones[:1], []):
        data = modeling.binned(frame(spark, rows), COLUMNS, folds=2)
        search = modeling.search_trees(data, 2, 2, {"maxIter": [2], "maxDepth": [2, 3]})
        assert search.areas == [None, None] and search.best == search.points[0]
        model = modeling.fit_trees(data, boosting.Params(maxIter=2), PLAIN)
        assert all(0 <= r["p"] <= 1 for r in model.probability(frame(spark, rows_of(9)), "p").collect())


def test_a_model_of_any_length_scores_and_keeps_columns(spark):
    """Longer than one generated method can be; the caller's columns may begin like the internal ones."""
    data = modeling.binned(frame(spark, rows_of(300, 6)), COLUMNS)
    model = modeling.fit_trees(data, boosting.Params(maxIter=2, maxDepth=3), PLAIN)
    long = modeling.TreeModel(PLAIN, [(2 * k + t, *r) for k in range(100) for t, *r in model.rows])
    df = frame(spark, rows_of(40)).withColumn("_low0", F.lit("mine")).withColumn("a.b", F.lit(1))
    scored = long.probability(df, "p")
    assert scored.columns == [*df.columns, "p"]
    once = {r["loan_id"]: r["p"] for r in model.probability(df, "p").collect()}
    for r in scored.collect():
        p = once[r["loan_id"]]
        assert r["_low0"] == "mine" and r["p"] == pytest.approx(1 / (1 + ((1 - p) / p) ** 100), abs=1e-9)


def test_digest_sees_every_score(spark):
    a = spark.range(1000).select("id", (F.col("id") / 7).alias("s"))
    digest = modeling.score_digest(a, ["id"], "s")
    assert digest == modeling.score_digest(a.repartition(9), ["id"], "s")
    assert digest != modeling.score_digest(a.withColumn("s", F.when(F.col("id") == 500, 0.5).otherwise(F.col("s"))), ["id"], "s")
    assert modeling.score_digest(a.limit(0), ["id"], "s") == "0:0:0"


def test_stored_blocks_can_be_read_again(spark):
    data = modeling.binned(frame(spark, rows_of(100)), COLUMNS)
    again = boosting.store_blocks(data.blocks, scratch_path(spark, "again"))
    fit = [boosting.Fit(boosting.Params(maxIter=2))]
    assert boosting.grow(again, fit, 3, 42) == boosting.grow(data.blocks, fit, 3, 42)


def test_rows_alike_in_bins_share_an_entry(spark, monkeypatch):
    """What a pass reads and keeps margins of grows with the different rows; trees are those of single entries."""
    rng = random.Random(11)
    rows = [(f"l{i}", "2024-01-01", float(rng.randint(0, 3)), rng.choice([None, 1.0]), 0.5, float(rng.random() < 0.3)) for i in range(3000)]
    fits = [boosting.Fit(boosting.Params(maxIter=4, subsamplingRate=s, minChildWeight=0.5), k) for s in (0.6, 1.0) for k in (-1, 1)]
    data = modeling.binned(frame(spark, rows, 5), COLUMNS, folds=3)
    entries = data.blocks.selectExpr("sum(length(label))").first()[0]
    assert data.rows == 3000 and entries <= 2 * 4 * 2 * 2 * 3 * 2  # those cut by a range's end count twice
    together = boosting.grow(data.blocks, fits, 3, 42)
    monkeypatch.setattr(boosting, "HELD_ROWS", 1)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        cut = modeling.binned(frame(spark, rows, 2), COLUMNS, folds=3)
        assert cut.blocks.count() > 400
        assert boosting.grow(cut.blocks, fits, 3, 42) == together
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_walk_makes_no_row_for_each_tree(spark):
    model = modeling.TreeModel(PLAIN, [(t, 1, None, None, None, 0.1) for t in range(50)])
    walk = model.walked(frame(spark, rows_of(20)), ["loan_id"])
    plan = walk._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    assert {round(r["walk"], 9) for r in walk.collect()} == {round(1 / (1 + math.exp(-5.0)), 9)}
