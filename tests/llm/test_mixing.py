import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm import mixing
from riskmart.llm.queries import QUERIES

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("text", T.StringType()), T.StructField("size", T.StringType()), T.StructField("shard", T.StringType())])


def test_targets_by_hand():
    assert mixing.targets([10, 10, 10], [5, 2, 1]) == pytest.approx([20, 25 * 2 / 3, 25 / 3])
    assert mixing.targets([0, 0], [5, 2]) == [0, 0]
    assert mixing.targets([], []) == []
    assert mixing.targets([0, 8], [5, 2]) == pytest.approx([0, 12])
    for seed in range(50):
        rng = random.Random(seed)
        sizes = [rng.choice([0, 1, 10, 1000, 10**6]) for _ in range(rng.randint(1, 9))]
        weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
        got = mixing.targets(sizes, weights)
        assert sum(got) == pytest.approx(1.5 * sum(sizes))
        free = [g / w for g, w, s in zip(got, weights, sizes) if g < 2 * s * (1 - 1e-9)]
        assert all(f == pytest.approx(free[0]) for f in free)
        assert all(g <= 2 * s + 1e-6 and (not free or g / w <= free[0] * (1 + 1e-9)) for g, w, s in zip(got, weights, sizes))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutations(n):
    assert sorted(mixing.permuted(np.arange(n), n, 5)) == list(range(n))
    if n > 16:
        assert list(mixing.permuted(np.arange(n), n, 5)) != list(mixing.permuted(np.arange(n), n, 6))


def test_the_tree_splits_quotas_exactly():
    quotas = (1000, 300, 1, 0, 57)
    for shards in (1, 2, 7, 64):
        offsets = mixing.shard_offsets(quotas, shards, 3)
        assert tuple(offsets[-1]) == quotas and (np.diff(offsets, axis=0) >= 0).all()
        each = np.diff(offsets, axis=0).sum(axis=1)
        assert each.max() - each.min() <= 1
    # A shard's blocks of a source are hypergeometric: mean by share of all blocks.
    first = [np.diff(mixing.shard_offsets(quotas, 4, seed), axis=0)[0, 0] for seed in range(200)]
    assert np.mean(first) == pytest.approx(250, rel=0.03) and np.std(first) > 3


def test_draws_are_made_once_and_by_one_set_of_workers(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    mix = mixing.plan(df, shards=4)
    plan = mixing.mixed(df, mix)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_the_drivers_rows_need_no_task_of_plain_python(spark):
    made = mixing._local(spark, [("a", 1.5), (None, 2.0)], name=mixing.pa.string(), words=mixing.pa.float64())
    assert "ExistingRDD" not in made._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in made.collect()] == [("a", 1.5), (None, 2.0)]


def _rows():
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        source = rng.choice(["hot"] * 6 + ["a", "b", "Z", None, "é", "\U0001f600"])
        text = None if i % 97 == 0 else " ".join(["w"] * rng.randint(0, 30))
        rows.append((i if i % 50 else None, source, text, "x", "y"))
    return rows + [(5000, "empty", "", "x", "y"), (5001, "empty", None, "x", "y")] + [rows[1]] * 3


def test_mix_meets_its_targets(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    plan = mixing.plan(df, shards=7)
    again = mixing.plan(df.repartition(3), shards=7)
    assert plan == again
    sizes = defaultdict(int)
    for _, s, t, _, _ in rows:
        sizes[s] += len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    assert [s.name for s in plan.sources] == order and [s.size for s in plan.sources] == [sizes[s] for s in order]
    got = mixing.draws(df, plan).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.size == len((r.text or "").split()) and r.source_size == sizes[r.source] and len(r.draws) <= 2
        taken[r.source] += r.size * len(r.draws)
    for s in plan.sources:
        assert abs(taken[s.name] - s.target) <= 60
    out = mixing.mixed(df, plan).withColumn("p", F.spark_partition_id()).collect()
    assert Counter((r.doc_id, r.source, r.text) for r in out) == Counter({k: n for k, n in sum((Counter({(r.doc_id, r.source, r.text): len(r.draws)}) for r in got), Counter()).items()})
    assert all(r.p == r.shard for r in out)
    assert [f for f in out[0].__fields__] == ["doc_id", "source", "text", "epoch", "shard", "p"]
    words = Counter()
    for r in out:
        words[r.shard] += len((r.text or "").split())
    assert set(words) == set(range(7)) and max(words.values()) < 1.5 * min(words.values())


def test_blocks_of_shards_are_disjoint_and_complete():
    plan = mixing.Plan((mixing.Source("a", 100, 150.0, 1, mixing._SPACE // 2, 40),), 5, 3)
    quota = plan.sources[0].quota
    offsets = mixing.shard_offsets((quota,), 5, 3)
    place = mixing.permuted(np.arange(quota), quota, 1)
    shard = np.searchsorted(offsets[:, 0], place, side="right") - 1
    assert Counter(shard.tolist()) == Counter({k: int(n) for k, n in enumerate(np.diff(offsets[:, 0])) if n})


def test_empty_and_wordless(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.draws(empty, mixing.plan(empty)).collect() == [] and mixing.mixed(empty, mixing.plan(empty)).collect() == []
    bare = spark.createDataFrame([(1, None, None, None, None)], SCHEMA)
    assert [(r.size, r.target, list(r.draws)) for r in mixing.draws(bare, mixing.plan(bare)).collect()] == [(0, 0.0, [])]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    size = {d.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for d in docs}
    totals = Counter()
    for d in docs:
        totals[d.source] += size[d.doc_id]
    names = sorted(totals)
    want = dict(zip(names, mixing.targets([totals[s] for s in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))])))
    got = {r.doc_id: r for r in QUERIES["op7_mixing"](spark, sf).collect()}
    taken = Counter()
    for d in docs:
        r = got[d.doc_id]
        assert (r.size, r.source_size) == (size[d.doc_id], totals[d.source]) and r.target == pytest.approx(want[d.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[d.source] += r.taken
    for s in names:
        assert abs(taken[s] - want[s]) <= max(size.values()) / 2
    again = {r.doc_id: r.taken for r in QUERIES["op7_mixing"](spark, sf).collect()}
    assert again == {k: r.taken for k, r in got.items()}
