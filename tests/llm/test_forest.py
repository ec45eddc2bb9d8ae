import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from riskmart.llm import forest, similar
from riskmart.llm.queries import QUERIES

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("a", T.StringType()), T.StructField("item", T.StringType()), T.StructField("class_id", T.StringType())])


def _set(text):
    words = (text or "").encode().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset([()])


def brute(rows, threshold=0.8):
    """Class and links of each row from all pairs of different sets that share a shingle."""
    sets = sorted({_set(t) for _, t in rows}, key=repr)
    index = {s: i for i, s in enumerate(sets)}
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    shared = Counter()
    for members in where.values():
        for k, a in enumerate(members):
            for b in members[k + 1 :]:
                shared[a, b] += 1
    near = {i: set() for i in range(len(sets))}
    for (a, b), n in shared.items():
        if n / (len(sets[a]) + len(sets[b]) - n) >= threshold:
            near[a].add(b)
            near[b].add(a)
    copies = Counter(index[_set(t)] for _, t in rows)
    root = {}
    for i in near:
        if i in root:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if j not in root:
                root[j] = i
                stack += near[j]
    least = {}
    for key, t in rows:
        r = root[index[_set(t)]]
        if key is not None:
            least[r] = min(key, least.get(r, key))
    out = []
    for key, t in rows:
        i = index[_set(t)]
        out.append((key, least.get(root[i]), sum(copies[j] for j in near[i]) + copies[i] - 1, copies[i] - 1))
    return sorted(map(repr, out))


def rows_of(found):
    return sorted(map(repr, [(r.doc_id, r.class_id, r.n_links, r.n_copies) for r in found.collect()]))


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed=2, hot=0):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(120):
        words = rng.choices(vocabulary, k=rng.choice([3, 6, 12, 60, 150, 300]))
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 3])):
            texts.append(edited(words, rng, rng.choice([1, 2, 4, 8])))
        if rng.random() < 0.3:
            texts += ["  " + " \n ".join(words)] * 2
    base = rng.choices(vocabulary, k=120)
    texts += [edited(base, rng, 1) for _ in range(hot)] + [" ".join(base)] * (hot // 2)
    texts += [None, "", "  \n", "one", "one", "a b c d e f g h", "a b c d e f g h i"]
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, "only null"), (3, texts[3]), (3, "a different text of the same id")]
    rng.shuffle(rows)
    return rows


def test_depth_is_shortened_to_the_recall():
    assert forest.prefix_depth(0.8, 0.998, 12) == 4
    assert forest.prefix_depth(0.8, 0.9999, 12) == 2
    assert forest.prefix_depth(1.0, 0.99, 12) == forest.LONGEST
    with pytest.raises(ValueError):
        forest.prefix_depth(0.1, 0.999, 2)


def test_measured_recall_matches_the_chance():
    rng = np.random.default_rng(1)
    met = 0
    for _ in range(400):
        shared = rng.integers(0, 1 << 63, 80, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, 10, dtype=np.uint64)])) for _ in range(2))
        nodes = forest.prefixes([a, b], 6, 8)
        met += (nodes[0] == nodes[1]).any()
    assert met / 400 == pytest.approx(forest.recall_at(0.8, 6, 8), abs=0.06)


def test_matches_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(k, t, "x", "y", "z") for k, t in rows], SCHEMA).repartition(6)
    assert rows_of(forest.near_copies(df)) == brute(rows)


def test_crowded_nodes_are_cut_into_blocks(spark, monkeypatch):
    rows = corpus(seed=3, hot=90)
    df = spark.createDataFrame([(k, t, "x", "y", "z") for k, t in rows], SCHEMA).repartition(6)
    monkeypatch.setattr(similar, "BLOCK_ITEMS", 16)
    assert rows_of(forest.near_copies(df)) == brute(rows)


def test_one_of_each(spark):
    rows = corpus(seed=4)
    df = spark.createDataFrame([(k, t, "x", "y", "z") for k, t in rows], SCHEMA)
    kept = forest.one_of_each(df).collect()
    assert kept[0].__fields__ == SCHEMA.names
    found = forest.near_copies(df).collect()
    assert {r.doc_id for r in kept} == {r.doc_id for r in found if r.doc_id == r.class_id}
    assert {r.class_id for r in found} == {r.doc_id for r in kept}


def test_empty(spark):
    assert forest.near_copies(spark.createDataFrame([], SCHEMA)).collect() == []
    assert forest.one_of_each(spark.createDataFrame([], SCHEMA)).collect() == []
    one = forest.near_copies(spark.createDataFrame([(None, None, None, None, None)], SCHEMA)).collect()
    assert [tuple(r) for r in one] == [(None, None, 0, 0)]


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)] + [(5000, 5000)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in similar.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in list(root) if find(x) != x}


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows_of(QUERIES["op9_near_copies"](spark, sf)) == brute(rows)


def test_a_text_is_fetched_once_where_ids_are_null_or_equal(spark, monkeypatch):
    rng = random.Random(5)
    texts = [t for _ in range(15) for w in [[f"w{rng.randrange(400)}" for _ in range(60)]] for t in (" ".join(w), edited(w, rng, 1))]
    rows = [(k, t) for k, half in ((None, texts[:16]), (7, texts[16:])) for t in half]
    fetched, check = spark.sparkContext.accumulator(0), forest._same_set

    def counted(batches):
        def seen():
            for batch in batches:
                fetched.add(batch.num_rows)
                yield batch

        yield from check(seen())

    monkeypatch.setattr(forest, "_same_set", counted)
    df = spark.createDataFrame([(k, t, "x", "y", "z") for k, t in rows], SCHEMA).repartition(4)
    assert sorted((r.class_id or 0, r.n_links) for r in forest.near_copies(df).collect()) == [(0, 1)] * 16 + [(7, 1)] * 14
    assert fetched.value == len(rows)


def test_one_row_of_each_class_with_repeated_and_null_ids(spark):
    rng = random.Random(12)
    words = [[f"w{rng.randrange(400)}" for _ in range(60)] for _ in range(7)]
    a, b, c, d, e, f, g = map(" ".join, words)
    classes = {
        "copies": [(5, a)] * 50 + [(6, a)],
        "null and id": [(None, b), (None, edited(words[1], rng, 1)), (8, b)],
        "nulls": [(None, c)] * 3 + [(None, edited(words[2], rng, 1))],
        "nulls of another text": [(None, d)],
        "an id of several texts": [(9, e), (9, edited(words[4], rng, 1))],
        "another class of that id": [(9, f), (9, f)],
        "alone": [(1, g)],
    }
    rows = [(k, t, name, str(i), "z") for name, members in classes.items() for i, (k, t) in enumerate(members)]
    rng.shuffle(rows)
    kept = forest.one_of_each(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted(r.a for r in kept) == sorted(classes)
    assert {r.a: r.doc_id for r in kept} == {n: min((k for k, _ in m if k is not None), default=None) for n, m in classes.items()}
    assert all(tuple(r) in set(rows) for r in kept)
