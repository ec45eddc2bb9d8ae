import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from riskmart.llm import lines, similar
from riskmart.llm.queries import QUERIES

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_lines", T.StringType()), T.StructField("text", T.StringType()), T.StructField("line", T.StringType()), T.StructField("lost", T.StringType())])


def _set(line):
    return frozenset(line[i : i + 8] for i in range(len(line) - 7)) if len(line) >= 8 else frozenset([line])


def brute(rows, threshold=0.8):
    """What each (id, text) becomes, from exact similarities of all lines that share a shingle."""
    where = {}
    for key, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            line = line.strip()
            if line:
                at = (key is not None, key or 0, i)
                where[line] = min(at, where.get(line, at))
    named = list(where)
    sets = [_set(x) for x in named]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    root = list(range(len(named)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    shared = defaultdict(int)
    for members in holders.values():
        for k, a in enumerate(members):
            for b in members[k + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if n / (len(sets[a]) + len(sets[b]) - n) >= threshold:
            root[find(a)] = find(b)
    best = {}
    for i, line in enumerate(named):
        r = find(i)
        best[r] = min((*where[line], line), best.get(r, (*where[line], line)))
    stays = {b[3]: b[:3] for b in best.values()}
    out = []
    for key, text in rows:
        if text is None:
            out.append((key, None, 0, 0))
            continue
        kept, seen, n = [], set(), 0
        for i, line in enumerate(text.split("\n")):
            bare = line.strip()
            n += bool(bare)
            if not bare or (bare not in seen and stays.get(bare, (0, 0, 0))[:2] == (key is not None, key or 0) and bare in stays):
                kept.append(line)
            seen.add(bare)
        out.append((key, "\n".join(kept), n, n - sum(bool(x.strip()) for x in kept)))
    return sorted(map(repr, out))


def rows_of(found):
    return sorted(map(repr, [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in found.collect()]))


def corpus(seed=1, hot=0):
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzé   "
    pool = ["".join(rng.choices(letters, k=rng.choice([2, 6, 9, 30, 80, 200]))) for _ in range(80)]

    def like(line):
        chars = list(line)
        for _ in range(rng.choice([0, 1, 1, 2])):
            if len(chars) > 20:
                chars[rng.randrange(1, len(chars) - 1)] = rng.choice("XYZ\U0001f600")
        return "".join(chars)

    rows = []
    for i in range(90):
        text = "\n".join(rng.choice(["", " ", "\t"]) + like(rng.choice(pool)) if rng.random() < 0.9 else "" for _ in range(rng.randint(1, 12)))
        rows.append((i, text))
    base = "".join(rng.choices(letters, k=150))
    rows += [(500 + i, base[: (p := rng.randrange(1, 149))] + "#" + base[p:] + "\nshared line of all") for i in range(hot)]
    return rows + [(200, None), (201, ""), (202, "\n\n \n"), (None, pool[40]), (None, "a line of null only here"), (7, rows[7][1])]


@pytest.mark.parametrize("length", [12, 30, 100, 400])
def test_bands_meet_as_often_as_promised(length):
    rng = random.Random(length)
    met, n = 0, 300
    for _ in range(n):
        a = "".join(rng.choices("abcdefghijkl", k=length))
        while True:
            b = a + "".join(rng.choices("mnopq", k=rng.randint(1, max(1, length // 4))))
            x, y = _set(a), _set(b)
            if len(x & y) / len(x | y) >= 0.8:
                break
        keys = lines.bands(*lines._shingle_hashes([a, b]))
        met += bool((keys[0] == keys[1]).any())
    assert met >= 0.98 * n


def test_shingles_are_those_of_the_definition():
    rng = random.Random(9)
    texts = ["".join(rng.choices("ab é\U0001f600", k=rng.randint(1, 60))).strip() or "x" for _ in range(200)]
    made = lines.line_shingles(texts)
    for a, b, x, y in zip(texts, texts[1:], made, made[1:]):
        assert len(x) == len(_set(a))
        assert np.intersect1d(x, y).size == len(_set(a) & _set(b))


def test_sorted_stretches(monkeypatch):
    rng = np.random.default_rng(4)
    for cells in (1, 50, 1 << 16):
        monkeypatch.setattr(similar, "CELLS", cells)
        count = rng.integers(1, 40, 301)
        values = rng.integers(0, 30, count.sum(), dtype=np.uint64)
        values[rng.random(len(values)) < 0.1] = np.iinfo(np.uint64).max  # also the number that fills up
        sets = similar.distinct(values, count)
        for got, own in zip(sets, np.split(values, np.cumsum(count)[:-1]), strict=True):
            assert got.tolist() == sorted(set(own.tolist()))
        shared = similar.shared_by_two(sets[:300])
        assert shared.tolist() == [len(set(x.tolist()) & set(y.tolist())) for x, y in zip(sets[:300:2], sets[1:300:2])]


def test_likeness_of_two_lines_is_that_of_their_shingles():
    rng = random.Random(6)
    texts = []
    for _ in range(300):
        line = "".join(rng.choices("ab é\U0001f600", k=rng.choice([1, 3, 7, 8, 9, 30, 200])))
        other = "".join(rng.choices("ab", k=rng.randint(1, 30)))
        texts += rng.choice([(line, line), (line, line + other), (line, other), (line * 3, line + other + line)])
    got = lines.line_likeness(texts)
    for a, b, one in zip(map(_set, texts[::2]), map(_set, texts[1::2]), got, strict=True):
        assert one == len(a & b) / len(a | b)
    shared = similar.shared_by_two(lines.line_shingles(texts))
    assert [(x > 0) for x in shared] == [(x > 0) for x in got]


def test_items_are_not_joined_again_for_what_their_lines_lose(spark, monkeypatch):
    plans = {}
    real = lines.cut_lineage

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(lines, "cut_lineage", kept)
    rows = corpus(seed=3)
    df = spark.createDataFrame([(k, "x", t, "y", "z") for k, t in rows], SCHEMA)
    assert rows_of(lines.dedup_lines(df)) == brute(rows)
    assert plans["lost"].count("Join") == 2  # members with their kept lines, and the lines of texts with both


def test_a_filter_behind_it_does_not_cut_texts_again(spark):
    rows = [(i, "x", f"{i} a line\n{i // 2} another line", "y", "z") for i in range(8)]
    found = lines.dedup_lines(spark.createDataFrame(rows, SCHEMA)).filter("length(text) > 9").select("doc_id", "text")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert len(found.collect()) == 4


def test_matches_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(k, "x", t, "y", "z") for k, t in rows], SCHEMA).repartition(5)
    found = lines.dedup_lines(df)
    assert found.columns == ["doc_id", "text", "line", "lost", "n_lines", "n_removed"]
    assert rows_of(found) == brute(rows)


def test_crowded_buckets_are_cut_into_blocks(spark, monkeypatch):
    rows = corpus(seed=2, hot=70)
    df = spark.createDataFrame([(k, "x", t, "y", "z") for k, t in rows], SCHEMA).repartition(5)
    monkeypatch.setattr(similar, "BLOCK_ITEMS", 8)
    assert rows_of(lines.dedup_lines(df)) == brute(rows)


def test_empty(spark):
    assert lines.dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [tuple(r) for r in lines.dedup_lines(spark.createDataFrame([(None, "a", None, "b", "c")], SCHEMA)).collect()] == [(None, None, "b", "c", 0, 0)]


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows_of(QUERIES["op2_line_dedup"](spark, sf)) == brute(rows)


def test_rows_of_one_id_or_none_are_documents(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=30)) for _ in range(60)]
    rows = [(k, "\n".join([rng.choice(words) for _ in range(rng.randint(1, 5))] + [f"{i} {rng.random()}"])) for i, k in enumerate([None] * 12 + [4] * 9 + [9, 2, 30])]
    rows += rows[:2]  # rows equal in id and text count as one document
    df = spark.createDataFrame([(k, "x", t, "y", "z") for k, t in rows], SCHEMA).repartition(4)
    found = lines.dedup_lines(df).collect()
    assert len(found) == len(rows) and all(r.n_lines - r.n_removed == len(r.text.split("\n")) for r in found)
    # Every line of the corpus stays in one document, of the least id: none is lost, none stands twice.
    held = [(line, r[0]) for r in {(r.doc_id, r.text) for r in found} for line in r[1].split("\n")]
    where = {}
    for k, text in rows:
        for line in text.split("\n"):
            where.setdefault(line, []).append(k)
    assert sorted(held, key=repr) == sorted([(line, None if None in ids else min(ids)) for line, ids in where.items()], key=repr)


def test_lists_of_asked_lines_are_measured(spark, monkeypatch):
    sizes = {}

    def measured(df, row_bytes):
        if "asked" in df.columns:
            sizes["all"] = df.count() * row_bytes
            sizes["lists"] = sum(32 * len(r.asked) for r in df.collect())
        return df

    monkeypatch.setattr(lines, "small", measured)
    rng = random.Random(3)
    text = ["".join(rng.choices("abcdefghij", k=40)) for _ in range(400)]
    rows = [(1, "\n".join(text)), (2, "\n".join(x + "!" for x in text))]
    df = spark.createDataFrame([(k, "x", t, "y", "z") for k, t in rows], SCHEMA)
    assert rows_of(lines.dedup_lines(df)) == brute(rows)
    assert sizes["all"] >= sizes["lists"] >= 32 * 700
