import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from riskmart.llm import runs
from riskmart.llm.queries import QUERIES


def brute(w, least=6, times=4):
    """Every stretch that has a period and cannot grow, by definition; of equal stretches the smallest period."""
    n, found = len(w), {}
    for p in range(1, n // times + 1):
        s = 0
        while s + p < n:
            if w[s] != w[s + p]:
                s += 1
                continue
            e = s + p
            while e < n and w[e] == w[e - p]:
                e += 1
            if e - s >= max(least, times * p):
                found.setdefault((s, e), p)
            s = e - p
    return sorted((s, e - s, p) for (s, e), p in found.items())


def kept(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sequences():
    rng = random.Random(5)
    for letters in (1, 2, 3, 8):
        for n in (0, 1, 5, 6, 7, 8, 40, 150):
            yield [rng.randrange(letters) for _ in range(n)]
    for _ in range(60):
        w = []
        while len(w) < 200:
            word = [rng.randrange(3) for _ in range(rng.randint(1, 9))]
            w += word * rng.randint(1, 9) + word[: rng.randint(0, len(word))]
        yield w
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    yield b  # a Fibonacci word
    yield [0] * 300 + [1] + [0] * 300
    yield ([0, 0, 1] * 20 + [2]) * 8
    yield list(range(50)) * 5


def test_runs_match_the_definition():
    many = [np.array(w, np.int64) for w in sequences()]
    for w, got in zip(many, runs.runs_of(many)):
        assert [tuple(r) for r in got.tolist()] == brute(w.tolist()), w.tolist()


@pytest.mark.parametrize("times", [2, 3, 5])
def test_other_exponents(times):
    many = [np.array(w, np.int64) for w in sequences()]
    for w, got in zip(many, runs.runs_of(many, 4, times)):
        assert [tuple(r) for r in got.tolist()] == brute(w.tolist(), 4, times), w.tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=60), st.data())
def test_common_extensions(letters, data):
    """Forwards and backwards, between letters that occur once."""
    w = np.array([7, *letters, 8])
    grammar = runs.Grammar.of(w)
    x = data.draw(st.integers(1, len(letters) - 1))
    y = data.draw(st.integers(x + 1, len(letters)))
    ahead = next(k for k in range(len(w)) if w[x + k] != w[y + k])
    behind = next(k for k in range(len(w)) if w[x - 1 - k] != w[y - 1 - k])
    assert grammar.common(np.array([x]), np.array([y]))[0] == ahead
    assert grammar.mirrored.common(np.array([len(w) - y]), np.array([len(w) - x]))[0] == behind


def test_a_grammar_is_small_and_its_rounds_few():
    grammar = runs.Grammar.of(np.array([3, *[0, 1, 2] * 50_000, 4]))
    assert len(grammar.levels) < 80 and sum(len(level.symbols) for level in grammar.levels) < 6 * 150_000


def test_long_sequences():
    """One word over and over, and a long period, in little time."""
    once, period = np.zeros(200_000, np.int64), np.tile(np.arange(9_000), 6)
    got = runs.runs_of([once, period, np.arange(100_000)])
    assert [r.tolist() for r in got] == [[[0, 200_000, 1]], [[0, 54_000, 9_000]], []]


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("runs", T.StringType())])


def looped(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a, out = g % n, list(words)
    p = 1 + (n - a) // (3 + g % 8)
    for i in range(a, n):
        out[i] = words[a + (i - a) % p]
    return out


def expected(doc_id, text):
    words = looped(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    found = brute(words)
    best = (None,) * 4
    if found:
        s, n, p = sorted(found, key=lambda r: (-r[1] / r[2], r[0], r[2]))[0]
        best = (s, n, p, 1000 * n // p)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *best, digest("".join(f"{s},{n},{p}\n" for s, n, p in found)), digest(kept(words, found)))


@pytest.mark.parametrize("piece", [1, 300_000])
def test_query_matches_brute_force(spark, tmp_path, monkeypatch, piece):
    """Loops by the hash of the id, null and equal ids, repeated rows, odd white space, clashing names."""
    monkeypatch.setattr(runs, "PIECE", piece)
    rng = random.Random(1)
    odd = [None, "", " \n", "a", "a a a a a a", "a a a a a", "A a A a A a A a", "x y " * 400, "é\xa0é é\xa0é " * 9, "one\x0btwo\r\n" * 7]
    texts = odd + [" ".join(rng.choices("ab cd ef gh ij kl mn".split(), k=rng.randint(1, 160))) for _ in range(120)]
    rows = [(i, t, "mine") for i, t in enumerate(texts)] + [(None, "a b " * 9, ""), (None, "c " * 9, ""), (7, odd[7], "mine")]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == sorted([expected(i, t) for i, t, _ in rows], key=repr)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))) > 5


def test_empty_table(spark):
    none = runs.periodic_runs(spark.createDataFrame([], SCHEMA))
    assert none.columns == ["doc_id", "text", *runs.MADE] and none.collect() == []
