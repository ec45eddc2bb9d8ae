import hashlib
import random
import re

import pytest
from pyspark.sql import types as T

from riskmart.llm import merkle
from riskmart.llm.queries import QUERIES


def test_leaves_cover_the_text():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choices("ab é.!?\n\t ", k=rng.randint(0, 300)))
        assert "".join(merkle._CUT.findall(text)) == text
        assert merkle.tree(merkle.fingerprint(text)).chars == len(text)


def by_definition(text):
    """Root and leaves (length, digest), from nested lists of sections, paragraphs and leaves."""
    digest = lambda data, level=b"": hashlib.blake2b(data, digest_size=16, person=level).digest()
    sections = [[]]
    for paragraph in re.findall(r"[^\n]*\n+|[^\n]+", text):
        sections[-1].append(paragraph)
        if paragraph.endswith("\n\n"):
            sections.append([])
    leaves, of_sections = [], []
    for section in filter(None, sections):
        of_paragraphs = []
        for paragraph in section:
            pieces = merkle._CUT.findall(paragraph)
            assert "".join(pieces) == paragraph
            leaves += [(len(p), digest(p.encode())[:4].hex()) for p in pieces]
            of_paragraphs.append(digest(b"".join(digest(p.encode()) for p in pieces), b"paragraph"))
        of_sections.append(digest(b"".join(of_paragraphs), b"section"))
    return digest(b"".join(of_sections), b"root").hex(), leaves


def alike(a, b):
    (root, x), (other, y) = by_definition(a), by_definition(b)
    if root == other:
        return 1.0
    shared = sum(n * min(x.count((n, d)), y.count((n, d))) for n, d in set(x))
    return 2 * shared / (len(a) + len(b))


def test_fingerprint_by_definition():
    rng = random.Random(5)
    texts = ["", "\n", "\n\n\n", "a", "a\n", "a\n\nb", "\n\na\nb. c"] + ["".join(rng.choices("ab é.!?\n\t ", k=rng.randint(0, 400))) for _ in range(300)]
    for text in texts:
        root, body = merkle.fingerprint(text).split(":")
        assert root == by_definition(text)[0]
        assert re.split("[-,;]", body) == [f"{n}.{d}" for n, d in by_definition(text)[1]] or (not body and not text)
    # Where paragraphs end is part of the root, not only what leaves hold.
    assert merkle.fingerprint("a\nb")[:32] != merkle.fingerprint("a\n\nb")[:32]
    for a, b in zip(texts, texts[1:]):
        assert merkle.likeness(merkle.fingerprint(a), merkle.fingerprint(b)) == pytest.approx(alike(a, b), abs=1e-12)


def test_root_tests_equality():
    a = "One two. Three!\n\nFour\nfive"
    assert merkle.fingerprint(a) == merkle.fingerprint(str(a))
    others = {a.replace("Four", "Fou r"), a + " ", a.replace("\n\n", "\n"), "", "x"}
    assert len({merkle.fingerprint(t).partition(":")[0] for t in others | {a}}) == len(others) + 1
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("")) == 1.0
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("a")) == 0.0


def test_spans_hold_every_change():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(50)]
    for _ in range(200):
        lines = [" ".join(rng.choices(words, k=rng.randint(1, 30))) + rng.choice(["", "."]) for _ in range(rng.randint(1, 12))]
        a = "".join(line + rng.choice(["\n", "\n\n"]) for line in lines)
        i, j = sorted(rng.sample(range(len(a) + 1), 2))
        b = a[:i] + rng.choice(["", "NEW", "new words. More\n\nlines"]) + a[j:]
        spans = merkle.edits(merkle.fingerprint(a), merkle.fingerprint(b))
        rebuilt, at = "", 0
        for a0, a1, b0, b1 in spans:
            rebuilt += a[at:a0] + b[b0:b1]
            at = a1
        assert rebuilt + a[at:] == b


def test_a_small_edit_is_found_where_it_is():
    text = "\n\n".join(f"Section {i} starts.\nIt has a line {i}.\nAnd another one." for i in range(40))
    at = text.index("line 20")
    edited = text[:at] + "LINE" + text[at + 4 :]
    ((a0, a1, b0, b1),) = merkle.edits(merkle.fingerprint(text), merkle.fingerprint(edited))
    assert a0 <= at and a1 >= at + 4 and a1 - a0 <= merkle.LEAF
    assert merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(edited)) > 0.97


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("fingerprint", T.IntegerType()), T.StructField("next_text", T.StringType())])


@pytest.mark.parametrize("ranges", [1, 3, 8])
@pytest.mark.parametrize("n", [0, 1, 2, 57])
def test_next_text_matches_a_sorted_list(spark, ranges, n):
    rng = random.Random(n)
    rows = [(rng.choice([i, i, i, 7, None]), rng.choice(["", None, f"text {i} é", "same"]), 0, "x") for i in range(n)]
    got = merkle.with_next(spark.createDataFrame(rows, SCHEMA).repartition(4), ranges=ranges).collect()
    ties = {r.t: r.h for r in spark.createDataFrame([(t or "",) for _, t, _, _ in rows] or [("",)], "t string").selectExpr("t", "xxhash64(t) AS h").collect()}
    want = sorted(((k, t or "") for k, t, _, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, ties[r[1]]))
    pairs = [(*r, want[(i + 1) % n][1]) for i, r in enumerate(want)]
    assert sorted(map(repr, pairs)) == sorted(repr((r.doc_id, r.text, r.next_text)) for r in got)


def test_frame(spark):
    df = spark.createDataFrame([(1, "a b", 3, "z"), (1, "a b", 3, "z"), (2, None, 4, None)], SCHEMA)
    got = merkle.fingerprints(df).collect()
    assert [r.fingerprint for r in got] == [merkle.fingerprint(t) for t in ("a b", "a b", "")]
    assert got[0].__fields__ == ["doc_id", "text", "next_text", "fingerprint"]
    other = merkle.fingerprints(df.withColumnRenamed("next_text", "other"), "other").select("fingerprint")
    assert other.count() == 3


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").sort("doc_id").collect()
    got = {r.doc_id: r for r in QUERIES["op4_fingerprint"](spark, sf).collect()}
    assert len(got) == len(docs)
    for i, d in enumerate(docs):
        after = docs[(i + 1) % len(docs)].text
        half = len(d.text) // 2
        edited = d.text[: len(d.text) - half] + after[:half]
        row = got[d.doc_id]
        assert row.n_chars == len(d.text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint.partition(":")[0] == by_definition(d.text)[0] and row.edited_fingerprint.partition(":")[0] == by_definition(edited)[0]
        assert row.near_edited == pytest.approx(alike(d.text, edited), abs=1e-12)
        assert row.near_next == pytest.approx(alike(d.text, after), abs=1e-12)
        assert row.fingerprint == merkle.fingerprint(d.text) and row.edited_fingerprint == merkle.fingerprint(edited)
        assert row.near_edited == merkle.likeness(row.fingerprint, row.edited_fingerprint)
        assert row.near_next == merkle.likeness(row.fingerprint, merkle.fingerprint(after))
        assert row.near_edited >= row.near_next or after == d.text or half == 0 or len(d.text) < 4 * merkle.LEAF
        if edited != d.text:
            assert row.edited_from <= len(d.text) - half + next((k for k, (x, y) in enumerate(zip(d.text[len(d.text) - half :], edited[len(d.text) - half :])) if x != y), 0) or len(edited) < len(d.text)
