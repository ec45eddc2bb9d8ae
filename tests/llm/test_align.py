import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from riskmart.llm import align
from riskmart.llm.queries import QUERIES

ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "word  \n\n word", "\t tab\x0bnew\x0c", "no break  wide", "▁", "a ▁b▁ c",
    "nul \x00 byte", "<|endoftext|> end", "</s> <s> <unk> <0x41>", "日本語の文 テキスト", "emoji 👩‍👩‍👧 ok", "é é ﬁ Ⅷ", "x" * 5000, " " * 3000,
    "word " * 2000, "a1b2 c3;d4", "՘b Ᲊb", "\x1c\x1d \x85 x", "don't we'll I'm", "퟿  ￿",
]


def whole(text):
    """Ids by the libraries, for the whole text at once; none where they do not spell it."""
    p = align.pair()
    if not text:
        return None
    a = p._a.encode(" " + text, add_special_tokens=False).ids
    b = p._b.encode(text)
    raw = b"".join(p.a_bytes[i] for i in a)
    if raw != (" " + text).encode() or b"".join(p.b_bytes[i] for i in b) != raw:
        return None
    return a, b


def brute(texts):
    """(n_a, n_b, groups as text, Counter of linked pairs) for each text, from offsets alone."""
    p, made = align.pair(), []
    for text in texts:
        ids = whole(text)
        if not ids:
            made.append((0, 0, 0, "", Counter()))
            continue
        ends = [np.cumsum([len(side[i]) for i in x]).tolist() for side, x in zip((p.a_bytes, p.b_bytes), ids)]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, at = [], [0, 0]
        for cut in common:
            group = []
            for side in (0, 1):
                stop = ends[side].index(cut, at[side]) + 1
                group.append(ids[side][at[side] : stop])
                at[side] = stop
            groups.append(group)
        pairs = Counter()
        for x, y in groups:
            pairs.update(Counter({(i, j): n * m for i, n in Counter(x).items() for j, m in Counter(y).items()}))
        made.append((len(ids[0]), len(ids[1]), len(groups), ";".join("|".join(",".join(map(str, s)) for s in g) for g in groups), pairs))
    return made


def test_odd_texts_are_encoded_as_the_libraries_do():
    texts = [t or "" for t in ODD]
    for text, got in zip(texts, align.pair().encode(texts)):
        want = whole(text)
        assert (got is None) == (want is None), repr(text[:50])
        if want:
            assert list(got[0]) == want[0] and list(got[1]) == want[1], repr(text[:50])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\tabAé1'.-▁日 ՘👍the"), max_size=40))
def test_any_text_is_encoded_as_a_whole(text):
    (got,) = align.pair().encode([text])
    want = whole(text)
    assert (got is None) == (want is None) and (not want or [list(x) for x in got] == list(want))


def test_every_character_is_encoded_as_the_library_does():
    """Between a letter and a mark, beside a digit and a space."""
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c != 0x2581]
    texts = ["".join(f"a{c}b {c}1{c} !{c}" for c in chars[i : i + 64]) for i in range(0, len(chars), 64)]
    p = align.pair()
    for text, got, want in zip(texts, p.encode(texts), p._a.encode_batch([" " + t for t in texts], add_special_tokens=False)):
        assert got is None or list(got[0]) == want.ids, repr(text)
    assert sum(x is not None for x in p.encode(texts)) > len(texts) - 3


@pytest.mark.parametrize("terms", [1, 7, align.TERMS])
def test_product_of_random_matrices(monkeypatch, terms):
    monkeypatch.setattr(align, "TERMS", terms)
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 3, (9, 7)) * rng.integers(0, 2, (9, 7)), rng.integers(0, 3, (7, 11))
    spread = lambda m: align.matrix(*[np.repeat(x, m[np.nonzero(m)]) for x in np.nonzero(m)], *m.shape)
    got = np.zeros((9, 11), int)
    for r, c, v in align.product(spread(a), spread(b), 11):
        got[r, c] += v
    assert (got == a @ b).all()


def test_overlap_links_share_bytes():
    row, column, value = align.overlap_links(np.array([2, 3, 1]), np.array([1, 3, 1, 1]))
    assert list(zip(row.tolist(), column.tolist(), value.tolist())) == [(0, 0, 1), (0, 1, 1), (1, 1, 2), (1, 2, 1), (2, 3, 1)]
    of_a, of_b, n = align.groups_of((row, column, value), 3, 4)
    assert (of_a.tolist(), of_b.tolist(), n) == ([0, 0, 1], [0, 0, 0, 1], 2)


SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("pairs", T.StringType()), T.StructField("kept", T.IntegerType())]
)


def expected(rows):
    made = brute([r[1] for r in rows])
    held = Counter(p for m in made for p in m[4])
    most = {}
    for (a, _), n in held.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for row, (n_a, n_b, n, text, pairs) in zip(rows, made):
        best = sum(k for p, k in pairs.items() if held[p] == most[p[0]])
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        out.append((row[0], n_a, n_b, n, sum(pairs.values()), best, sum(k * held[p] for p, k in pairs.items()), digest))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sent", [0, 40, 400_000])
def test_query_matches_brute_force(spark, tmp_path, monkeypatch, sent):
    """With and without pairs that are too many to send; odd texts, null and equal ids, repeats, clashing names."""
    monkeypatch.setattr(align, "SENT_PAIRS", sent)
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(None, "a b the the", "x", 1), (None, "the the", "y", 2), (3, "the end", "", 0), (3, "the end", "", 0)]
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_token_alignment"](spark, str(tmp_path)).drop("n_overlaps")
    assert sorted([tuple(r) for r in got.collect()], key=repr) == expected(rows)


def test_empty_table_and_clashing_names(spark):
    none = align.alignments(spark.createDataFrame([], SCHEMA))
    assert none.columns == ["doc_id", "text", "kept", *align.MADE]
    assert align.with_counts(none, 32_000).collect() == []
    row = align.alignments(spark.createDataFrame([(1, "the end", "mine", 7)], SCHEMA)).first()
    assert (row["kept"], row["n_groups"], row["n_overlaps"]) == (7, 2, 2)
