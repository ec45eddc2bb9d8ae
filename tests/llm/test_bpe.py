import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from riskmart.llm import bpe
from riskmart.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))


def same(library, text):
    want = library.encode(text, add_special_tokens=False).ids
    got = bpe.codec().encode(text)
    assert np.frombuffer(got, dtype="<u4").tolist() == want, text
    assert bpe.codec().decode(got) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    [
        "",
        "   \n\t ",
        "Hello, World! it's we'll they'RE 1234 ½ ² x²",
        "aaaa aaaaaaa aaaaaaaaaaaaaaaaaaaaaaaa",
        "a" * 5000 + " " + "ab" * 3000,
        "ΑΣ ΟΔΟΣ Σ İstanbul ẞ",
        "é é ẛ̣ ﬁ",
        "<|startoftext|>Hi<|endoftext|> <|endoftext|",
        "日本語のテキスト 한국어 \U0001f600\U0001f601 ‍­",
        "a b c\x1cd\x85e​f",
        "!!!???... ''' 's's' d'd",
        "\x00\x01\x7f",
    ],
)
def test_same_as_the_library(library, text):
    same(library, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeéstrnoa ABÉ'.,!1²\n\tßσΣ"), max_size=80))
def test_same_as_the_library_on_words(library, text):
    same(library, text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aben", min_size=1, max_size=40))
def test_same_as_the_library_on_few_letters(library, text):
    same(library, text)


def test_every_character_as_the_library(library):
    """Between letters, beside a digit, a sign and white space; every code point but the surrogates."""
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert len(chars) == 1_112_064
    texts = [" ".join(f"a{c}b {c}1{c} !{c}" for c in chars[i : i + 32]) for i in range(0, len(chars), 32)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(bpe.codec().encode(text), dtype="<u4").tolist() == want.ids, text


def test_query_as_the_library(spark, library):
    """The registered query on a whole test table, by digests."""
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op3_bpe"](spark, sf).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == want


def test_names_of_the_caller_stay(spark):
    df = spark.createDataFrame([("Hello", "mine", "too")], "text string, __both string, kept string")
    row = bpe.round_trip(df).first()
    assert (row["__both"], row["kept"], row["decoded"], row["n_tokens"]) == ("mine", "too", "hello</w>", 1)


def _merged(symbols, ranks):
    """Merges by definition: always the pair of least rank, the leftmost first."""
    symbols = list(symbols)
    while True:
        pairs = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not pairs:
            return symbols
        _, i = min(pairs)
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


def test_random_merges_match_the_definition():
    rng = random.Random(5)
    for _ in range(150):
        tokens, merges = list("abc"), []
        for _ in range(rng.randint(0, 14)):
            pair = (rng.choice(tokens), rng.choice(tokens))
            if pair[0] + pair[1] not in tokens:
                merges.append(pair)
                tokens.append(pair[0] + pair[1])
        vocabulary = {t: i for i, t in enumerate(tokens)}
        automaton = bpe.MergeAutomaton(vocabulary, merges)
        ranks = {p: r for r, p in enumerate(merges)}
        for _ in range(40):
            word = "".join(rng.choices("abc", k=rng.randint(1, 14)))
            path = automaton.path([vocabulary[c] for c in word])
            assert [tokens[i] for i in path] == _merged(word, ranks), (word, merges)


def test_frame_with_odd_rows(spark, library):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ids", T.StringType()), T.StructField("N_tokens", T.LongType())])
    long = "Une phrase, and more words. " * 40_000
    rows = [(1, "Hello there", "x", 1), (1, "Hello there", "x", 1), (None, None, None, None), (2, "", "y", 2), (3, long, "z", 3)]
    df = spark.createDataFrame(rows, schema)
    got = bpe.decode(bpe.encode(df)).collect()
    assert bpe.round_trip(df).collect() == got
    assert got[0].__fields__ == ["doc_id", "text", "ids", "n_tokens", "decoded"]
    assert len(got) == 5
    for row in got:
        want = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.n_tokens == len(want)
        assert hashlib.sha256(row.ids).hexdigest() == hashlib.sha256(np.array(want, dtype="<u4").tobytes()).hexdigest()
        assert row.decoded == library.decode(want, skip_special_tokens=False)
    empty = bpe.decode(bpe.encode(df.limit(0)))
    assert empty.collect() == []
    assert json.loads(empty.schema.json())["fields"][2]["type"] == "binary"
