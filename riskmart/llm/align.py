"""Alignment of two tokenizers' tokens by products of sparse matrices, and how often they meet.

The tokens of a text are rows of two incidence matrices over its bytes, A and B. Row products (Gustavson)
give A·Bᵀ, the tokens that overlap. Along these links no cut is common to both sides, so they bound the
groups: the shortest stretches that both tokenizers cut out whole. Incidence of ids and groups, multiplied in the
same way, gives the pairs of ids that share a group, with the number of their occurrences.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import others, text_of, tidy
from riskmart.session import cut_lineage

BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: Bytes of a batch that are aligned at once; a longer text is aligned alone.
PIECE = 400_000
#: Terms of a product that are held at once.
TERMS = 2_000_000
#: Most pairs of ids that are sent to every task; the others are joined by a shuffle.
SENT_PAIRS = 400_000


class Csr(NamedTuple):
    """Row r holds the entries start[r]:start[r + 1]; without values every entry is 1."""

    start: np.ndarray
    column: np.ndarray
    value: np.ndarray | None = None


def _added(row: np.ndarray, column: np.ndarray, value: np.ndarray | None, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries by row and column, those of one place added up."""
    if not len(row):
        return row, column, np.empty(0, np.int64)
    key = row * np.int64(width) + column
    if np.any(key[1:] < key[:-1]):
        order = np.argsort(key, kind="stable")
        key, row, column, value = key[order], row[order], column[order], None if value is None else value[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    added = np.diff(first, append=len(key)) if value is None else np.add.reduceat(value, first)
    return row[first], column[first], added


def matrix(row: np.ndarray, column: np.ndarray, rows: int, width: int) -> Csr:
    """Entries (row, column) as CSR; the value is how often a place is named."""
    row, column, value = _added(row, column, None, width)
    return Csr(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows)))).astype(np.int64), column, value)


def _strips(work: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about TERMS terms, one row at least."""
    done = np.concatenate(([0], np.cumsum(work)))
    lo = 0
    while lo < len(work):
        hi = max(lo + 1, int(np.searchsorted(done, done[lo] + TERMS, side="right")) - 1)
        yield lo, hi
        lo = hi


def product(a: Csr, b: Csr, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A·B by rows: row r of it adds up the rows of B that the entries of A's row r name. In strips of rows."""
    terms = b.start[a.column + 1] - b.start[a.column]
    before = np.concatenate(([0], np.cumsum(terms)))
    row_of = np.repeat(np.arange(len(a.start) - 1), np.diff(a.start))
    for lo, hi in _strips(before[a.start[1:]] - before[a.start[:-1]]):
        e = slice(a.start[lo], a.start[hi])
        n = terms[e]
        place = np.repeat(b.start[a.column[e]] - (before[e] - before[e.start]), n)
        place += np.arange(len(place))
        value = None
        if a.value is not None and b.value is not None:
            value = np.repeat(a.value[e], n) * b.value[place]
        yield _added(np.repeat(row_of[e], n), b.column[place], value, width)


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)))


def overlap_links(a_bytes: np.ndarray, b_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, bytes they share), for tokens that spell the same bytes."""
    n = int(a_bytes.sum())
    a = Csr(_offsets(a_bytes), np.arange(n))
    b_transposed = Csr(np.arange(n + 1), np.repeat(np.arange(len(b_bytes)), b_bytes))
    strips = list(product(a, b_transposed, max(len(b_bytes), 1)))
    empty = [np.empty(0, np.int64)]
    return tuple(np.concatenate([s[i] for s in strips] or empty) for i in range(3))


def groups_of(links: tuple[np.ndarray, np.ndarray, np.ndarray], n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Group of each token of A and of B: links stand like stairs, and a step in both directions is a common cut."""
    row, column, _ = links
    if not len(row):
        return np.zeros(n_a, np.int64), np.zeros(n_b, np.int64), 0
    step = np.concatenate(([0], ((row[1:] != row[:-1]) & (column[1:] != column[:-1])).astype(np.int64)))
    group = np.cumsum(step)
    of_a, of_b = np.empty(n_a, np.int64), np.empty(n_b, np.int64)
    of_a[row], of_b[column] = group, group
    return of_a, of_b, int(group[-1]) + 1


def _byte_level_table(vocabulary: dict[str, int]) -> list[bytes]:
    """What bytes an entry stands for: bytes that print are written as themselves, the others as letters from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in prints}
    byte |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(prints)))}
    table = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for entry, i in vocabulary.items():
        table[i] = bytes(byte[c] for c in entry)
    return table


#: Characters from here on are left to the byte-level tokenizer's own library.
_BEYOND = 0x3000
# Fixed value: how the byte-level tokenizer cuts words.
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _class_of(cut, c: str) -> str:
    """Beside which of a letter, a digit and a mark a character stays; none for white space."""
    return "".join(other for other in "a1!" if cut(other + c))


def _fast(own, table: Sequence[bytes]):
    """The same tokenizer by a quicker library, and a search for characters that the two may take for different kinds."""
    import tiktoken

    quick = tiktoken.Encoding("own", pat_str=_WORDS, mergeable_ranks={b: i for i, b in enumerate(table)}, special_tokens={})
    asked = [chr(c) for c in range(0x80, _BEYOND)]
    # A vocabulary in which what is one word is one token.
    probes = [bytes([b]) for b in range(256)] + [(o + c).encode("utf-8") for c in asked for o in "a1!"]
    probe = tiktoken.Encoding("probe", pat_str=_WORDS, mergeable_ranks={b: i for i, b in enumerate(probes)}, special_tokens={})
    theirs = lambda word: len(probe.encode_ordinary(word)) == 1
    ours = lambda word: len(own.pre_tokenizer.pre_tokenize_str(word)) == 1
    same = "".join(c for c in asked if _class_of(theirs, c) == _class_of(ours, c))
    return quick, re.compile(f"[^\x00-\x7f{re.escape(same)}]")


class Pair:
    """Both tokenizers, whole texts."""

    def __init__(self, byte_level: str, pieces: str):
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(public_tokenizers.path(byte_level))
        self._a.encode_special_tokens = True
        self._a.no_truncation()
        self._a.no_padding()
        self._b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces))
        names = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.a_bytes = _byte_level_table(self._a.get_vocab(with_added_tokens=False))
        self._quick, self._unsure = _fast(self._a, self.a_bytes)
        self.a_bytes += [b""] * (self._a.get_vocab_size() - len(self.a_bytes))
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode("utf-8") for i, p in enumerate(names)
        ]
        self.a_lengths = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_lengths = np.array([len(x) for x in self.b_bytes], np.int64)

    def encode(self, texts: Sequence[str]) -> Iterator[tuple[list[int], list[int]] | None]:
        """Ids of A and B for each text with a space before it; none where empty or not spelt by both."""
        for text, b in zip(texts, self._b.encode(list(texts), num_threads=1)):
            if not text:
                yield None
                continue
            spaced = " " + text
            if self._unsure.search(text):
                a = self._a.encode_batch([spaced], add_special_tokens=False)[0].ids
            else:
                a = self._quick.encode_ordinary(spaced)
            raw = spaced.encode("utf-8")
            same = b"".join(map(self.a_bytes.__getitem__, a)) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw
            yield (a, b) if same else None


@lru_cache(maxsize=2)
def pair(byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> Pair:
    """Loaded once in each process that needs it."""
    return Pair(byte_level, pieces)


def vocabulary_sizes(byte_level: str, pieces: str) -> tuple[int, int]:
    import public_tokenizers
    import sentencepiece

    with open(public_tokenizers.path(byte_level), encoding="utf-8") as f:
        definition = json.load(f)
    ids = [*definition["model"]["vocab"].values(), *[t["id"] for t in definition["added_tokens"]]]
    return max(ids) + 1, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces)).get_piece_size()


@lru_cache(maxsize=2)
def _written(size: int) -> list[str]:
    """An id before a comma, a bar and a semicolon."""
    return [f"{i}{mark}" for i in range(size) for mark in ",|;"]


def _group_texts(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, groups: int, size: int) -> str:
    """`a1,a2|b1;a3|b2,b3` for the groups of one text."""
    last_a = np.concatenate((of_a[1:] != of_a[:-1], [True]))
    last_b = np.concatenate((of_b[1:] != of_b[:-1], [True]))
    marked = np.empty(len(a) + len(b), np.int64)
    marked[np.arange(len(a)) + _offsets(np.bincount(of_b, minlength=groups))[of_a]] = 3 * a + last_a
    marked[np.arange(len(b)) + np.cumsum(np.bincount(of_a, minlength=groups))[of_b]] = 3 * b + 2 * last_b
    return "".join(map(_written(size).__getitem__, marked.tolist()))[:-1]


def align(texts: Sequence[str], tokenizers: Pair) -> pd.DataFrame:
    """One row for each text, all of them in one product of block matrices."""
    known = list(tokenizers.encode(texts))
    size_b = len(tokenizers.b_bytes)
    size = max(size_b, len(tokenizers.a_bytes))
    at = [i for i, ids in enumerate(known) if ids]
    none = np.empty(0, np.int64)
    a_ids, b_ids = (np.concatenate([none, *[np.array(known[i][side], np.int64) for i in at]]) for side in (0, 1))
    n_a, n_b = (np.array([len(known[i][side]) for i in at], np.int64) for side in (0, 1))
    a_of, b_of = _offsets(n_a), _offsets(n_b)
    links = overlap_links(tokenizers.a_lengths[a_ids], tokenizers.b_lengths[b_ids])
    group_a, group_b, groups = groups_of(links, len(a_ids), len(b_ids))
    # An id of A in one text is a row; its columns are the groups.
    rows, row = np.unique(np.repeat(np.arange(len(at)), n_a) * np.int64(size) + a_ids, return_inverse=True)
    left = matrix(row, group_a, len(rows), max(groups, 1))
    right = matrix(group_b, b_ids, groups, size_b)
    strips = [(rows[r], c, v) for r, c, v in product(left, right, size_b)]
    row, column, times = (np.concatenate([s[i] for s in strips] or [none]) for i in range(3))
    pair_id, text = (row % size) * size_b + column, row // size
    bounds = np.searchsorted(text, np.arange(len(at) + 1))
    overlap_bounds = np.searchsorted(links[0], a_of)
    made = [(0, 0, 0, 0, 0, "", none, none)] * len(texts)
    for k, i in enumerate(at):
        a, b, p = slice(a_of[k], a_of[k + 1]), slice(b_of[k], b_of[k + 1]), slice(bounds[k], bounds[k + 1])
        first = group_a[a.start]
        n = int(group_a[a.stop - 1] - first) + 1
        text_groups = _group_texts(a_ids[a], b_ids[b], group_a[a] - first, group_b[b] - first, n, size)
        made[i] = (
            int(n_a[k]), int(n_b[k]), n, int(times[p].sum()), int(overlap_bounds[k + 1] - overlap_bounds[k]), text_groups, pair_id[p], times[p]
        )
    return pd.DataFrame(made, columns=["n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups", "pairs", "times"])


def _pieces(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """A batch in parts of about PIECE characters."""
    part = (batch["__chars"].cumsum() // PIECE).to_numpy()
    for _, rows in batch.groupby(part, sort=True):
        yield rows


MADE = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups", "pairs", "times")
_MADE_TYPES = "n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups string, pairs array<long>, times array<long>"


def alignments(df: DataFrame, text: str = "text", byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> DataFrame:
    """Adds to every row what its two token sequences have in common; whole texts, no shuffle.

    `groups` lists the ids of each group, `n_overlaps` counts the tokens that share bytes, `n_links` the pairs of
    occurrences that share a group, `pairs` has the pairs of ids (id of A times the size of B's vocabulary plus id of
    B) and `times` their links. A text that is null, empty or not spelt by both vocabularies has no tokens:
    zeros, an empty string, empty arrays. Repeated rows are aligned alike; columns of `df` with these names are
    replaced. A task holds tables for about 400,000 characters or for one longer text.
    """

    @F.pandas_udf(_MADE_TYPES)
    @tidy
    def aligned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokenizers = pair(byte_level, pieces)
        for batch in batches:
            for part in _pieces(pd.DataFrame({"text": batch, "__chars": batch.str.len()})):
                yield align(part["text"].tolist(), tokenizers)

    # As structs, so that no name of the caller's can clash.
    made = df.select(F.struct(*others(df, MADE)).alias("kept"), aligned(text_of(text)).alias("made"))
    return made.select("kept.*", "made.*")


def with_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """`alignments` with, instead of pairs and times, what the whole corpus says about each row's links.

    A pair's count is the number of rows that hold it linked. `n_best` are links whose count is the highest of
    their id of A, ties included; `count_sum` adds the counts of all links. The alignments are stored once. Pairs are
    counted on the map side first. At most SENT_PAIRS, the most frequent, are sent to every task; links of the others
    are joined by a shuffle, so nothing grows with the corpus in one place.
    """
    made = [c for c in aligned.columns if c not in ("pairs", "times")]
    rows = F.struct(*[F.col(f"`{c}`") for c in made]).alias("kept")
    stored = cut_lineage(aligned.select(F.monotonically_increasing_id().alias("row"), rows, "pairs", "times"), "aligned")
    counted = stored.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counted = cut_lineage(counted, "pairs")
    first = F.floor(F.col("pair") / F.lit(size_b)).cast("long")
    best = counted.groupBy(first.alias("first")).agg(F.max("n").alias("most"))
    marked = counted.withColumn("first", first).join(F.broadcast(best), "first")  # one row for each id of A
    marked = marked.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    least, rest = _sent_from(counted)
    links = stored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", "link.pairs", "link.times")
    links = links.withColumnRenamed("pairs", "pair")
    # At most SENT_PAIRS rows, by the counts just taken.
    looked = links.join(F.broadcast(marked.filter(F.col("n") >= least)), "pair", "left")
    sums = _sums(looked.filter("n IS NOT NULL"))
    if rest:
        missing = looked.filter("n IS NULL").select("row", "pair", "times")
        rare = _sums(missing.join(marked.filter(F.col("n") < least), "pair"))
        sums = sums.unionAll(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    joined = stored.select("row", "kept").join(sums, "row", "left")
    zero = F.lit(0).cast("long")
    return joined.select("kept.*", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"))


def _sums(links: DataFrame) -> DataFrame:
    return links.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )


def _sent_from(counted: DataFrame) -> tuple[int, bool]:
    """The least count, a power of two, from which at most SENT_PAIRS pairs are; whether pairs are below."""
    power = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    sizes = dict(counted.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("pairs")).collect())  # at most 63 rows
    sent, least = 0, 63
    while least > 0 and sent + sizes.get(least - 1, 0) <= SENT_PAIRS:
        least -= 1
        sent += sizes.get(least, 0)
    return 1 << least, sum(sizes.values()) > sent
