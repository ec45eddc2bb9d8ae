"""Periodic runs of words by recompression.

A text's words are compressed in rounds into a run-length grammar: blocks of one symbol become a symbol, then pairs of
a left and a right symbol do. Equal stretches are compressed alike but for their ends, so the longest common
extension of two places is found by climbing while ends agree, level by level, and descending into the
first difference. A run with at least t periods holds t neighbouring points of the grid of multiples of its period;
grid points with equal words are the candidates, and two extensions of each give the run's exact ends.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property
from math import isqrt
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import WORD, others, text_of, tidy

LEAST = 6
TIMES = 4
#: Words compressed into one grammar; a longer text has one of its own.
PIECE = 300_000
#: Candidates that are extended at once.
CANDIDATES = 200_000
_WORDS = re.compile(WORD)
#: Tries for a good cut of the symbols into left and right ones.
_SALTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


class Level(NamedTuple):
    """Symbols of a round and the phrases the round makes of them: phrase k begins at first[k]; up is the phrase of each symbol."""

    blocks: bool
    symbols: np.ndarray
    first: np.ndarray
    up: np.ndarray


class Grammar:
    """Grammar of a sequence of letters whose first and last letters occur nowhere else."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @classmethod
    def of(cls, letters: np.ndarray) -> Grammar:
        symbols = np.asarray(letters, np.int64)
        names = int(symbols.max(initial=-1)) + 1
        levels: list[Level] = []
        while len(symbols) > 1:
            if np.any(symbols[1:] == symbols[:-1]):
                level, symbols, names = _blocks(symbols, names)
                levels.append(level)
            if len(symbols) > 1:
                level, symbols, names = _pairs(symbols, names)
                levels.append(level)
        return cls(levels)

    @cached_property
    def mirrored(self) -> Grammar:
        """The grammar of the reversed sequence: every round read backwards."""
        turned = []
        for blocks, symbols, first, up in self.levels:
            turned.append(Level(blocks, symbols[::-1], len(symbols) - first[::-1], (len(first) - 2) - up[::-1]))
        return Grammar(turned)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For places x < y, how many letters from each on are equal."""
        begin, x, y = x, x.copy(), y.copy()
        stopped = np.full(len(x), -1, np.int64)
        climbing = np.arange(len(x))
        for h, (blocks, symbols, first, up) in enumerate(self.levels):
            if not len(climbing):
                break
            i, j = x[climbing], y[climbing]
            if blocks:  # what is left of the block on both sides
                left_i, left_j = first[up[i] + 1] - i, first[up[j] + 1] - j
                same = symbols[i] == symbols[j]
                step = np.where(same, np.minimum(left_i, left_j), 0)
                i, j = i + step, j + step
                stop = ~same | (left_i != left_j)
            else:  # inside a pair one symbol leads to its end
                inside = (first[up[i]] != i) | (first[up[j]] != j)
                stop = inside & (symbols[i] != symbols[j])
                step = inside & ~stop
                i, j = i + step, j + step
            x[climbing], y[climbing] = i, j
            stopped[climbing[stop]] = h
            climbing = climbing[~stop]
            x[climbing], y[climbing] = up[x[climbing]], up[y[climbing]]
        for h in range(len(self.levels) - 2, -1, -1):
            at = np.flatnonzero(stopped > h)
            if not len(at):
                continue
            blocks, symbols, first, _ = self.levels[h]
            i, j = first[x[at]], first[y[at]]
            # Phrases that differ begin with different symbols, or differ in what comes after the shorter block or the first symbol.
            shorter = np.minimum(first[x[at] + 1] - i, first[y[at] + 1] - j) if blocks else 1
            step = np.where(symbols[i] == symbols[j], shorter, 0)
            x[at], y[at] = i + step, j + step
        return x - begin


def _named(key: np.ndarray, names: int) -> tuple[np.ndarray, int]:
    found, number = np.unique(key, return_inverse=True)
    return number + names, names + len(found)


def _blocks(symbols: np.ndarray, names: int) -> tuple[Level, np.ndarray, int]:
    first = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
    length = np.diff(first, append=len(symbols))
    made = symbols[first].copy()
    long = length > 1
    made[long], names = _named(made[long] << 32 | length[long], names)
    return Level(True, symbols, np.append(first, len(symbols)), np.repeat(np.arange(len(first)), length)), made, names


def _pairs(symbols: np.ndarray, names: int) -> tuple[Level, np.ndarray, int]:
    """Symbols are cut into left and right ones by a hash bit, the best of a few; a left one before a right one is a pair."""
    best, paired = -1, None
    for salt in _SALTS:
        mixed = (symbols.astype(np.uint64) + np.uint64(1)) * np.uint64(salt)
        right = (mixed ^ (mixed >> np.uint64(29))) >> np.uint64(33) & np.uint64(1) == 1
        for pair in (~right[:-1] & right[1:], right[:-1] & ~right[1:]):
            n = int(np.count_nonzero(pair))
            if n > best:
                best, paired = n, pair
    if not best:  # a few symbols that all fall on one side: the first is left, the others right
        left = symbols == symbols[0]
        paired = left[:-1] & ~left[1:]
    first = np.flatnonzero(np.concatenate(([True], ~paired)))
    made = symbols[first].copy()
    at = np.flatnonzero(paired)
    of = np.cumsum(np.concatenate(([0], ~paired)))
    made[of[at]], names = _named(symbols[at] << 32 | symbols[at + 1], names)
    return Level(False, symbols, np.append(first, len(symbols)), of), made, names


def grid_points(w: np.ndarray, times: int = TIMES) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): multiples of a period from which `times` neighbouring grid points have one word, their next words too.

    Periods up to the root of the length are looked at one by one, for longer ones the points of equal number
    together: about n log n comparisons in a few times the root of n steps.
    """
    n = len(w)
    most, root = n // times, isqrt(n)
    places, periods = [], []
    for p in range(1, min(most, root) + 1):
        grid = w[::p]
        same = grid[1:] == grid[:-1]
        chain = same[: len(same) - times + 2]
        for k in range(1, times - 1):
            chain = chain & same[k : len(same) - times + 2 + k]
        at = np.flatnonzero(chain)
        if len(at):
            places.append(at * p)
            periods.append(np.full(len(at), p))
    low = root + 1
    for k in range(n // low):
        high = min(most, (n - 1) // (k + times - 1))
        if high < low:
            break
        here = w[k * low : k * high + 1 : k] if k else w[0]
        p = low + np.flatnonzero(here == w[(k + 1) * low : (k + 1) * high + 1 : k + 1])
        for j in range(k + 1, k + times - 1):
            p = p[w[j * p] == w[(j + 1) * p]]
        if len(p):
            places.append(k * p)
            periods.append(p)
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place, period = np.concatenate(places), np.concatenate(periods)
    for j in range(times - 2):
        same = w[place + 1 + j * period] == w[place + 1 + (j + 1) * period]
        place, period = place[same], period[same]
    return place, period


def _uncovered(place: np.ndarray, period: np.ndarray, found: Sequence[np.ndarray], times: int) -> np.ndarray:
    """Candidates that lie not, with all their grid points, in one found run whose period divides theirs: those would find that run again."""
    keep = np.ones(len(place), bool)
    for start, end, q in found:
        keep &= ~((period % q == 0) & (place >= start) & (place + (times - 1) * period < end))
    return keep


def runs_of(sequences: Sequence[np.ndarray], least: int = LEAST, times: int = TIMES) -> list[np.ndarray]:
    """Rows (start, length, period) of each sequence's runs, by start, then period."""
    empty = np.empty((0, 3), np.int64)
    made = [empty] * len(sequences)
    points = {}
    for i, w in enumerate(sequences):
        if len(w) >= max(least, times):
            place, period = grid_points(w, times)
            if len(place):
                points[i] = place, period
    if not points:
        return made
    # One grammar for all, each between letters of its own.
    end = max(int(sequences[i].max()) for i in points) + 1
    parts, begins, at = [np.array([end], np.int64)], {}, 1
    for k, i in enumerate(points):
        begins[i] = at
        parts += [sequences[i], np.array([end + 1 + k], np.int64)]
        at += len(sequences[i]) + 1
    grammar = Grammar.of(np.concatenate(parts))
    total = at
    for i, (place, period) in points.items():
        order = np.argsort(period, kind="stable")
        place, period = place[order], period[order]
        found: dict[tuple[int, int], int] = {}
        lo, size = 0, 1000
        while lo < len(place):  # short periods first; what they cover is not asked again
            hi = min(len(place), lo + size)
            x, p = place[lo:hi], period[lo:hi]
            lo, size = hi, min(CANDIDATES, size * 4)
            if found:
                longest = sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: r[0] - r[1])[:50]
                asked = _uncovered(x, p, longest, times)
                x, p = x[asked], p[asked]
            x = x + begins[i]
            ahead = grammar.common(x, x + p)
            behind = grammar.mirrored.common(total - x - p, total - x)
            start, stop = x - behind, x + p + ahead
            is_run = stop - start >= np.maximum(least, times * p)
            for s, e, q in zip(*[v[is_run].tolist() for v in (start - begins[i], stop - begins[i], p)]):
                if q < found.get((s, e), q + 1):
                    found[s, e] = q
        if found:
            made[i] = np.array(sorted((s, e - s, q) for (s, e), q in found.items()), np.int64)
    return made


def collapsed(words: Sequence[str], runs: np.ndarray) -> str:
    """The words that no run holds after its first period, joined by a space."""
    if not len(runs):
        return " ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return " ".join([words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def _numbered(words: Sequence[str]) -> np.ndarray:
    numbers: dict[str, int] = {}
    return np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)


def scan(texts: Sequence[Sequence[str]], least: int = LEAST, times: int = TIMES) -> Iterator[tuple[int, list[tuple], str]]:
    """(number of words, runs, collapsed text) for lists of words."""
    for words, runs in zip(texts, runs_of([_numbered(w) for w in texts], least, times)):
        yield len(words), [tuple(r) for r in runs.tolist()], collapsed(words, runs)


MADE = ("n_words", "runs", "collapsed")
_MADE_TYPES = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(
    df: DataFrame,
    text: str = "text",
    least: int = LEAST,
    times: int = TIMES,
    edit: Callable[[str | None, list[str]], list[str]] | None = None,
    key: str | None = None,
) -> DataFrame:
    """Adds n_words, runs (by start, then period) and the collapsed text to every row; whole texts, no shuffle.

    A run is a stretch of words with smallest period q, at least `times` (two or more, whole) times q and `least` words
    long, that no neighbouring word extends. `edit` may change a text's words first, by the row's `key` as
    text. A null text has no words; repeated rows are scanned alike; columns of `df` with these names are replaced. A
    task holds grammars for about 300,000 words or for one longer text.
    """

    @F.pandas_udf(_MADE_TYPES)
    @tidy
    def scanned(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for keys, batch in batches:
            waiting, size = [], 0
            for k, t in zip(keys, batch):
                words = _WORDS.findall(t)
                waiting.append(edit(k, words) if edit else words)
                size += len(waiting[-1])
                if size >= PIECE:
                    yield pd.DataFrame(scan(waiting, least, times), columns=list(MADE))
                    waiting, size = [], 0
            if waiting:
                yield pd.DataFrame(scan(waiting, least, times), columns=list(MADE))

    named = F.col(key).cast("string") if key else F.lit(None).cast("string")
    # As structs, so that no name of the caller's can clash.
    made = df.select(F.struct(*others(df, MADE)).alias("kept"), scanned(named, text_of(text)).alias("made"))
    return made.select("kept.*", "made.*")
