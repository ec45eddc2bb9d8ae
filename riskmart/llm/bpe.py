"""Byte-pair encoding by an automaton compiled from the merges.

The automaton reads tokens: its states say which tokens may follow, and it accepts a sequence of
tokens if and only if the sequence is what the merges make of its text. It starts as one state with
a loop for each base symbol, and each merge of `a` and `b`, by rank, puts in one gadget:

- every state with an arc `a` gets an arc `ab`, and `ab` gets a state of its own, which begins as
  the state after `b` is at that time;
- the state after `a` loses its arc `b`: once merged, the two never stand side by side.

Arcs lead to the state of their label, so the automaton is deterministic, and each word has exactly
one accepting path; its labels are the encoding. States and arcs are kept as what a gadget changed
(parent and rank), since copies would take the square of the vocabulary; a row of the transition
table is filled in where a text first needs it.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import others, text_of, tidy

TOKENIZER = "word_bpe_49k.json"
#: Different words whose ids a worker remembers: two generations of this many.
REMEMBERED = 75_000
#: Characters of a batch that are encoded before they are handed on.
PIECE = 1_000_000
#: Characters from here on are always cut by the definition itself.
KNOWN = 0x3000
_NEVER = 1 << 60


class MergeAutomaton:
    def __init__(self, vocabulary: dict[str, int], merges: Iterable[Sequence[str]]):
        self.labels = [""] * (max(vocabulary.values(), default=-1) + 1)
        for label, i in vocabulary.items():
            self.labels[i] = label
        self._cut: dict[tuple[int, int], int] = {}
        #: label: (the label whose state it began as, the label whose arcs it runs beside, rank)
        self._made: dict[int, tuple[int, int, int]] = {}
        self._idle: set[int] = set()
        self._rows: dict[int, dict[int, bool]] = {}
        for rank, (a, b) in enumerate(merges):
            self._gadget(vocabulary[a], vocabulary[b], vocabulary[a + b], rank)
        self._reads = self._spell(vocabulary)

    def _gadget(self, a: int, b: int, ab: int, rank: int) -> None:
        if ab in self._made:
            raise ValueError(f"two merges make {self.labels[ab]!r}")
        if a in self._idle or b in self._idle or not self._resolve(a, b):
            self._idle.add(ab)  # earlier merges never leave the two side by side
            return
        self._cut[a, b] = rank
        self._made[ab] = (b, a, rank)

    def _spell(self, vocabulary: dict[str, int]) -> dict:
        """Labels by their base symbols: symbol: [label or -1, longer ones]."""
        base = [i for i in vocabulary.values() if i not in self._made and i not in self._idle]
        spelled = {i: (i,) for i in base}
        for ab, (b, a, _) in self._made.items():  # by rank, so parts come first
            spelled[ab] = spelled[a] + spelled[b]
        root: dict = {}
        for label, symbols in spelled.items():
            level, node = root, None
            for s in symbols:
                node = level.setdefault(s, [-1, {}])
                level = node[1]
            node[0] = label
        return root

    def follows(self, state: int, label: int) -> bool:
        """Whether the state after `state` has an arc `label`: the cell of the transition table."""
        row = self._rows.setdefault(state, {})
        known = row.get(label)
        if known is None:
            known = row[label] = self._resolve(state, label)
        return known

    def _resolve(self, state: int, label: int) -> bool:
        """Undoes gadgets: the state back to those it began as, the arc back to those it ran beside.

        A cut counts if it came before the copy was taken. Of two places where the same merge
        fits, the left one is merged first, so on the side of the arc it counts at the same rank.
        """
        until = _NEVER
        while True:
            arc, before = label, _NEVER
            while True:
                rank = self._cut.get((state, arc), _NEVER)
                if rank < until and rank <= before and rank != _NEVER:
                    return False
                if arc not in self._made:
                    break
                _, parent, before = self._made[arc]
                arc = parent
            if state not in self._made:
                return True
            state, _, until = self._made[state]

    def path(self, symbols: Sequence[int]) -> list[int]:
        """Labels of the accepting path, for base symbols of one word.

        Longest arcs are tried first. A position is entered once: the state there is the same on
        any path, so one that failed fails again, and the walk is linear in the word.
        """
        n = len(symbols)
        dead = bytearray(n + 1)
        taken: list[int] = []
        waiting: list[list[tuple[int, int]]] = []
        at, rows = 0, self._rows
        while at < n:
            level, found = self._reads, []
            for i in range(at, n):
                node = level.get(symbols[i])
                if node is None:
                    break
                label, level = node
                if label >= 0:
                    found.append((label, i + 1))
            waiting.append(found)
            while True:
                while not waiting[-1]:
                    waiting.pop()
                    if not taken:
                        raise ValueError("no path: a base symbol is not in the vocabulary")
                    taken.pop()
                label, end = waiting[-1].pop()
                if dead[end]:
                    continue
                if taken:
                    row = rows.get(taken[-1])
                    follows = row.get(label) if row else None
                    if not (self.follows(taken[-1], label) if follows is None else follows):
                        continue
                break
            taken.append(label)
            dead[end] = 1
            at = end
        return taken


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write each byte as: itself if it prints, else the next from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [], 256
    for b in range(256):
        if b in prints:
            letters.append(chr(b))
        else:
            letters.append(chr(extra))
            extra += 1
    return letters


# How the vocabulary's own definition splits text.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")


def _own_words(text: str) -> list[str]:
    folded = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
    return [w for chunk in folded.split() for w in _SPLIT.findall(chunk)]


class Cutter:
    """Words as the definition's own normaliser and splitter cut them, without its vocabulary."""

    def __init__(self, definition: dict):
        from tokenizers import Tokenizer

        empty = {**definition, "added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}}
        cutter = Tokenizer.from_str(json.dumps(empty))
        self._normalizer, self._splitter = cutter.normalizer, cutter.pre_tokenizer
        self._byte_of = {letter: b for b, letter in enumerate(_byte_letters())}

    def words(self, text: str) -> list[bytes]:
        pieces = self._splitter.pre_tokenize_str(self._normalizer.normalize_str(text))
        return [bytes(map(self._byte_of.__getitem__, piece)) for piece, _ in pieces]


def _definition(tokenizer: str) -> dict:
    import public_tokenizers

    with open(public_tokenizers.path(tokenizer), encoding="utf-8") as f:
        return json.load(f)


@lru_cache(maxsize=2)
def unsure_characters(tokenizer: str = TOKENIZER) -> str:
    """A pattern of the characters that the definition may take for another kind, case or mark than the libraries here do.

    Each character below KNOWN is tried once, between marks, letters, digits and signs; all others are left to the
    definition. Found once on the driver: workers need the definition's library only for texts with such characters.
    """
    cutter, same = Cutter(_definition(tokenizer)), []
    for c in map(chr, range(0x80, KNOWN)):
        probe = f"a\u0301{c}\u0316b {c}1{c} !{c}{c}"
        if [w.encode("utf-8") for w in _own_words(probe)] == cutter.words(probe):
            same.append(c)
    return f"[^\x00-\x7f{re.escape(''.join(same))}]"


class WordCodec:
    """Texts to ids and back, for lower-casing byte-level vocabularies with word ends."""

    _SEPARATORS = re.compile("[\x1c-\x1f]")

    def __init__(self, definition: dict, unsure: str):
        model = definition["model"]
        self.automaton = MergeAutomaton(model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]])
        end = model["end_of_word_suffix"]
        self._inner = [model["vocab"][c] for c in _byte_letters()]
        self._last = [model["vocab"][c + end] for c in _byte_letters()]
        self._marks = {t["content"]: t["id"] for t in definition["added_tokens"]}
        names = dict(enumerate(self.automaton.labels)) | {i: t for t, i in self._marks.items()}
        self._names = [names.get(i, "") for i in range(max(names) + 1)]
        cut = "|".join(regex.escape(t) for t in sorted(self._marks, key=len, reverse=True))
        self._mark = regex.compile(f"({cut})") if cut else None
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._cuts = {k: v for k, v in definition.items() if k != "model"}
        self._cutter: Cutter | None = None
        self._unsure = re.compile(unsure)

    def _their_words(self, text: str) -> list[bytes]:
        if self._cutter is None:
            self._cutter = Cutter(self._cuts)
        return self._cutter.words(text)

    def _word(self, word: str) -> bytes:
        return self._bytes(word.encode("utf-8"))

    def _bytes(self, raw: bytes) -> bytes:
        symbols = [self._inner[b] for b in raw]
        symbols[-1] = self._last[raw[-1]]
        path = self.automaton.path(symbols)
        return struct.pack(f"<{len(path)}I", *path)

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a text without white space; those of short ones are remembered."""
        packed = self._old.get(chunk)
        if packed is None:
            words = _SPLIT.findall(chunk)
            if len(words) == 1:
                packed = self._word(words[0])
            else:
                packed = b"".join([self._young.get(w) or self._old.get(w) or self._word(w) for w in words])
        if len(self._young) >= REMEMBERED:
            self._old, self._young = self._young, {}
        if len(chunk) <= 48:
            self._young[chunk] = packed
        return packed

    def _section(self, text: str) -> bytes:
        if not text.isascii() and self._unsure.search(text):
            return b"".join([self._bytes(w) for w in self._their_words(text)])
        # Lower case letter by letter: a sigma at a word's end is no exception.
        folded = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if self._SEPARATORS.search(folded):  # white space to str.split() and not to the definition
            return b"".join([self._word(w) for w in _SPLIT.findall(folded)])
        known = self._young.get
        return b"".join([known(c) or self._chunk(c) for c in folded.split()])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self._mark is None or not any(m in text for m in self._marks):
            return self._section(text)
        ids = {m: np.array([i], dtype="<u4").tobytes() for m, i in self._marks.items()}
        return b"".join(ids[p] if p in ids else self._section(p) for p in self._mark.split(text))

    def decode(self, ids: bytes) -> str:
        """The labels that the ids' arcs emit, with a space between."""
        names = self._names
        return " ".join([names[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


@lru_cache(maxsize=2)
def codec(tokenizer: str = TOKENIZER, unsure: str | None = None) -> WordCodec:
    """Compiled once in each process that needs it; `unsure` is what the driver found by `unsure_characters`."""
    return WordCodec(_definition(tokenizer), unsure or unsure_characters(tokenizer))


def _pieces(texts: pd.Series) -> Iterator[list]:
    """A batch in parts of about PIECE characters, so that what a worker makes of it stays small."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= PIECE:
            yield part
            part, size = [], 0
    if part:
        yield part


def encoded(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """Ids of a text, 4 bytes each, little-endian; empty for null."""
    unsure = unsure_characters(tokenizer)

    @F.pandas_udf("binary")
    @tidy
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = codec(tokenizer, unsure).encode
        for batch in batches:
            for part in _pieces(batch):
                yield pd.Series([encode(t) for t in part], dtype=object)

    return ids(F.coalesce(text.cast("string"), F.lit("")))


def decoded(ids: Column, tokenizer: str = TOKENIZER) -> Column:
    """Text of packed ids; empty for null."""
    unsure = unsure_characters(tokenizer)

    @F.pandas_udf("string")
    @tidy
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decode = codec(tokenizer, unsure).decode
        for batch in batches:
            for part in _pieces(batch):
                yield pd.Series([decode(p) for p in part], dtype=object)

    return text(F.coalesce(ids, F.lit(b"")))


def _counted(df: DataFrame) -> DataFrame:
    return df.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def encode(df: DataFrame, text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """Adds ids (packed, 4 bytes each) and n_tokens to every row; whole texts, no shuffle.

    A null text is empty and has no ids; repeated rows are encoded alike; columns of `df` named
    ids or n_tokens are replaced. Each Python worker compiles the automaton once and remembers
    the paths of frequent words; a text takes memory for its own words only.
    """
    kept = others(df, ("ids", "n_tokens"))
    return _counted(df.select(*kept, encoded(text_of(text), tokenizer).alias("ids")))


def decode(df: DataFrame, ids: str = "ids", tokenizer: str = TOKENIZER) -> DataFrame:
    """Adds `decoded`, the text of packed ids."""
    return df.select(*others(df, ("decoded",)), decoded(F.col(ids), tokenizer).alias("decoded"))


def round_trip(df: DataFrame, text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """`decode(encode(df))` by one worker a task, which holds the automaton once."""
    unsure = unsure_characters(tokenizer)

    @F.pandas_udf("ids binary, decoded string")
    @tidy
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(tokenizer, unsure)
        for batch in batches:
            for part in _pieces(batch):
                ids = [own.encode(t) for t in part]
                yield pd.DataFrame({"ids": ids, "decoded": [own.decode(p) for p in ids]})

    kept = others(df, ("ids", "n_tokens", "decoded"))
    # As structs, so that no name of the caller's can clash.
    made = df.select(F.struct(*kept).alias("kept"), both(text_of(text)).alias("both")).select("kept.*", "both.ids", "both.decoded")
    return _counted(made).select(*kept, "ids", "n_tokens", "decoded")
