"""Personal data in texts, by weak supervision.

Strict patterns find the base spans, looser ones propose more. Labelers look at each span: expressions
at its form, gazetteers at its numbers and the words around, others at its context. Each votes for, against or not
at all. How reliable they are is estimated without labels, by expectation-maximisation over the counts of all vote
patterns of the corpus; the posteriors of the patterns are the labels of a span classifier, which sees form
and context but no votes, and decides on the proposals. Base spans always stay.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from ipaddress import IPv6Address

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import others, text_of, tidy
from riskmart.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
#: Most different spans of a kind that its classifier is trained on: those with the least hash.
TRAINED_ON = 20_000
#: Weights of a classifier.
BUCKETS = 1 << 12
ROUNDS = 60
ACCEPTED = 0.5
#: Characters on each side that labelers and the classifier see.
AROUND = 60

# Gazetteers.
ENDINGS = frozenset("com org net edu gov mil int info biz io co dev app ai de fr es it uk us eu at ch nl be se no dk fi pl pt ru jp cn in br au ca mx".split())
CUES = {
    "email": frozenset("email e-mail mail mailto contact write reach correo courriel address adresse".split()),
    "ip": frozenset("ip ipv4 ipv6 host server address addr client login connect ping from proxy dns".split()),
    "card": frozenset("card credit visa mastercard amex debit tarjeta carte karte payment cc pay".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax telefon teléfono téléphone whatsapp sms dial reach".split()),
}
AGAINST = frozenset(
    "version release section chapter article isbn issn order invoice part model serial figure table page vol volume build item sku doi ticket case no id ref".split()
)

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A number starts where no digit is before it, so none is read twice.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGITS = re.compile("[^0-9]+")

# Looser forms; every repetition is bounded.
_AT = r"\x20?[\[({]\x20?(?:at|AT)\x20?[\])}]\x20?"
_DOT = r"\x20?[\[({]\x20?(?:dot|DOT)\x20?[\])}]\x20?"
_LOOSE_EMAIL = re.compile(
    rf"[A-Za-z0-9](?:{_AT}[A-Za-z0-9-]{{1,63}}(?:(?:\.|{_DOT}|\x20dot\x20)[A-Za-z0-9-]{{1,63}}){{1,8}}|\x20at\x20[A-Za-z0-9-]{{1,63}}(?:(?:{_DOT}|\x20dot\x20)[A-Za-z0-9-]{{1,63}}){{1,8}})"
)
_ANY_AT = re.compile(r"[\[({]\x20?(?:at|AT)")
_LOOSE_IP = re.compile(
    r"(?<![0-9A-Za-z:.])(?:[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\x20dot\x20)[0-9]{1,3}){3}|(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}){1,7})(?![0-9A-Za-z:])"
)
_LOOSE_CARD = re.compile(
    r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}([\x20._/:-]|\x20-\x20|\x20\x20)[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9A-Za-z])"
)
_LOOSE_PHONE = re.compile(
    r"(?<![0-9A-Za-z+.(-])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20./-])[0-9]{3,4}[\x20./-][0-9]{3,4}(?![0-9A-Za-z])(?![./-][0-9])"
)
_GROUPS = re.compile(r"[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{16}")
_NANP = re.compile(r"(?:\+1[\x20.-]?)?(?:\([2-9][0-9]{2}\)\x20?|[2-9][0-9]{2}[\x20.-])[2-9][0-9]{2}[\x20.-][0-9]{4}")
_WORDS_AROUND = re.compile(r"[^\W_]+(?:-[^\W_]+)*")


def digits_of(s: str) -> str:
    return _NOT_DIGITS.sub("", s)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @ and a domain with a dot, from the left; linear, since the local part is read back from the @."""
    end, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
        if start < at:
            end = domain.end()
            yield start, end
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """((kind, start, end) that pass their check, those that do not), by start, then kind."""
    found = [(0, s, e) for s, e in _emails(text)]
    failed = []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = m[0].split(".")
            (found if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts) else failed).append((1, *m.span()))
        for m in _CARD.finditer(text):
            if 12 <= m.end() - m.start():
                digits = digits_of(m[0])
                if 12 <= len(digits) <= 19:
                    (found if luhn(digits) else failed).append((2, *m.span()))
        for m in _PHONE.finditer(text):
            (found if 9 <= len(digits_of(m[0])) <= 15 else failed).append((3, *m.span()))
    by = lambda s: (s[1], s[0])
    return sorted(found, key=by), sorted(failed, key=by)


def _is_v6(s: str) -> bool:
    try:
        IPv6Address(s)
    except ValueError:
        return False
    return True


def passes(kind: int, s: str) -> bool | None:
    """Whether the numbers of a span pass their check; none for kinds without one."""
    if kind == 1 and ":" not in s:
        return all(int(p) <= 255 for p in _NOT_DIGITS.split(s) if p and len(p) <= 3) and max(map(len, _NOT_DIGITS.split(s))) <= 3
    if kind == 2:
        digits = digits_of(s)
        return 12 <= len(digits) <= 19 and luhn(digits)
    return None


def _apart(spans: Sequence[tuple[int, int, int]], taken: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that touch none of `taken` and, from the left, no other; longer ones first."""
    taken = sorted(taken, key=lambda s: s[1])
    starts, ends = [s for _, s, _ in taken], np.maximum.accumulate([e for _, _, e in taken]).tolist() if taken else []
    kept, end = [], 0
    for kind, start, stop in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        k = bisect_left(starts, stop)
        if start >= end and not (k and ends[k - 1] > start):
            kept.append((kind, start, stop))
            end = stop
    return kept


def proposals(text: str, base: Sequence[tuple[int, int, int]], failed: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of looser form that touch no base span and not each other; those that pass a check come first."""
    loose = [s for s in failed if s[0] in (1, 2)]
    if "dot" in text or "DOT" in text or _ANY_AT.search(text):
        for m in _LOOSE_EMAIL.finditer(text):
            start = m.start()
            while start > 0 and m.start() - start < 63 and text[start - 1] in _LOCAL:
                start -= 1
            loose.append((0, start, m.end()))
    if _DIGIT.search(text):
        loose += [(1, *m.span()) for m in _LOOSE_IP.finditer(text) if ":" not in m[0] or _is_v6(m[0])]
        loose += [(2, *m.span()) for m in _LOOSE_CARD.finditer(text)]
        loose += [(3, *m.span()) for m in _LOOSE_PHONE.finditer(text)]
    if not loose:
        return []
    good = _apart([s for s in loose if passes(s[0], text[s[1] : s[2]])], base)
    rest = [s for s in loose if not passes(s[0], text[s[1] : s[2]])]
    return sorted([*good, *_apart(rest, [*base, *good])], key=lambda s: (s[1], s[0]))


LABELERS = ("check", "form", "border", "variety", "range", "words", "cue", "numbers")
PATTERNS = 3 ** len(LABELERS)


def _form(kind: int, s: str) -> int:
    if kind == 0:
        return 1 if "@" in s or "[" in s or "(" in s else 0
    if kind == 1:
        return 1 if "[" in s or s.count(".") == 3 or s.count(":") > 3 else 0
    return 1 if (_GROUPS if kind == 2 else _NANP).fullmatch(s) or (kind == 3 and s[0] == "+") else 0


def _range(kind: int, s: str, digits: str) -> int:
    if kind == 0:
        return 1 if re.split(r"[^A-Za-z0-9]+", s.rstrip(" )]}"))[-1].lower() in ENDINGS else -1
    if kind == 1:
        first = int(digits and re.split("[^0-9]", s)[0][:4] or 1) if ":" not in s else 1
        return -1 if first == 0 or (":" not in s and max(map(len, re.split("[^0-9]+", s))) == 1) else 1
    if kind == 2:
        return 1 if digits[0] in "456" or digits[:2] in ("34", "35", "36", "37", "38") or "2221" <= digits[:4] <= "2720" else -1
    if s[0] == "+":
        return 1 if digits[0] != "0" else -1
    return -1 if len(digits) < 9 or (len(digits) == 10 and (digits[0] in "01" or digits[3] in "01")) else 1


def look(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, list[int]]:
    """(votes as a number in base 3, features) of a span."""
    s = text[start:end]
    digits = digits_of(s)
    before = _WORDS_AROUND.findall(text[max(0, start - AROUND) : start].lower())[-6:]
    after = _WORDS_AROUND.findall(text[end : end + AROUND].lower())[:6]
    left, right = text[start - 1 : start], text[end : end + 1]
    beyond = text[end + 1 : end + 2]
    tied = left.isalnum() or left in ("_", "=", "#", "/", "$", "€") or right.isalnum() or right in ("_", "=", "/", "%") or (right in (".", ",", "-", ":") and beyond.isdigit())
    near_numbers = sum(w[0].isdigit() for w in before[-3:] + after[:3])
    plain = kind in (2, 3) and (len(set(digits)) <= 2 or digits in "01234567890123456789")
    votes = (
        1 if base else {True: 1, False: -1, None: 0}[passes(kind, s)],
        _form(kind, s),
        -1 if tied else 1,
        -1 if plain else 0,
        _range(kind, s, digits),
        -1 if AGAINST.intersection(before[-3:]) else 0,
        1 if CUES[KINDS[kind]].intersection(before) or CUES[KINDS[kind]].intersection(after[:2]) else 0,
        -1 if near_numbers >= 2 else 0,
    )
    code = 0
    for v in votes:
        code = 3 * code + v + 1
    shape = re.sub(r"a+", "a", re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "9", s)))
    seen = {
        f"shape {shape[:40]}" if kind else f"signs {re.sub(r'[a9]+', '', shape)[:20]}",
        f"digits {len(digits)}",
        f"lead {digits[:1]}",
        f"left {_sort_of(left)}",
        f"right {_sort_of(right)}{_sort_of(beyond)}",
        f"near {near_numbers}",
        f"kinds {min(len(set(digits)), 4)}",
        f"luhn {kind == 2 and luhn(digits)}",
        f"last {re.split(r'[^A-Za-z0-9]+', s)[-1].lower()[:12] if kind == 0 else ''}",
        *[f"before {w[:16]}" if not w[0].isdigit() else "before 9" for w in before[-3:]],
        *[f"after {w[:16]}" if not w[0].isdigit() else "after 9" for w in after[:2]],
    }
    return code, sorted({zlib.crc32(f.encode("utf-8")) % BUCKETS for f in seen})


def _sort_of(c: str) -> str:
    return "9" if c.isdigit() else "a" if c.isalpha() else " " if c.isspace() or not c else c


_FOUND = "array<struct<kind:int,start:long,end:long,base:boolean,votes:int,features:array<int>>>"


def candidates(df: DataFrame, text: str = "text", into: str = "found") -> DataFrame:
    """Adds base spans and proposals of every whole text, with votes and features; no shuffle."""

    @F.pandas_udf(_FOUND)
    @tidy
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            made = []
            for t in batch:
                base, failed = base_spans(t)
                spans = [(k, s, e, True) for k, s, e in base] + [(k, s, e, False) for k, s, e in proposals(t, base, failed)]
                made.append([(k, s, e, b, *look(t, k, s, e, b)) for k, s, e, b in spans])
            yield pd.Series(made, dtype=object)

    return df.select(F.struct(*others(df, (into,))).alias("kept"), found(text_of(text)).alias(into)).select("kept.*", into)


# --- reliabilities and the classifier


def votes_of(codes: np.ndarray) -> np.ndarray:
    """One row of 0 (against), 1 (no vote), 2 (for) for each code."""
    return codes[:, None] // 3 ** np.arange(len(LABELERS))[::-1] % 3


@dataclass(frozen=True)
class Reliabilities:
    """Share of personal data, and how often each labeler votes against, not, for: `votes[y][labeler]`, y = 0 no, 1 yes.

    A vote against by the labeler `certain` needs no estimate: a number that fails its check is nobody's.
    """

    share: float
    votes: np.ndarray
    certain: int | None = 0

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        v = votes_of(codes)
        each = np.log(self.votes)[:, np.arange(len(LABELERS)), v].sum(axis=2)
        p = 1 / (1 + np.exp(np.clip(each[0] - each[1] + np.log((1 - self.share) / self.share), -500, 500)))
        return p if self.certain is None else np.where(v[:, self.certain] == 0, 0.0, p)


def estimate(codes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS, certain: int | None = 0) -> Reliabilities:
    """Expectation-maximisation over vote patterns and their counts; labelers are independent given the truth.

    It starts from, and is held by, the belief of a few votes that labelers are right more often than wrong.
    """
    belief = np.array([[4.0, 3.0, 0.5], [0.5, 3.0, 4.0]])[:, None, :].repeat(len(LABELERS), axis=1)
    state = Reliabilities(0.5, belief / belief.sum(axis=2, keepdims=True), certain)
    if not len(codes):
        return state
    one = np.eye(3)[votes_of(codes)]
    for _ in range(rounds):
        p = state.posterior(codes)
        weight = np.stack([(1 - p) * counts, p * counts])
        votes = belief + np.einsum("yn,nlv->ylv", weight, one)
        state = Reliabilities(float((weight[1].sum() + 1) / (weight.sum() + 2)), votes / votes.sum(axis=2, keepdims=True), certain)
    return state


def fit(features: Sequence[Sequence[int]], target: np.ndarray, rounds: int = 200, penalty: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression on soft labels, the last one a constant; accelerated gradient steps, the same in any run."""
    weights = np.zeros(BUCKETS + 1)
    if not len(features):
        return weights
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    column = np.concatenate([np.asarray(f, np.int64) for f in features])
    width = np.bincount(row, minlength=len(features)) + 1
    rate = 1 / (0.25 * len(features) * width.max() + penalty)
    ahead, momentum = weights.copy(), 1.0
    for _ in range(rounds):
        margin = np.bincount(row, ahead[column], len(features)) + ahead[-1]
        error = 1 / (1 + np.exp(-margin)) - target
        slope = np.append(np.bincount(column, error[row], BUCKETS), error.sum()) + penalty * np.append(ahead[:-1], 0)
        after = ahead - rate * slope
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = after + (momentum - 1) / following * (after - weights)
        weights, momentum = after, following
    return weights


@dataclass(frozen=True)
class Detector:
    """What was learnt for each kind: reliabilities of labelers, weights of the classifier."""

    reliabilities: dict[int, Reliabilities]
    weights: dict[int, np.ndarray]

    def probability(self, kind: int, features: Sequence[int]) -> float:
        w = self.weights[kind]
        return float(1 / (1 + np.exp(-np.clip(w[list(features)].sum() + w[-1], -500, 500))))


def learn(stored: DataFrame, found: str = "found", trained_on: int = TRAINED_ON) -> Detector:
    """Reliabilities from the vote patterns of all spans; classifiers from at most `trained_on` different spans of a kind.

    The driver gets one row for each vote pattern (at most 4 * 3^8) and the spans trained on.
    """
    spans = stored.select(F.explode(found).alias("s")).select("s.kind", "s.votes", "s.features")
    # Equal spans are one row with a count.
    different = cut_lineage(spans.groupBy("kind", "votes", "features").agg(F.count(F.lit(1)).alias("n")), "votes")
    patterns = different.groupBy("kind", "votes").agg(F.sum("n").alias("n")).orderBy("kind", "votes").collect()
    reliabilities, weights = {}, {}
    for kind in range(len(KINDS)):
        of = [(r["votes"], r["n"]) for r in patterns if r["kind"] == kind]
        codes, counts = (np.array([x[i] for x in of], np.int64) for i in (0, 1))
        reliabilities[kind] = estimate(codes, counts)
        sample = different.filter(F.col("kind") == kind).orderBy(F.xxhash64("features", "votes"), "features", "votes").limit(trained_on)
        rows = sample.select("votes", "features").collect()
        target = reliabilities[kind].posterior(np.array([r["votes"] for r in rows], np.int64)) if rows else np.empty(0)
        weights[kind] = fit([r["features"] for r in rows], target)
    return Detector(reliabilities, weights)


_SPANS = "array<struct<kind:string,start:long,end:long,base:boolean,probability:double>>"


def decide(df: DataFrame, detector: Detector, found: str = "found", accepted: float = ACCEPTED) -> DataFrame:
    """Replaces `found` by `spans`: base spans, and proposals the classifier accepts, by start, then kind."""
    stripped = F.transform(found, lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end", "base", "features")]))

    @F.pandas_udf(_SPANS)
    @tidy
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            made = []
            for row in batch:
                scored = [(s["start"], s["kind"], s["end"], s["base"], detector.probability(s["kind"], s["features"])) for s in row]
                kept = sorted(s for s in scored if s[3] or s[4] >= accepted)
                made.append([(KINDS[k], start, end, b, p) for start, k, end, b, p in kept])
            yield pd.Series(made, dtype=object)

    # Most rows have no span and need no Python.
    none = F.array().cast(_SPANS)
    bare = df.select(F.struct(*others(df, (found, "spans"))).alias("kept"), stripped.alias(found))
    some = bare.filter(F.size(found) > 0).select("kept.*", spans(found).alias("spans"))
    return some.unionAll(bare.filter(F.size(found) == 0).select("kept.*", none.alias("spans")))


def find(df: DataFrame, text: str = "text", trained_on: int = TRAINED_ON) -> tuple[DataFrame, Detector]:
    """(`df` without its text, with `spans`; what was learnt).

    Spans have a kind, start and end (code points, end exclusive), whether they are base spans, and the classifier's
    probability. A null text is empty and has none; repeated rows get the same spans; a column of `df` named
    spans or found is replaced. Texts are read once; what was found in them is stored in the shared folder.
    """
    kept = others(df, (text, "found", "spans"))
    looked = candidates(df.select(F.struct(*kept).alias("kept") if kept else F.lit(None).alias("kept"), text_of(text).alias("text"))).drop("text")
    stored = cut_lineage(looked, "spans")
    detector = learn(stored, "found", trained_on)
    return decide(stored, detector).select("kept.*", "spans"), detector


def redact(text: str, spans: Sequence[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping ones the first counts."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
            at = end
    return "".join([*parts, text[at:]])
