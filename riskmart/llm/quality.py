"""Quality rules as a short-circuit cascade, in DataFrame functions only."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import WORD, keeps_names, let, others, text_of

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
#: Rows of the sample that costs and selectivities are estimated on.
SAMPLE_ROWS = 500


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _word_chars(text: Column, found: Column) -> Column:
    return F.char_length(F.array_join(found, "")).cast("long")


def _n_symbols(text: Column, found: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS)).cast("long")


def _n_dup_lines(text: Column, found: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD)))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs again, given the hash of the window at each position."""

    def again(by_hash: Column) -> Column:
        same = lambda x, j: (x["h"] == F.get(by_hash, j - 1)["h"]) | (x["h"] == F.get(by_hash, j + 1)["h"])
        return F.sort_array(F.transform(F.filter(by_hash, lambda x, j: F.coalesce(same(x, j), F.lit(False))), lambda x: x["at"]))

    def spread(starts: Column) -> Column:
        new = F.transform(starts, lambda at, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - at, F.lit(WINDOW))))
        return F.aggregate(new, F.lit(0).cast("long"), lambda a, n: a + n)

    located = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    return let(F.sort_array(located), lambda s: let(again(s), spread))


def _n_repeat_words(text: Column, found: Column) -> Column:
    """Words that stand in a window of five words found twice or more in the text.

    Each word counts once, those of the first occurrence too. Hashes of the windows are sorted in
    the row only if two of them are equal, so most texts cost one pass.
    """

    def of_words(w: Column) -> Column:
        last = F.size(w) - WINDOW
        windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
        repeated = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(F.lit(0).cast("long")))
        return F.when(last > 0, repeated).otherwise(F.lit(0).cast("long"))

    return let(found, of_words)


#: What the rules may refer to, each a function of a text and its words.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, found: F.size(found).cast("long"),
    "word_chars": _word_chars,
    "n_symbols": _n_symbols,
    "n_dup_lines": _n_dup_lines,
    "n_repeat_words": _n_repeat_words,
}


def measure(name: str, text: Column) -> Column:
    return MEASURES[name](text, words(text))


@dataclass(frozen=True)
class Rule:
    """Rejects a text where `fails` holds; it gets the measures named in `needs` as columns."""

    name: str
    needs: tuple[str, ...]
    fails: Callable[..., Column]


BASE = (
    Rule("few_words", ("n_words",), lambda n: n < 10),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 20 * n),
)
RULES = (
    *BASE,
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 15 * n)),
    Rule("repeated_lines", ("n_dup_lines", "n_words"), lambda d, n: (d >= 3) & (10 * d > n)),
)


def _fails(rule: Rule, measured: Callable[[str], Column]) -> Column:
    return F.coalesce(rule.fails(*[measured(n) for n in rule.needs]), F.lit(False))


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejects: float

    @property
    def gain(self) -> float:
        """Share of texts rejected for each second."""
        return self.rejects / self.seconds


def estimate(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS, seed: int = 7) -> list[Estimate]:
    """Cost and selectivity of every rule on a sample of about `rows` rows, best rule first.

    The sample is kept in memory while each rule runs over it alone; what a run takes beyond a
    run without a rule is the rule's cost. The order decides how fast a cascade is and never what
    it keeps, so times may vary between runs. Ties go by name; an empty table gives every rule no
    rejections.
    """
    total = df.count()
    share = min(1.0, 2 * rows / max(total, 1))
    drawn = df.select(text_of(text).alias("text"))
    sample = (drawn if share == 1.0 else drawn.sample(share, seed)).limit(rows).persist()
    try:

        def run(failed: Column) -> tuple[float, float]:
            start = time.perf_counter()
            got = sample.agg(F.avg(failed.cast("double"))).first()[0]
            return time.perf_counter() - start, got or 0.0

        nothing = F.length("text") < 0
        run(nothing)
        idle = min(run(nothing)[0] for _ in range(2))
        found = []
        for rule in rules:
            failed = _fails(rule, lambda n: measure(n, F.col("text")))
            tries = [run(failed) for _ in range(2)]
            found.append(Estimate(rule, max(min(t for t, _ in tries) - idle, 1e-3), tries[0][1]))
    finally:
        sample.unpersist()
    return sorted(found, key=lambda e: (-e.gain, e.seconds, e.rule.name))


def cascade(rules: Sequence[Rule], measured: Callable[[str], Column]) -> Column:
    """Name of the first rule that rejects, null if none does. Later rules are not evaluated."""
    return F.coalesce(*[F.when(_fails(r, measured), F.lit(r.name)) for r in rules], F.lit(None).cast("string"))


@keeps_names
def judge(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, order: Sequence[Rule] | None = None) -> DataFrame:
    """Adds every measure, base_failed, rejected_by and kept to each row, in one scan without a shuffle.

    `order` is the order of the cascade; by default it is estimated on a sample. kept does not
    depend on it. Null counts as an empty text, which has no words and fails; repeated rows are
    judged alike; columns of `df` named like a result are replaced by it.
    """
    order = order or [e.rule for e in estimate(df, text, rules)]
    made = [*MEASURES, "base_failed", "rejected_by", "kept"]
    kept = others(df, made)
    value = text_of(text)
    split = df.select(*kept, value.alias("__text"), words(value).alias("__words"))
    measured = split.select(*kept, *[f(F.col("__text"), F.col("__words")).alias(n) for n, f in MEASURES.items()])
    failed = reduce(or_, [_fails(r, F.col) for r in BASE])
    return measured.withColumn("base_failed", failed).withColumn("rejected_by", cascade(order, F.col)).withColumn("kept", F.col("rejected_by").isNull())


def keep(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, order: Sequence[Rule] | None = None) -> DataFrame:
    """The rows that no rule rejects, with their columns as they were.

    Unlike `judge`, a measure is computed only when the cascade reaches a rule that needs it; a text is split into words
    once, whatever the rules ask for.
    """
    order = order or [e.rule for e in estimate(df, text, rules)]
    value = text_of(text)
    return df.filter(let(words(value), lambda found: cascade(order, lambda n: MEASURES[n](value, found))).isNull())
