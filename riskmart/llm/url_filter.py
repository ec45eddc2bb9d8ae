"""URL filter: domain rules, then a weighted vocabulary searched with an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import keeps_names, others

ALLOW, BLOCK = "allow", "block"
LIMIT = 2
#: A term of weight LIMIT is strict: one hit rejects. Lighter terms are soft and add up, each once.
VOCABULARY: Mapping[str, int] = {
    **dict.fromkeys(("adult", "casino", "escort", "hentai", "porn", "porno", "xxx", "spam", "viagra"), 2),
    **dict.fromkeys(("ads", "bet", "bets", "bonus", "buy", "cheap", "deal", "farm", "free", "loan", "pills", "track", "win"), 1),
}
RESULT = "host string, path string, rule string, verdict string, strict_hits int, soft_terms int, score int"
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


@dataclass(frozen=True)
class Rule:
    """Verdict for a host with all its subdomains, on paths that start with `path`."""

    host: str
    path: str
    verdict: str

    def __str__(self) -> str:
        return self.host + self.path


def _lower(text: str) -> str:
    """A-Z only; other scripts stay as they are."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case and path; both empty for null and for a text without `://`."""
    _, scheme, rest = (url or "").partition("://")
    if not scheme:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    after = rest[end:]
    stop = min((i for i in map(after.find, "?#") if i >= 0), default=len(after))
    return _lower(rest[:end]), after[:stop]


@lru_cache(maxsize=8)
def _automaton(terms: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term in terms:
        found.add_word(term, term)
    if terms:
        found.make_automaton()
    return found


def hits(text: str, vocabulary: Mapping[str, int]) -> dict[str, int]:
    """How often each term stands in `text` with no letter or digit beside it."""
    counts: dict[str, int] = {}
    if not vocabulary or not text:
        return counts
    last = len(text) - 1
    for end, term in _automaton(tuple(vocabulary)).iter(text):
        start = end - len(term) + 1
        if (start == 0 or text[start - 1] not in _ALNUM) and (end == last or text[end + 1] not in _ALNUM):
            counts[term] = counts.get(term, 0) + 1
    return counts


def _by_host(rules: Iterable[Rule]) -> dict[str, list[Rule]]:
    table: dict[str, list[Rule]] = {}
    for rule in sorted(rules, key=lambda r: (-len(str(r)), str(r))):
        table.setdefault(rule.host, []).append(rule)
    return table


def best_rule(host: str, path: str, by_host: Mapping[str, list[Rule]]) -> Rule | None:
    """The longest rule for the host or a domain above it; one lookup for each label."""
    best = None
    at = 0
    while host:
        for rule in by_host.get(host[at:], ()):
            if path.startswith(rule.path):
                if best is None or len(str(rule)) > len(str(best)):
                    best = rule
                break
        at = host.find(".", at) + 1
        if not at:
            break
    return best


@keeps_names
def judge(df: DataFrame, url: str = "url", rules: Iterable[Rule] = (), vocabulary: Mapping[str, int] = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """Adds host, path, rule, verdict, strict_hits, soft_terms and score to every row.

    The longest rule that fits decides; without one the vocabulary does: a strict term, or
    soft terms whose weights reach `limit`, block. Terms are lower case and are searched in the
    whole url, A-Z lowered, and count only between characters that are no letters or digits.
    strict_hits counts every hit of strict terms, soft_terms different soft terms, score adds the
    weight of each different term.

    No shuffle: the automaton is compiled once in each Python worker. A null or malformed url
    has empty host and path and is allowed unless it holds terms; repeated rows are judged
    alike; columns of `df` named like a result are replaced by it.
    """
    by_host, terms = _by_host(rules), dict(vocabulary)
    if any(not t or t != _lower(t) for t in terms):
        raise ValueError("terms must be non-empty and in lower case")

    @F.pandas_udf(RESULT)
    def verdicts(urls: pd.Series) -> pd.DataFrame:
        rows = []
        for u in urls:
            u = u if isinstance(u, str) else None
            host, path = split_url(u)
            rule = best_rule(host, path, by_host)
            found = hits(_lower(u or ""), terms)
            strict = sum(n for t, n in found.items() if terms[t] >= limit)
            soft = sum(terms[t] < limit for t in found)
            score = sum(terms[t] for t in found)
            own = BLOCK if score >= limit else ALLOW
            rows.append((host, path, rule and str(rule), rule.verdict if rule else own, strict, soft, score))
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict", "strict_hits", "soft_terms", "score"])

    names = [f.split()[0] for f in RESULT.split(", ")]
    kept = others(df, names)
    return df.select(*kept, verdicts(F.col(url)).alias("__j")).select(*kept, "__j.*")
