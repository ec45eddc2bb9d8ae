"""Queries opN over the test tables, and their SQL."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import align, bpe, chat, forest, histogram, lines, merkle, mixing, personal, quality, runs, url_filter, warc
from riskmart.llm.common import table
from riskmart.llm.url_filter import Rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


URL_RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


@query
def op1_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return url_filter.judge(table(spark, sf, "pages").select("page_id", "url"), rules=URL_RULES).drop("url")


def _url_sql() -> str:
    strict = [t for t, w in url_filter.VOCABULARY.items() if w >= url_filter.LIMIT]
    soft = [t for t, w in url_filter.VOCABULARY.items() if w < url_filter.LIMIT]
    has = lambda t: f"regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::INT"
    # Every start of a strict term is looked at, since neighbouring hits share a boundary.
    hits = lambda t: f"len(list_filter(range(1, length(u) + 1), lambda i: substr(u, i, {len(t)}) = '{t}' AND NOT regexp_matches(substr(u, i - 1, (i > 1)::INT), '^[a-z0-9]') AND NOT regexp_matches(substr(u, i + {len(t)}, 1), '^[a-z0-9]')))"
    rules = " UNION ALL ".join(f"SELECT '{r.host}' h, '{r.path}' p, '{r.verdict}' v" for r in URL_RULES)
    return f"""
    WITH cut AS (
      SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') u,
             CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END rest
      FROM pages),
    parts AS (
      SELECT page_id, u, regexp_extract(rest, '^[^/?#]*') h,
             regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') path
      FROM cut),
    named AS (
      SELECT page_id, u, path, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host FROM parts),
    scored AS (
      SELECT *, ({" + ".join(map(hits, strict))})::INT strict_hits, ({" + ".join(map(has, soft))})::INT soft_terms,
             ({" + ".join([f"{url_filter.VOCABULARY[t]} * {has(t)}" for t in (*strict, *soft)])})::INT score
      FROM named),
    rules AS ({rules}),
    best AS (
      SELECT page_id, u, max(length(h || p)) n
      FROM named JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
      GROUP BY ALL)
    SELECT s.page_id, s.host, s.path, h || p AS rule, coalesce(v, CASE WHEN score >= {url_filter.LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
           strict_hits, soft_terms, score
    FROM scored s
    LEFT JOIN best b ON s.page_id IS NOT DISTINCT FROM b.page_id AND s.u = b.u
    LEFT JOIN rules ON length(h || p) = b.n AND (s.host = h OR ends_with(s.host, '.' || h)) AND starts_with(s.path, p)
    """


ORACLES["op1_url_filter"] = _url_sql()


@query
def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Measures and verdicts of every document."""
    judged = quality.judge(table(spark, sf, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality.MEASURES, "base_failed", "kept")


ORACLES["op6_quality_rules"] = r"""
    WITH w AS (
      SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
      FROM documents),
    m AS (
      SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines
      FROM w),
    windows AS (
      SELECT doc_id, unnest(range(1, len(words) - 3)) AS pos, unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS five
      FROM w WHERE len(words) >= 5),
    twice AS (SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
    covered AS (SELECT doc_id, count(DISTINCT pos + k) AS n FROM twice, range(0, 5) t(k) GROUP BY doc_id),
    all_of AS (SELECT m.*, coalesce(n, 0)::BIGINT AS n_repeat_words FROM m LEFT JOIN covered USING (doc_id)),
    judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM all_of)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
                OR (n_dup_lines >= 3 AND 10 * n_dup_lines > n_words)) AS kept
    FROM judged
"""


PLANTED_CHAT = "</s>[INST] ok [/INST]"


@query
def op8_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation formatted, then turns and loss text read back from the output."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{PLANTED_CHAT}'), (-7L, 1L, 'assistant', '{PLANTED_CHAT}') AS t(conv_id, turn, role, text)")
    chats = chat.format_chats(rows.unionByName(added))
    read = chats.withColumn("turns", chat.parse(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "n_escaped",
        "round_trip",
    )


ORACLES["op8_chat_format"] = rf"""
    WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '{PLANTED_CHAT}' UNION ALL SELECT -7, 1, 'assistant', '{PLANTED_CHAT}'),
    e AS (
      SELECT *, regexp_matches(text, '(\[/?INST\]|<</?SYS>>|</?s>|<turn:|</turn>)')
                OR regexp_matches(text, '(\[/?|</?|<</?)\\(\\*)(INST\]|SYS>>|s>|turn(:|>))') AS escaped,
             CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
                       ELSE 6 + length(url_encode(role)) + 1 + 7 END + 3 + length(text) AS plain
      FROM t)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(plain + CASE WHEN escaped THEN len(regexp_extract_all(text, '(\[/?|</?|<</?)(\\*)(INST\]|SYS>>|s>|turn(:|>))')) ELSE 0 END)::BIGINT AS formatted_chars,
           count(*) FILTER (escaped) AS n_escaped, true AS round_trip
    FROM e GROUP BY conv_id
"""


@query
def op10_length_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Histogram of encoded lengths of all documents with its suffix sums."""
    return histogram.histogram(histogram.encoded_lengths(table(spark, sf, "documents")))


@query
def op3_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every whole text encoded and decoded again."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.round_trip(docs).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def _edit_rows(batches):
    """Fingerprints of texts, their edited forms and the next texts, and how alike they are."""
    for batch in batches:
        made = []
        known: dict[str, str] = {}
        for text, after in zip(batch["text"], batch["next_text"]):
            own = known.get(text) or merkle.fingerprint(text)
            following = merkle.fingerprint(after)
            known = {after: following}  # the next row's own
            half = len(text) // 2
            edited = text[: len(text) - half] + after[:half]
            other = merkle.fingerprint(edited)
            spans = merkle.edits(own, other)
            made.append(
                (
                    len(text),
                    hashlib.sha256(edited.encode("utf-8")).hexdigest(),
                    own,
                    other,
                    merkle.likeness(own, other),
                    merkle.likeness(own, following),
                    spans[0][0] if spans else None,
                )
            )
        frame = pd.DataFrame(made, columns=["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited_from"])
        frame.insert(0, "doc_id", batch["doc_id"])
        frame["edited_from"] = frame["edited_from"].astype("Int64")
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        yield frame


@query
def op4_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every text and of its edited form; edited_from is where their trees part."""
    pairs = merkle.with_next(table(spark, sf, "documents"))
    return pairs.mapInPandas(
        _edit_rows,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, edited_from long",
    )


@query
def op5_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Every page written to archives and read back from them."""
    folder, archives = warc.archive(table(spark, sf, "pages"))
    return warc.read_archives(archives, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op5_warc"] = """
    WITH p AS (
      SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
      FROM pages),
    m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keep FROM p),
    r AS (SELECT *, CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM keep THEN keep END AS refers_to FROM m)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
    FROM r
"""


@query
def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    drawn = mixing.draws(docs, mixing.plan(docs))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"))


@query
def op9_near_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Class and number of links of every document."""
    return forest.near_copies(table(spark, sf, "documents"))


@query
def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without duplicate lines."""
    return lines.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op11_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Groups, links and corpus-wide counts of the links of two tokenizers, for every whole text."""
    aligned = align.alignments(table(spark, sf, "documents").select("doc_id", "text"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    digested = aligned.select("doc_id", *numbers, "n_overlaps", digest, "pairs", "times")
    counted = align.with_counts(digested, align.vocabulary_sizes(align.BYTE_LEVEL, align.PIECES)[1])
    return counted.select("doc_id", *numbers, "n_best", "count_sum", "groups_sha256", "n_overlaps")


def _looped(doc_id: str | None, words: list[str]) -> list[str]:
    """Every tenth document, by a hash of its id, repeats from some word on; a null id has none."""
    h = zlib.crc32(doc_id.encode("ascii")) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@query
def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of every whole text, and the text without its repetitions."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = runs.periodic_runs(docs, edit=_looped, key="doc_id").select("doc_id", "runs", "collapsed")
    # Runs come by start, then period: the first of equal ones stays.
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.aggregate("runs", none, lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    """Base spans of every whole text by kind, and all spans with those the classifier adds."""
    found, _ = personal.find(table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in personal.KINDS],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
