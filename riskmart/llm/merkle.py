"""Document fingerprints: a Merkle tree over sections, paragraphs and short stretches of text.

A text is cut into leaves that cover all of it: sentences, or stretches of LEAF characters at most
that end with a word. Leaves hang under their paragraph (a line), paragraphs under their section
(lines up to an empty one). Equal roots mean equal texts; where roots differ, the branches that
differ say where.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import others, text_of

LEAF = 48
_CUT = re.compile(
    rf"\n+|[^\n.!?]{{1,{LEAF - 1}}}(?:[.!?]+[^\S\n]*|[^\S\n]+|(?=\n)|$)|[^\n.!?]{{1,{LEAF}}}|[.!?]+[^\S\n]*"
)


@dataclass
class Node:
    digest: str
    chars: int
    children: list[Node] = field(default_factory=list)


def _inner(children: list[Node]) -> Node:
    joined = "".join([f"{c.digest}{c.chars}." for c in children])
    return Node(blake2b(joined.encode("ascii"), digest_size=8).hexdigest(), sum(c.chars for c in children), children)


def _grow(leaves: list[list[list[Node]]]) -> Node:
    return _inner([_inner([_inner(p) for p in s]) for s in leaves])


#: Domains of the digests: a node of one level is never taken for one of another.
_LEVELS = (b"root", b"section", b"paragraph")


def _digest(of: bytes, level: bytes = b"") -> bytes:
    return blake2b(of, digest_size=16, person=level).digest()


def fingerprint(text: str) -> str:
    """Root, then `length.digest` of each leaf; `-`, `,` and `;` part leaves, paragraphs and sections.

    The root is the digest of its sections' digests, a section's that of its paragraphs', a paragraph's that of its leaves',
    16 bytes each; leaves are written with 4 bytes.
    """
    sections: list[bytes] = []
    paragraphs: list[bytes] = []
    row: list[bytes] = []
    out: list[str] = []
    link = ""
    for piece in _CUT.findall(text):
        if link in (",", ";"):
            paragraphs.append(_digest(b"".join(row), _LEVELS[2]))
            row = []
            if link == ";":
                sections.append(_digest(b"".join(paragraphs), _LEVELS[1]))
                paragraphs = []
        full = _digest(piece.encode("utf-8", "surrogatepass"))
        out.append(f"{link}{len(piece)}.{full[:4].hex()}")
        row.append(full)
        link = "-"
        if piece[0] == "\n":
            link = ";" if len(piece) > 1 else ","
    if row:
        paragraphs.append(_digest(b"".join(row), _LEVELS[2]))
        sections.append(_digest(b"".join(paragraphs), _LEVELS[1]))
    return f"{_digest(b''.join(sections), _LEVELS[0]).hex()}:{''.join(out)}"


def tree(print_: str) -> Node:
    """The tree that a fingerprint writes down."""
    leaves: list[list[list[Node]]] = []
    body = print_.partition(":")[2]
    for section in body.split(";") if body else ():
        paragraphs = []
        for paragraph in section.split(","):
            row = []
            for leaf in paragraph.split("-"):
                chars, _, digest = leaf.partition(".")
                row.append(Node(digest, int(chars)))
            paragraphs.append(row)
        leaves.append(paragraphs)
    return _grow(leaves)


def _leaves(print_: str) -> list[str]:
    body = print_.partition(":")[2]
    return re.split("[-,;]", body) if body else []


def likeness(a: str, b: str) -> float:
    """Share of the two texts' characters in leaves that both have, from 0 to 1; 1 for equal roots."""
    if a.partition(":")[0] == b.partition(":")[0]:
        return 1.0
    x, y = Counter(_leaves(a)), Counter(_leaves(b))
    chars = lambda leaf: int(leaf.partition(".")[0])
    total = sum(chars(leaf) * n for leaf, n in x.items()) + sum(chars(leaf) * n for leaf, n in y.items())
    return 2 * sum(chars(leaf) * min(n, y[leaf]) for leaf, n in x.items() if leaf in y) / total


def _apart(a: Node, b: Node, at_a: int, at_b: int) -> Iterator[tuple[int, int, int, int]]:
    if a.digest == b.digest and a.chars == b.chars:
        return
    x, y = a.children, b.children
    same = lambda i, j: x[i].digest == y[j].digest and x[i].chars == y[j].chars
    head = 0
    while head < min(len(x), len(y)) and same(head, head):
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and same(len(x) - 1 - tail, len(y) - 1 - tail):
        tail += 1
    from_a = at_a + sum(c.chars for c in x[:head])
    from_b = at_b + sum(c.chars for c in y[:head])
    x, y = x[head : len(x) - tail], y[head : len(y) - tail]
    if len(x) == len(y) and x and all(c.children and d.children for c, d in zip(x, y)):
        for c, d in zip(x, y):
            yield from _apart(c, d, from_a, from_b)
            from_a, from_b = from_a + c.chars, from_b + d.chars
    else:
        yield from_a, from_a + sum(c.chars for c in x), from_b, from_b + sum(d.chars for d in y)


def edits(a: str, b: str) -> list[tuple[int, int, int, int]]:
    """Where two fingerprinted texts differ: (start, end) in the first and in the second.

    Only branches with different digests are entered. What lies outside the spans is equal.
    """
    if a.partition(":")[0] == b.partition(":")[0]:
        return []
    return list(_apart(tree(a), tree(b), 0, 0))


def fingerprinted(text: Column) -> Column:
    """Fingerprint of a text; a null text is empty."""

    @F.pandas_udf("string")
    def prints(texts: pd.Series) -> pd.Series:
        return texts.map(fingerprint)

    return prints(F.coalesce(text.cast("string"), F.lit("")))


def fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds `fingerprint` to every row, in the scan.

    A null text has the fingerprint of the empty one; repeated rows have equal ones; a column of
    `df` with that name is replaced.
    """
    return df.select(*others(df, ("fingerprint",)), fingerprinted(text_of(text)).alias("fingerprint"))


def compared(a: Column, b: Column) -> Column:
    """Struct (likeness, spans) of two fingerprint columns."""

    @F.pandas_udf("likeness double, spans array<struct<a_start:long,a_end:long,b_start:long,b_end:long>>")
    def compare(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        spans = [[dict(zip(("a_start", "a_end", "b_start", "b_end"), s)) for s in edits(p, q)] for p, q in zip(x, y)]
        return pd.DataFrame({"likeness": [likeness(p, q) for p, q in zip(x, y)], "spans": spans})

    return compare(a, b)


def with_next(df: DataFrame, key: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Rows (key, text, next_text): each row with the text of the next one by key, the last with the first's.

    Rows are dealt into ranges of the key, each range is sorted, and each row meets the next as the
    sorted range streams by. The first row of a range goes to the range before it as well. So texts
    move once, no task holds more than a range, and only one key for each range comes to the driver.

    Null texts are empty; null keys come first; rows with equal keys are ordered by a hash of the
    text; an empty table gives no rows; a single row is its own next.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("key", shares, 100 * ranges)).first()[0] if shares else None
    edges = np.unique(np.array(cuts or [], dtype=np.int64))

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, keys.to_numpy(), side="right").astype("int32"))

    # Range 0 is for null keys, so that they come before all others.
    placed = F.when(F.col("key").isNull(), F.lit(0)).otherwise(range_of(F.coalesce("key", F.lit(0))) + 1)
    rows = rows.withColumn("part", placed).withColumn("tie", F.xxhash64("text"))
    # One row for each range at most.
    firsts = rows.groupBy("part").agg(F.min(F.struct(F.coalesce("key", F.lit(0)).alias("key"), "tie")).alias("first")).sort("part").collect()
    to = np.full(len(edges) + 2, -1)
    heads = np.zeros((len(edges) + 2, 2), dtype=np.int64)
    for i, r in enumerate(firsts):
        to[r.part], heads[r.part] = firsts[i - 1].part, (r.first.key, r.first.tie)

    @F.pandas_udf("int")
    def copied_to(part: pd.Series, keys: pd.Series, tie: pd.Series) -> pd.Series:
        p = part.to_numpy()
        first = (heads[p, 0] == keys.to_numpy()) & (heads[p, 1] == tie.to_numpy())
        return pd.Series(np.where(first, to[p], -1).astype("int32"))

    copy = copied_to("part", F.coalesce("key", F.lit(0)), "tie")
    own = F.struct(F.col("part").alias("at"), F.lit(0).alias("extra"))
    ahead = F.struct(F.col("copy").alias("at"), F.lit(1).alias("extra"))
    goes = F.when(F.col("copy") >= 0, F.array(own, ahead)).otherwise(F.array(own))
    sent = rows.withColumn("copy", copy).select("key", "tie", "text", F.inline(goes))
    dealt = sent.repartitionById(len(edges) + 2, F.col("at")).sortWithinPartitions("extra", "key", "tie", "text").drop("at", "tie")

    def pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        done = False
        for batch in batches:
            found = []
            for k, t, extra in zip(batch["key"], batch["text"], batch["extra"]):
                if done:
                    break
                if held is not None:
                    found.append((*held, t))
                held = (None if pd.isna(k) else int(k), t)
                done = bool(extra)
            if found:
                made = pd.DataFrame(found, columns=["key", "text", "next_text"])
                made["key"] = made["key"].astype("Int64")
                yield made

    return dealt.mapInPandas(pair, "key long, text string, next_text string").withColumnRenamed("key", key)
