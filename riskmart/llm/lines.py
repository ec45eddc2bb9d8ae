"""Fuzzy line deduplication: MinHash bands over character shingles, exact Jaccard, distributed union-find.

One line of each component of similar lines stays in the corpus, that of the least document id. Texts are read where
they lie; they move, if at all, once: at the end, to meet the numbers of the lines they lose.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import keeps_names, others, tidy
from riskmart.llm.similar import components, distinct, finalised, likeness_of_two, links, multipliers, small
from riskmart.session import cut_lineage

SHINGLE = 8
THRESHOLD = 0.8
#: Eight bands of three values meet with a chance of 0.997 at a similarity of 0.8.
BANDS = 8
ROWS = 3
#: Characters that one step of the signature handles.
STEP = 1 << 17
_EMPTY = np.uint64(1 << 63)
_NO_ID = -(1 << 63)
#: Seeds of the two halves of a text's hash.
_HALVES = {"t1": 3, "t2": 5}


def own_lines(text: str) -> dict[str, int]:
    """Different lines of a text, without the white space around them: their first number. Blank lines are none."""
    found: dict[str, int] = {}
    for i, line in enumerate(text.split("\n")):
        line = line.strip()
        if line:
            found.setdefault(line, i)
    return found


def _line_hashes(lines: Sequence[str]) -> np.ndarray:
    """[2, line]: 128 bits of each."""
    raw = b"".join([xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in lines])
    return np.frombuffer(raw, dtype="<i8").reshape(-1, 2).T


def _shingle_hashes(lines: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of SHINGLE code points, and how many each line has; a shorter line is one run."""
    odd = multipliers(4, 23)
    length = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    points = np.frombuffer("\n".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    run = points * odd[0] + odd[1]
    width = 1
    while width < SHINGLE:  # runs of twice the width from two beside each other
        run = run[:-width] * odd[width.bit_length()] + run[width:] if run.size > width else run[:0]
        width *= 2
    starts = np.cumsum(length + 1) - length - 1
    count = np.maximum(length - SHINGLE + 1, 1)
    whole = length >= SHINGLE
    # A run begins anywhere but in the last places of a line and at its end; in a shorter line, nowhere.
    inside = np.ones(points.size + SHINGLE, dtype=bool)
    inside[(starts[whole] + count[whole])[:, None] + np.arange(SHINGLE)] = False
    if whole.all():
        return finalised(run[inside[: run.size]]), count
    below = np.flatnonzero(~whole)
    inside[starts[below, None] + np.minimum(np.arange(SHINGLE), length[below, None])] = False
    values = np.empty(count.sum(), dtype=np.uint64)
    is_run = np.ones(values.size, dtype=bool)
    is_run[(np.cumsum(count) - 1)[below]] = False
    values[is_run] = run[inside[: run.size]]
    values[~is_run] = _line_hashes([lines[i] for i in below])[0].view(np.uint64)
    return finalised(values), count


def line_likeness(lines: Sequence[str]) -> np.ndarray:
    """Similarity of the lines 0 and 1, 2 and 3, and so on."""
    return likeness_of_two(*_shingle_hashes(lines))


def line_shingles(lines: Sequence[str]) -> list[np.ndarray]:
    """Hashes of the different shingles of each line, sorted."""
    return distinct(*_shingle_hashes(lines))


def signatures(values: np.ndarray, count: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """[line, place]: MinHash by one permutation, cut into `size` bins.

    A bin without a shingle borrows from another, looked for in an order that is the bin's own and
    the same for every line, so two lines agree in a place with the chance of their similarity.
    """
    n = len(count)
    place = values >> np.uint64(40)
    place *= np.uint64(size)
    place >>= np.uint64(24)
    place = place.view(np.int64)
    place += np.repeat(np.arange(n) * size, count)
    flat = np.full(n * size, _EMPTY, dtype=np.uint64)
    np.minimum.at(flat, place, values & np.uint64((1 << 40) - 1))
    own = flat.reshape(n, size)
    filled = own.copy()
    order = np.random.Generator(np.random.Philox(key=29))
    row, col = np.nonzero(filled == _EMPTY)
    while row.size:
        jump = order.integers(0, size, size)
        filled[row, col] = own[row, jump[col]]
        still = filled[row, col] == _EMPTY
        row, col = row[still], col[still]
    return filled


def bands(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """[line, band]: the bucket of each band."""
    signature = signatures(values, count).reshape(len(count), BANDS, ROWS)
    odd = multipliers(ROWS, 31)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), signature.shape[:2])
    for r in range(ROWS):
        key = finalised(key * odd[r] + signature[:, :, r])
    return key.view(np.int64)


def _named(df: DataFrame, key: str, text: str) -> dict[str, Column]:
    """Columns that tell documents apart: the id, and where rows share one or have none, 128 bits of the text too."""
    named = {"doc": F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID))}
    if df.groupBy(named["doc"].alias("doc")).count().filter("count > 1").isEmpty():
        return named
    return named | {t: F.xxhash64(F.lit(seed), F.col(key).isNull(), F.col(text).cast("string")) for t, seed in _HALVES.items()}


def _occurring(signed: bool, by: Sequence[str]):
    """Rows (*by, line, h1, h2) of a document's different lines; with size and buckets if `signed`."""
    names = [*by, "line", "h1", "h2", *(["n", *[f"k{b}" for b in range(BANDS)]] if signed else [])]

    def rows(batch: pa.RecordBatch, at: list, numbers: list, lines: list[str]) -> pa.RecordBatch:
        columns = [*[batch.column(c).to_numpy(zero_copy_only=False)[at] for c in by], np.array(numbers, dtype=np.int64), *_line_hashes(lines)]
        if signed:
            values, count = _shingle_hashes(lines)
            columns += [count, *bands(values, count).T]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, numbers, lines, size = [], [], [], 0
            for i, text in enumerate(batch.column("text").to_pylist()):
                for line, number in own_lines(text).items():
                    at.append(i)
                    numbers.append(number)
                    lines.append(line)
                    size += len(line)
                    if size >= STEP:
                        yield rows(batch, at, numbers, lines)
                        at, numbers, lines, size = [], [], [], 0
            if lines:
                yield rows(batch, at, numbers, lines)

    return run, ", ".join(f"{c} long" for c in names)


@tidy
def _asked_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, text) of the lines asked for in each document, where its text has them."""
    for batch in batches:
        items, texts = [], []
        for text, asked in zip(batch.column("text").to_pylist(), batch.column("asked").to_pylist()):
            own = text.split("\n")
            lines = [own[a["at"]].strip() if a["at"] < len(own) else "" for a in asked]
            hashes = _line_hashes(lines).T
            for a, line, h in zip(asked, lines, hashes):
                if line and (a["h1"], a["h2"]) == (int(h[0]), int(h[1])):
                    items.append(a["item"])
                    texts.append(line)
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(texts, pa.string())], ["item", "text"])


def _shortened(text: str, gone: set[int]) -> tuple[str, int, int]:
    """A text without lines that it repeats and those numbered in `gone`; how many lines it has, and how many go."""
    lines = text.split("\n")
    first: dict[str, int] = {}
    named = {}
    for i, line in enumerate(lines):
        line = line.strip()
        if line:
            named[i] = first.setdefault(line, i) == i and i not in gone
    n = sum(named.values())
    return text if n == len(named) else "\n".join([line for i, line in enumerate(lines) if named.get(i, True)]), len(named), len(named) - n


def _without(text: Column, lost: Column) -> Column:
    """Struct (text, n_lines, n_removed): a text without lines that it repeats and those numbered in `lost`."""

    @tidy
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, numbers in batches:
            rows = [(None, 0, 0) if t is None else _shortened(t, set() if gone is None else set(gone.tolist())) for t, gone in zip(texts, numbers)]
            yield pd.DataFrame(rows, columns=["text", "n_lines", "n_removed"])

    # Filters of callers would otherwise be pushed below it, with a copy of it and a second set of workers for them.
    return F.pandas_udf(cut, "text string, n_lines long, n_removed long").asNondeterministic()(text, lost)


def _mean_size(df: DataFrame, lists: str) -> int:
    return int(df.agg(F.avg(F.size(lists))).first()[0] or 0) + 1


def lost_lines(df: DataFrame, named: dict[str, Column], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(*named, lost): for each document the numbers of its lines that stand elsewhere, or in like form, already."""
    by = list(named)
    source = df.select(*[c.alias(n) for n, c in named.items()], F.col(text).cast("string").alias("text")).filter("text IS NOT NULL")
    names = [f"k{b}" for b in range(BANDS)]
    run, schema = _occurring(True, by)
    found = source.mapInArrow(run, schema)
    # The least document and the line there; of an id alone without a struct, which hash aggregates cannot hold.
    lead = F.min(F.struct(*by, "line")) if len(by) > 1 else F.struct(F.min("doc").alias("doc"), F.min_by("line", "doc").alias("line"))
    # Copies of a line combine before the shuffle: a line that all documents share costs one row a task.
    same = found.groupBy("h1", "h2").agg(lead.alias("lead"), F.count(F.lit(1)).alias("copies"), *[F.min(c).alias(c) for c in ("n", *names)])
    items = same.select(F.monotonically_increasing_id().alias("item"), "h1", "h2", "lead", "copies", "n", F.array(*names).alias("keys"))
    items = cut_lineage(items, "lines")

    def texts(wanted: DataFrame) -> DataFrame:
        asked = items.join(small(wanted, 8), "item").groupBy(*[F.col(f"lead.{c}").alias(c) for c in by])
        asked = asked.agg(F.collect_list(F.struct("item", F.col("lead.line").alias("at"), "h1", "h2")).alias("asked"))
        asked = cut_lineage(asked, "asked")
        return source.join(small(asked, 8 + 8 * len(by) + 32 * _mean_size(asked, "asked")), by).select("text", "asked").mapInArrow(_asked_lines, "item long, text string")

    edges = cut_lineage(links(items, texts, line_shingles, threshold, sized=False, likeness=line_likeness).select("u", "v"), "links")
    roots = components(edges)
    members = roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
    members = cut_lineage(items.select(F.col("item").alias("node"), "h1", "h2", "lead").join(small(members, 16), "node"), "members")
    stays = members.groupBy("root").agg(F.min(F.struct("lead", "node")).alias("kept"))
    goes = members.join(stays, "root").filter(F.col("node") != F.col("kept.node"))
    # Lines that go wherever they stand, and those that stay where they stood first; a line may be in both.
    fate = ["h1", "h2", *[F.col(f"lead.{c}").alias(f"first_{c}") for c in by]]
    fates = goes.select(*fate, F.lit(True).alias("goes")).unionAll(items.filter("copies > 1").select(*fate, F.lit(False).alias("goes")))
    run, schema = _occurring(False, by)
    again = source.mapInArrow(run, schema)
    elsewhere = reduce(or_, [F.col(c) != F.col(f"first_{c}") for c in by])
    lost = again.join(fates, ["h1", "h2"]).filter(F.col("goes") | elsewhere)
    return lost.groupBy(*by).agg(F.collect_set(F.col("line").cast("int")).alias("lost"))


@keeps_names
def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Every row of `df`, its text without duplicate lines, and n_lines and n_removed.

    Lines are compared without the white space around them; blank ones stay where they are. Two are
    alike if the Jaccard similarity of their runs of eight characters is at least `threshold`; a
    shorter line is one run. Of the lines that such links connect, across the corpus and within a
    text, that of the least document id, and there the first, stays; null is the least id, and of
    several texts with one id the order is that of their hashes.

    Null texts stay null and have no lines. Rows are documents of their own, also those of equal or
    null ids; only rows equal in id and text count as one: they keep the same lines. A text that loses every line keeps its row. Columns of `df`
    named n_lines or n_removed are replaced. An empty table gives no rows.
    """
    named = _named(df, key, text)
    lost = cut_lineage(lost_lines(df, named, text, threshold), "lost")
    lost = lost.select(*[F.col(c).alias(f"__{c}") for c in lost.columns])
    made = (text, "n_lines", "n_removed")
    kept = others(df, ("n_lines", "n_removed"))
    rows = df.select(*kept, *[c.alias(f"__{n}") for n, c in named.items()])
    # The list of lost lines goes to the texts if its size allows, else both are shuffled by document.
    joined = rows.join(small(lost, 8 + 8 * len(named) + 4 * _mean_size(lost, "__lost")), [f"__{n}" for n in named], "left")
    cut = joined.withColumn("__cut", _without(F.col(text).cast("string"), F.col("__lost")))
    order = [F.col("__cut.text").alias(text) if c.lower() == text.lower() else F.col(f"`{c}`") for c in df.columns if c.lower() not in made[1:]]
    return cut.select(*order, "__cut.n_lines", "__cut.n_removed")
