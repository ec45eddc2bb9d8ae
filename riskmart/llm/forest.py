"""Near-copy join of documents: word shingles, banding of MinHash values, exact verification.

A tree is a band: documents meet in it if its first `depth` values are equal. The depth is fixed before data is
read: the longest with which two documents of the least similarity that counts meet in some tree with the
target recall. No tries are built, and no prefix is matched longer where a node is crowded.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import keeps_names, text_of, tidy
from riskmart.llm.similar import components, finalised, links, multipliers, set_hash, small
from riskmart.session import cut_lineage

WORDS = 5
THRESHOLD = 0.8
TREES = 12
LONGEST = 8
RECALL = 0.998
#: Hashes that one step of the signature handles.
STEP = 1 << 16
#: Seeds of the two halves of a text's hash.
_HALVES = {"t1": 3, "t2": 5}
#: Columns that name a row; rows equal in id and text share them.
ROW = ("none", "id", *_HALVES)


def word_shingles(texts: Sequence[str]) -> list[np.ndarray]:
    """Hashes of the different runs of five words of each text, sorted; a shorter text is one run.

    Words are what ASCII white space parts. A text without words has the hash of the empty run.
    """
    step = multipliers(WORDS, 5)
    found = []
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").split()
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
        if len(words) < WORDS:
            value = np.array([len(words)], dtype=np.uint64)
            for x in h:
                value = finalised(value * step[0] + x)
            found.append(value)
            continue
        runs = h[: len(h) - WORDS + 1] * step[0]
        for k in range(1, WORDS):
            runs = runs + h[k : len(h) - WORDS + 1 + k] * step[k]
        found.append(np.unique(finalised(runs)))
    return found


def recall_at(similarity: float, depth: int, trees: int) -> float:
    """Chance that two sets match on a prefix of `depth` values in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def prefix_depth(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES, longest: int = LONGEST) -> int:
    """Shortens the prefix from the longest until the recall at the threshold is met."""
    depth = longest
    while depth > 1 and recall_at(threshold, depth, trees) < recall:
        depth -= 1
    if recall_at(threshold, depth, trees) < recall:
        raise ValueError(f"{trees} trees cannot reach a recall of {recall}")
    return depth


def prefixes(sets: Sequence[np.ndarray], depth: int, trees: int = TREES, seed: int = 17) -> np.ndarray:
    """[set, tree]: the node of the tree's trie that the set's label reaches at `depth`."""
    factor = multipliers(trees * depth, seed)
    values = np.concatenate(sets)
    starts = np.cumsum([0, *[s.size for s in sets[:-1]]])
    out = np.zeros((len(sets), trees), dtype=np.uint64)
    for t in range(trees):
        node = np.full(len(sets), t + 1, dtype=np.uint64)
        for d in range(depth):
            least = np.minimum.reduceat(values * factor[t * depth + d] >> np.uint64(20), starts)
            node = finalised(node * factor[0] + least)
        out[:, t] = node
    return out.view(np.int64)


def _steps(texts: Sequence[str]) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Sets of a few documents at a time, so that signatures stay in the processor's cache."""
    low, sets, size = 0, [], 0
    for i, text in enumerate(texts):
        sets += word_shingles([text])
        size += sets[-1].size
        if size >= STEP:
            yield low, i + 1, sets
            low, sets, size = i + 1, [], 0
    if sets:
        yield low, low + len(sets), sets


def _row(key: str, text: str) -> list[Column]:
    """The columns ROW: whether the id is null, the id with 0 for null, and 128 bits of the text."""
    key_, value = F.col(key).cast("long"), text_of(text)
    return [key_.isNull().alias("none"), F.coalesce(key_, F.lit(0)).alias("id"), *[F.xxhash64(F.lit(seed), value).alias(t) for t, seed in _HALVES.items()]]


def _signed(depth: int, trees: int):
    @tidy
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.select(list(ROW)).columns
            for low, high, sets in _steps(batch.column("text").to_pylist()):
                a, b = set_hash(np.concatenate(sets), np.cumsum([0, *[s.size for s in sets[:-1]]]))
                n = np.array([s.size for s in sets], dtype=np.int64)
                keys = prefixes(sets, depth, trees)
                columns = [*[c.slice(low, high - low) for c in own], *map(pa.array, (a, b, n)), *[pa.array(np.ascontiguousarray(keys[:, t])) for t in range(trees)]]
                yield pa.RecordBatch.from_arrays(columns, [*ROW, "a", "b", "n", *[f"k{t}" for t in range(trees)]])

    return sign


def near_copies(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies), one row for each row of `df`.

    Documents are linked if the Jaccard similarity of their five-word shingles is at least `threshold`.
    class_id is the least id of those that links connect, n_links the number of other rows linked to the
    row, n_copies those among them with the same shingles. Links are exact; one at the threshold is
    found with probability `recall`, and more similar ones more surely.

    Rows with the same set of shingles are one item of the search, so a text that a third of all rows
    share costs one; sums by set combine before they are shuffled. Null texts are empty, and
    all texts without words are copies of each other. Rows with equal ids are separate rows; null ids are
    ordered first and give a null class only where all ids are null. An empty table gives no rows.
    Other columns of `df` are not kept, whatever their names.
    """
    rows, placed = _classes(df, key, text, threshold, recall, trees)
    classes = placed.groupBy("root").agg(F.min("first").alias("kept"))
    named = placed.join(classes, "root").select("a", "b", "copies", "near", F.when(~F.col("kept.none"), F.col("kept.id")).alias("class_id"))
    return (
        rows.select("none", "id", "a", "b")
        .join(named, ["a", "b"])
        .select(F.when(~F.col("none"), F.col("id")).alias(key), "class_id", (F.col("near") + F.col("copies") - 1).alias("n_links"), (F.col("copies") - 1).alias("n_copies"))
    )


def _classes(df: DataFrame, key: str, text: str, threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES) -> tuple[DataFrame, DataFrame]:
    """(*ROW, a, b, ..) of each row, and (a, b, first, copies, root, near) of each set: first is its least row, root names its class."""
    depth = prefix_depth(threshold, recall, trees)
    source = df.select(*_row(key, text), text_of(text).alias("text"))
    names = [f"k{t}" for t in range(trees)]
    schema = "none boolean, " + ", ".join(f"{c} long" for c in (*ROW[1:], "a", "b", "n", *names))
    rows = cut_lineage(source.mapInArrow(_signed(depth, trees), schema), "signed")
    sets = rows.groupBy("a", "b").agg(F.min(F.struct(*ROW)).alias("first"), F.count(F.lit(1)).alias("copies"), *[F.min(c).alias(c) for c in ("n", *names)])
    sets = sets.select(F.monotonically_increasing_id().alias("item"), "a", "b", "first", "copies", "n", F.array(*names).alias("keys"))
    items = cut_lineage(sets, "items")
    # Sets so small that any other set is less similar have no links to search.
    searched = items.filter(F.col("n") >= threshold * (F.col("n") + 1))

    def texts(wanted: DataFrame) -> DataFrame:
        # A row has one set, so it is asked for at most once; only its own copies answer with it.
        asked = cut_lineage(items.join(wanted, "item").select("item", "a", "b", "first.*"), "asked")
        found = source.join(small(asked, 57), list(ROW))
        return found.select("item", "a", "b", "text").mapInArrow(_same_set, "item long, text string")

    linked = cut_lineage(links(searched, texts, word_shingles, threshold), "links")
    roots = components(linked.select("u", "v"))
    degree = linked.groupBy("u").agg(F.sum("n_links").alias("n_links"))
    placed = items.select("item", "a", "b", "first", "copies").join(roots, F.col("item") == F.col("node"), "left").join(degree, F.col("item") == F.col("u"), "left")
    return rows, placed.select("a", "b", "first", "copies", F.coalesce("root", "item").alias("root"), F.coalesce("n_links", F.lit(0)).alias("near"))


@tidy
def _same_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text has the set that is asked for, whatever text has the hash of another."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sets = word_shingles(batch.column("text").to_pylist())
        a, b = set_hash(np.concatenate(sets), np.cumsum([0, *[s.size for s in sets[:-1]]]))
        same = (a == batch.column("a").to_numpy()) & (b == batch.column("b").to_numpy())
        yield batch.filter(pa.array(same)).select(["item", "text"])


@keeps_names
def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of `df` for each class: that of the class's id, and of several texts with it that of the least hash.

    Rows equal in id and text are one choice; the one that stays has the least hash of all its columns.
    A row with a null id stays only in classes of nulls, one in each.
    """
    rows, placed = _classes(df, key, text, **options)
    classes = placed.groupBy("root").agg(F.min("first").alias("kept")).select("kept.*")
    # A row is in one class, so the rows that stay differ; how many equal ones each has comes from the stored hashes.
    kept = cut_lineage(rows.select(*ROW).join(classes, list(ROW)).groupBy(*ROW).agg(F.count(F.lit(1)).alias("times")), "kept")
    columns = [F.col(f"`{c}`") for c in df.columns]
    named = df.select(F.struct(*columns).alias("__row"), *[c.alias(f"__{n}") for n, c in zip(ROW, _row(key, text))])

    def chosen(which: str) -> DataFrame:
        wanted = cut_lineage(kept.filter(which).select(*[F.col(c).alias(f"__{c}") for c in ROW]), "kept")
        return named.join(small(wanted, 32), wanted.columns, "left_semi")

    alone = chosen("times = 1").select("__row.*")
    if kept.filter("times > 1").isEmpty():
        return alone
    # Equal rows combine before the shuffle.
    tie = F.xxhash64(F.to_json(F.struct("__row")))
    equal = chosen("times > 1").groupBy(*[f"__{c}" for c in ROW]).agg(F.min_by("__row", tie).alias("__row"))
    return alone.unionAll(equal.select("__row.*"))
