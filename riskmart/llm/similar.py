"""Exact links between similar sets, from nodes in which they may meet; shared by the two operators that
search near copies.

An item is a set of 64-bit hashes; `keys` are the nodes (buckets, trie prefixes) it stands in. Pairs that
share a node are compared exactly, in the first node they share, and nowhere are pairs written out: a
comparison's result is one row for each item, with the number of its links and an edge to its local
component. Crowded nodes are cut into blocks, and each pair of blocks is a cell, a task's unit of work with
bounded memory; a cell is compared by matrix products where it holds many pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import tidy
from riskmart.session import cut_lineage

#: A block holds at most about this many items and this many hashes.
BLOCK_ITEMS = 512
BLOCK_HASHES = 500_000
#: Columns and rows of a matrix product.
COLUMNS = 1024
STRIP = 128
#: Places of a matrix of sorted stretches.
CELLS = 1 << 16
#: Characters of texts whose sets are made together.
TEXTS = 250_000
#: A table of up to this many bytes is sent to all executors; a larger one is joined by a shuffle.
SENT_BYTES = 32_000_000

Shingler = Callable[[Sequence[str]], list[np.ndarray]]
#: Similarities of the texts 0 and 1, 2 and 3, and so on.
Likeness = Callable[[Sequence[str]], np.ndarray]


def finalised(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=32)
def multipliers(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit constants. All callers share them."""
    return np.random.Generator(np.random.Philox(key=seed)).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def set_hash(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set, whatever the order of its values."""
    return tuple(np.add.reduceat(finalised(values * m), starts).view(np.int64) for m in multipliers(2, 97))


def sorted_rows(values: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches of `values`, `count` long each, sorted many at a time: (which, [stretch, place], whether a place holds a value).

    Stretches of about the same length share a matrix of at most CELLS places, or one stretch; places behind a stretch's
    values come last.
    """
    order = np.argsort(count, kind="stable")
    length = count[order]
    starts = (np.cumsum(count) - count)[order]
    low = 0
    while low < len(order):
        high = int(np.searchsorted(length, length[low] * 5 // 4 + 4, side="right"))
        high = min(high, max(low + 1, low + CELLS // max(int(length[high - 1]), 1)))
        place = np.arange(length[high - 1])
        inside = place < length[low:high, None]
        matrix = values.take(starts[low:high, None] + place, mode="clip")
        np.copyto(matrix, np.iinfo(np.uint64).max, where=~inside)
        matrix.sort(axis=1)
        yield order[low:high], matrix, inside
        low = high


def distinct(values: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
    """The different values of each stretch, sorted."""
    sets: list = [None] * len(count)
    for which, matrix, inside in sorted_rows(values, count):
        inside[:, 1:] &= matrix[:, 1:] != matrix[:, :-1]
        flat, ends = matrix[inside], np.cumsum(inside.sum(axis=1)).tolist()
        for i, low, high in zip(which.tolist(), [0, *ends], ends):
            sets[i] = flat[low:high]
    return sets


def likeness_of_two(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Jaccard similarity of the values of the stretches 0 and 1, 2 and 3, and so on, repeats and all; the lowest bit of a value is lost.

    In its place stands whose a value is: sorted together, a value that both have is where only that bit changes.
    """
    values = values & ~np.uint64(1)
    values |= np.repeat(np.arange(len(count), dtype=np.uint64) & np.uint64(1), count)
    alike = np.zeros(len(count) // 2)
    for which, matrix, inside in sorted_rows(values, count[::2] + count[1::2]):
        change = matrix[:, 1:] ^ matrix[:, :-1]
        change *= inside[:, 1:]
        alike[which] = np.count_nonzero(change == 1, axis=1) / (1 + np.count_nonzero(change > 1, axis=1))
    return alike


def shared_by_two(sets: Sequence[np.ndarray]) -> np.ndarray:
    """How many values the sets 0 and 1 share, 2 and 3, and so on."""
    size = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    shared = np.zeros(len(sets) // 2, dtype=np.int64)
    for which, matrix, inside in sorted_rows(np.concatenate(sets), size[::2] + size[1::2]):
        shared[which] = ((matrix[:, 1:] == matrix[:, :-1]) & inside[:, 1:]).sum(axis=1)
    return shared


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table, marked to be broadcast if its measured size allows."""
    return F.broadcast(df) if df.count() * row_bytes <= SENT_BYTES else df


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table | pa.RecordBatch, np.ndarray | None]]:
    """Runs of rows with the same (key, i, j); rows come sorted, and a cell may span batches.

    Yields (rows of a cell, None), and for each batch (the batch, first rows of its cells of two): most
    cells are that small, and those are worked on together.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "i", "j")])
        starts = np.concatenate([[0], 1 + np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)), [batch.num_rows]])
        first = tuple(cell[:, 0].tolist())
        if held and (first != last or len(starts) > 2):
            if first == last:
                held.append(batch.slice(0, starts[1]))
                starts = starts[1:]
            yield pa.Table.from_batches(held), None
            held = []
        size = np.diff(starts[:-1])  # all but the last cell end in this batch
        if (size == 2).any():
            yield batch, starts[:-2][size == 2]
        for x in np.flatnonzero(size > 2).tolist():
            yield pa.Table.from_batches([batch.slice(starts[x], size[x])]), None
        last = tuple(cell[:, -1].tolist())
        held.append(batch.slice(starts[-2], starts[-1] - starts[-2]))
    if held:
        yield pa.Table.from_batches(held), None


def _couples(batch: pa.RecordBatch, at: np.ndarray, threshold: float, sized: bool) -> np.ndarray:
    """`_meeting` for cells of two rows, all at once: the first rows of those to compare."""
    keys = batch.column("keys").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    tree, n, block, i, j = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "n", "block", "i", "j"))
    before = np.arange(keys.shape[1])[None, :] < tree[at][:, None]
    meet = ~((keys[at] == keys[at + 1]) & before).any(axis=1) & ((i[at] == j[at]) | (block[at] != block[at + 1]))
    if sized:
        x, y = n[at].astype(np.float64), n[at + 1].astype(np.float64)
        meet &= np.minimum(x, y) >= threshold * np.maximum(x, y) * (1 - 1e-12)
    return at[meet]


def _numbers(cell: pa.Table, name: str) -> np.ndarray:
    return cell.column(name).to_numpy()


def _strips(m: int) -> Iterator[slice]:
    """Rows of a matrix of pairs, some at a time: what is computed for them stays small."""
    return (slice(low, min(low + STRIP, m)) for low in range(0, m, STRIP))


def _meeting(cell: pa.Table, threshold: float, sized: bool) -> np.ndarray:
    """[a, b], a < b: whether this is the first node the two share, and their sizes allow the similarity."""
    m = cell.num_rows
    keys = cell.column("keys").combine_chunks().flatten().to_numpy().reshape(m, -1)
    tree = int(cell.column("tree")[0].as_py())
    pairs = np.triu(np.ones((m, m), dtype=bool), 1)
    n = _numbers(cell, "n").astype(np.float64)
    block = _numbers(cell, "block")
    across = cell.column("i")[0] != cell.column("j")[0]
    for rows in _strips(m):
        part = pairs[rows]
        for t in range(tree):
            part &= keys[rows, t][:, None] != keys[:, t][None, :]
        if sized:
            part &= np.minimum(n[rows, None], n[None, :]) >= threshold * np.maximum(n[rows, None], n[None, :]) * (1 - 1e-12)
        if across:
            part &= block[rows, None] != block[None, :]
    return pairs


def _close(sets: list[np.ndarray], pairs: np.ndarray, threshold: float) -> np.ndarray:
    """[a, b]: the pairs whose Jaccard similarity is at least `threshold`."""
    m = len(sets)
    size = np.array([s.size for s in sets])
    close = np.zeros((m, m), dtype=bool)
    if 0 < np.count_nonzero(pairs) <= 2 * m:
        a, b = np.nonzero(pairs)
        shared = shared_by_two([sets[i] for i in np.stack([a, b], axis=1).ravel().tolist()])
        close[a, b] = shared / (size[a] + size[b] - shared) >= threshold
        return close
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(values)
    values, owner = values[order], owner[order]
    column = np.cumsum(np.concatenate([[True], values[1:] != values[:-1]])) - 1
    common = np.bincount(column)[column] > 1
    owner, column = owner[common], column[common]
    column = np.cumsum(np.diff(column, prepend=column[:1]) != 0)
    total = np.zeros((m, m), dtype=np.float32)  # counts below 2^24 are exact
    for low in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        # Columns are in order, and so are those of a range.
        here = slice(*np.searchsorted(column, (low, low + COLUMNS)))
        part = np.zeros((m, COLUMNS), dtype=np.float32)
        part[owner[here], column[here] - low] = 1
        for rows in _strips(m):
            total[rows] += part[rows] @ part.T
    for rows in _strips(m):
        shared = total[rows].astype(np.float64)
        close[rows] = pairs[rows] & (shared / (size[rows, None] + size[None, :] - shared) >= threshold)
    return close


def _roots(linked: np.ndarray) -> np.ndarray:
    """Least member of each one's component; `linked` is symmetric."""
    root = np.full(len(linked), -1)
    for first in range(len(linked)):
        if root[first] >= 0:
            continue
        edge = np.zeros(len(linked), dtype=bool)
        edge[first] = True
        while edge.any():
            root[edge] = first
            edge = linked[edge].any(axis=0) & (root < 0)
    return root


def links(items: DataFrame, texts: Callable[[DataFrame], DataFrame], shingler: Shingler, threshold: float, sized: bool = True, likeness: Likeness | None = None) -> DataFrame:
    """(u, v, n_links) for every item that has links: v is an item of its component, n_links counts copies too.

    `items` is a stored table (item, n, copies, keys) of different sets, n their sizes (bounds on
    them if not `sized`), copies how many rows have the set, keys as many for each. `texts` takes a table of items and returns (item, text)
    of them, and `shingler` makes their sets again; `likeness`, if given, compares texts that stand alone
    in a node without making sets. Only items that have a pair to compare are
    fetched. Rows of one item may be many, one for each cell it has links in.
    """
    # Most nodes hold one item: only keys move to find the others, and only entries of those go on.
    entries = items.select("item", "n", F.posexplode("keys").alias("tree", "key"))
    shared = cut_lineage(entries.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("key"), "nodes")
    entries = cut_lineage(entries.join(small(shared, 16), "key"), "entries")
    nodes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("hashes"))
    parts = F.greatest(F.ceil(F.col("members") / BLOCK_ITEMS), F.ceil(F.col("hashes") / BLOCK_HASHES))
    placed = entries.join(items.select("item", "keys", "copies"), "item").join(nodes.select("key", parts.alias("parts")), "key")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("item"), F.col("parts")))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    cells = dealt.select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.col("tree").cast("int").alias("tree"), "block", "item", "n", "keys", "copies"
    )
    cell = ["key", "i", "j"]

    @tidy
    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members with a pair to compare."""
        out, rows = [], 0
        for group, couples in _cells(batches):
            if couples is not None:
                at = _couples(group, couples, threshold, sized)
                if at.size:
                    yield group.take(pa.array(np.sort(np.concatenate([at, at + 1]))))
                continue
            pairs = _meeting(group, threshold, sized)
            wanted = pairs.any(axis=0) | pairs.any(axis=1)
            if wanted.any():
                out.append(group.filter(pa.array(wanted)))
                rows += out[-1].num_rows
            if rows > 20_000:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
                out, rows = [], 0
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    kept = cells.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(prune, cells.schema)
    kept = cut_lineage(kept, "cells")
    wanted = cut_lineage(kept.select("item").distinct(), "wanted")
    fetched = texts(wanted).dropDuplicates(["item"])
    full = kept.join(fetched, "item")

    def by_sets(both: Sequence[str]) -> np.ndarray:
        sets = shingler(both)
        shared = shared_by_two(sets)
        return shared / (np.array([x.size + y.size for x, y in zip(sets[::2], sets[1::2])]) - shared)

    alike = likeness or by_sets

    def of_couples(batch: pa.RecordBatch, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Links of cells of two rows, some texts at a time."""
        item, copies = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("item", "copies"))
        both = batch.column("text").take(pa.array(np.stack([at, at + 1], axis=1).ravel())).to_pylist()
        low, size = 0, 0
        for k in range(len(at)):
            size += len(both[2 * k]) + len(both[2 * k + 1])
            if size < TEXTS and k + 1 < len(at):
                continue
            one = at[low : k + 1][alike(both[2 * low : 2 * k + 2]) >= threshold]
            yield np.concatenate([item[one], item[one + 1]]), np.tile(item[one], 2), np.concatenate([copies[one + 1], copies[one]])
            low, size = k + 1, 0

    def of_cells(groups: Sequence[tuple[pa.Table, np.ndarray, list[str]]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Links of other cells, each with its pairs and texts, whose sets are made together."""
        sets = shingler([x for _, _, own in groups for x in own])
        high = 0
        for group, pairs, own in groups:
            low, high = high, high + len(own)
            close = _close(sets[low:high], pairs, threshold)
            close |= close.T
            some = np.flatnonzero(close.any(axis=1))
            item, copies = _numbers(group, "item"), _numbers(group, "copies")
            if some.size:
                near = np.concatenate([close[rows] @ copies for rows in _strips(len(close))])
                yield item[some], item[_roots(close)[some]], near[some]

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        waiting, size = [], 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)], ["u", "v", "n_links"])

        for group, couples in _cells(batches):
            if couples is not None:
                found += of_couples(group, _couples(group, couples, threshold, sized))
            else:
                pairs = _meeting(group, threshold, sized)
                if not pairs.any():
                    continue
                waiting.append((group, pairs, group.column("text").to_pylist()))
                size += sum(map(len, waiting[-1][2]))
                if size < TEXTS:
                    continue
                found += of_cells(waiting)
                waiting, size = [], 0
            if sum(len(x[0]) for x in found) > 20_000:
                yield rows()
                found.clear()
        if waiting:
            found += of_cells(waiting)
        if found:
            yield rows()

    return full.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(compare, "u long, v long, n_links long")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Union-find over a graph that no machine holds: (node, root), root the least node of the component.

    Rounds of two steps, each a grouped minimum and a join: a node's larger neighbours are linked to
    its least one, then its smaller ones are. Trees turn into stars in a logarithmic number of rounds.
    Edges (u, v) are rows; loops stand for single nodes and are dropped. Each round is stored.
    """
    links_ = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    links_ = cut_lineage(links_, "edges")
    seen = None
    for _ in range(rounds):
        state = tuple(links_.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == seen or not state[0]:
            return links_.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        both = links_.unionAll(links_.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Every edge now leads from a node to a smaller one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links_ = cut_lineage(rest.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    raise RuntimeError("components did not settle")
