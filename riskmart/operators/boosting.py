"""Second-order boosted trees on histograms: many fits in one pass over the data.

Features are cut into bins at quantiles. A level of all trees of a round is one pass: each task adds up gradients and
hessians per (fit, node, feature, bin), the sums meet by fit, and the best split of each node comes back as one row.
A fit is a set of parameters and a fold left out; a shorter fit is a prefix of a longer one. Gradients are
whole multiples of 2^-24, so sums are exact and the trees are the same under any partitioning and after any retry.

Rows lie in blocks of a few thousand entries in one binary row. An entry is a row, or neighbours alike in bins, label and
fold: trees cannot tell those apart, so they share a margin and count as often as a sample has them. A block is stored
once for each group of fits, with their margins so far: work is dealt by rows and by fits, and no task holds the margins
of all. Every few rounds the blocks are written anew to the shared folder, so a pass only walks the trees grown since.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.session import file_system, scratch_path

#: Bins of a feature; bin 0 holds missing values.
BINS = 64
#: Entries of a block, at most, and rows that are looked at together to find them.
BLOCK_ROWS = 8192
HELD_ROWS = 1 << 18
#: Fits that share a stored block.
FITS_TOGETHER = 40
#: Bytes of blocks that a task is given, about.
TASK_BYTES = 64 << 20
#: Rounds after which margins are written.
ROUNDS_KEPT = 5
#: Gradients are whole multiples of one by this.
UNIT = float(1 << 24)
#: How far quantiles may be off, as a share of the rows: one by this.
ACCURACY = 10_000


@dataclass(frozen=True)
class Params:
    """Names are those of Spark's own estimator where it has them."""

    maxIter: int = 50
    maxDepth: int = 3
    stepSize: float = 0.1
    subsamplingRate: float = 1.0
    featureSubsetStrategy: float = 1.0
    minInfoGain: float = 0.0
    minChildWeight: float = 1.0
    regAlpha: float = 0.0
    regLambda: float = 1.0


@dataclass
class Tree:
    """Nodes by number: the root is 1, the children of k are 2k (left) and 2k + 1."""

    #: node: (feature, last bin on the left, whether missing values go left)
    splits: dict[int, tuple[int, int, bool]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def walk(self, codes: np.ndarray, wrapped: np.ndarray, at: Callable[[int], float], node: int = 1):
        """`at` of the end each row comes to; codes and codes - 1 (where missing is the largest) by feature."""
        split = self.splits.get(node)
        if split is None:
            return at(node)
        feature, last, missing_left = split
        left = codes[feature] <= last if missing_left else wrapped[feature] < last
        return np.where(left, self.walk(codes, wrapped, at, 2 * node), self.walk(codes, wrapped, at, 2 * node + 1))

    def values(self, codes: np.ndarray, wrapped: np.ndarray) -> np.ndarray:
        """What the tree adds to each margin. Ends are found as small numbers, which are quicker to move than values."""
        value = np.zeros(1 + max((1, *self.splits, *self.leaves)))
        for node, weight in self.leaves.items():
            value[node] = weight
        return value[self.walk(codes, wrapped, np.uint16)]


@dataclass(frozen=True)
class Fit:
    """One model to grow: parameters, and the fold whose rows it does not see (-1: none)."""

    params: Params
    fold: int = -1


def columns_of(tree: int, share: float, features: int, seed: int) -> list[int]:
    """The features that a tree may use."""
    n = max(1, int(share * features + 1e-9))
    return sorted(np.random.default_rng([seed, tree]).permutation(features)[:n].tolist()) if n < features else list(range(features))


def sampled(hashes: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    """Which rows a tree sees, by a hash of row and tree."""
    if share >= 1:
        return np.ones(len(hashes), bool)
    x = hashes ^ np.uint64((0x9E3779B97F4A7C15 * (tree + 1) + seed) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(share * (1 << 64)))


# --- the data


def bin_edges(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Upper ends of the bins of each feature, but for the last: quantiles from Spark's mergeable sketch, in one aggregate."""
    shares = [i / bins for i in range(1, bins)]
    known = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in columns]
    row = df.agg(*[F.percentile_approx(v, shares, ACCURACY).alias(f"q{i}") for i, v in enumerate(known)]).first()
    return [sorted(set(q or [])) for q in row]


_BLOCK = "part int, rows int, codes binary, label binary, fold binary, size binary, hash binary, margins binary"
_NAMES = [c.split(" ")[0] for c in _BLOCK.split(", ")]


def blocks(df: DataFrame, columns: Sequence[str], edges: Sequence[Sequence[float]], label: Column, fold: Column, row_hash: Column) -> DataFrame:
    """Rows as binned blocks; a feature that is null or NaN is missing.

    One shuffle, by ranges of bins, label, fold and hash: rows that are alike come together, and many of them are split by their hash.
    """
    values = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in columns])
    rows = df.select(label.cast("double").alias("label"), fold.cast("int").alias("fold"), row_hash.cast("long").alias("hash"), values.alias("x"))
    limits = [np.asarray(e, float) for e in edges]

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["x"].tolist(), float).reshape(len(batch), len(limits))
            codes = np.zeros(x.shape, np.uint8)
            for f, limit in enumerate(limits):
                codes[:, f] = np.where(np.isnan(x[:, f]), 0, 1 + np.searchsorted(limit, x[:, f], side="left"))
            yield pd.DataFrame({"codes": [c.tobytes() for c in codes], "label": batch["label"].to_numpy(np.uint8), "fold": batch["fold"], "hash": batch["hash"]})

    def entries(held: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(held)
        codes = np.frombuffer(b"".join(rows["codes"]), np.uint8).reshape(len(rows), len(limits))
        label, fold, hashes = rows["label"].to_numpy(np.uint8), rows["fold"].to_numpy(np.int16), rows["hash"].to_numpy(np.int64)
        other = (codes[1:] != codes[:-1]).any(axis=1) | (label[1:] != label[:-1]) | (fold[1:] != fold[:-1])
        starts = np.concatenate([[0], 1 + np.flatnonzero(other), [len(rows)]])
        for lo in range(0, len(starts) - 1, BLOCK_ROWS):
            ends = starts[lo : lo + BLOCK_ROWS + 1]
            at, own = ends[:-1], slice(ends[0], ends[-1])
            size = np.diff(ends).astype(np.int32)
            made = (0, int(size.sum()), codes[at].T.tobytes(), label[at].tobytes(), fold[at].tobytes(), size.tobytes(), hashes[own].tobytes(), b"")
            yield pd.DataFrame([made], columns=_NAMES)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if len(batch):
                held.append(batch)
            if sum(map(len, held)) >= HELD_ROWS:
                yield from entries(held)
                held = []
        if held:
            yield from entries(held)

    alike = ("codes", "label", "fold")
    binned = rows.mapInPandas(coded, "codes binary, label int, fold int, hash long")
    return binned.repartitionByRange(*alike, "hash").sortWithinPartitions(*alike).mapInPandas(build, _BLOCK)


@dataclass
class Block:
    #: Numbers of the fits of its group.
    fits: range
    codes: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    #: Rows of each entry, and the hashes of all of them.
    size: np.ndarray
    hashes: np.ndarray
    margins: np.ndarray

    @classmethod
    def of(cls, row, features: int, fits: int) -> Block:
        n, own = len(row.label), range(row.part * FITS_TOGETHER, min(fits, (row.part + 1) * FITS_TOGETHER))
        margins = np.frombuffer(row.margins, np.float64).reshape(len(own), n) if len(row.margins) else np.zeros((len(own), n))
        return cls(
            own,
            np.frombuffer(row.codes, np.uint8).reshape(features, n),
            np.frombuffer(row.label, np.uint8).astype(float),
            np.frombuffer(row.fold, np.int16),
            np.frombuffer(row.size, np.int32).astype(np.int64),
            np.frombuffer(row.hash, np.int64).view(np.uint64),
            margins,
        )

    def seen(self, tree: int, share: float, seed: int) -> np.ndarray:
        """How many rows of each entry a tree sees."""
        if share >= 1:
            return self.size
        return np.add.reduceat(sampled(self.hashes, tree, share, seed), np.cumsum(self.size) - self.size, dtype=np.int64)


def _read(batches: Iterator[pd.DataFrame], features: int, fits: int) -> Iterator[tuple[object, Block]]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            yield row, Block.of(row, features, fits)


# --- growing


@dataclass
class Forest:
    """Trees of every fit; those from `written` on are not in the blocks' margins yet."""

    fits: Sequence[Fit]
    features: int
    seed: int
    trees: list[list[Tree]]
    written: int = 0

    def recent(self) -> list[list[Tree]]:
        return [t[self.written :] for t in self.trees]


def _histograms(forest: Forest, tree: int, growing: Mapping[int, Tree], level: int):
    """A task's sums of gradients and hessians by fit: arrays [node of the level, feature, bin, 2] of whole numbers."""
    fits, features, seed, recent = forest.fits, forest.features, forest.seed, forest.recent()

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        nodes = 1 << level
        for _, block in _read(batches, features, len(fits)):
            counts: dict[float, np.ndarray] = {}
            views: dict[tuple[float, int], tuple] = {}
            for i in block.fits:
                if i not in growing:
                    continue
                own = growing[i]
                params, fold = fits[i].params, fits[i].fold
                seen = views.get((params.subsamplingRate, fold))
                if seen is None:
                    if params.subsamplingRate not in counts:
                        counts[params.subsamplingRate] = block.seen(tree, params.subsamplingRate, seed)
                    n = counts[params.subsamplingRate]
                    at = np.flatnonzero((n > 0) & (block.fold != fold))
                    codes = np.ascontiguousarray(block.codes[:, at])
                    seen = views[params.subsamplingRate, fold] = at, codes, codes - np.uint8(1), block.label[at], n[at].astype(float)
                at, codes, wrapped, label, n = seen
                margin = block.margins[i - block.fits.start][at]
                for done in recent[i]:
                    margin = margin + done.values(codes, wrapped)
                p = 1 / (1 + np.exp(-margin))
                g, h = np.rint((p - label) * UNIT) * n, np.rint(p * (1 - p) * UNIT) * n
                # Rows that ended in a leaf above the level go to one more node, which is left out.
                ends = own.walk(codes, wrapped, lambda k: np.uint16(k - nodes if k >= nodes else nodes))
                first = np.broadcast_to(ends, len(at)).astype(np.int64) * (BINS + 1)
                made = sums.setdefault(i, np.zeros((nodes, features, BINS + 1, 2)))
                for f in columns_of(tree, params.featureSubsetStrategy, features, seed):
                    place = first + codes[f]
                    for k, weight in enumerate((g, h)):
                        made[:, f, :, k] += np.bincount(place, weight, (nodes + 1) * (BINS + 1))[: nodes * (BINS + 1)].reshape(nodes, BINS + 1)
        for some in _chunks(list(sums.items())):
            yield pd.DataFrame({"fit": [i for i, _ in some], "sums": [made.astype(np.int64).tobytes() for _, made in some]})

    return task


def _chunks(items: list) -> Iterator[list]:
    for lo in range(0, len(items), FITS_TOGETHER):
        yield items[lo : lo + FITS_TOGETHER]


_SPLITS = "fit int, node int, feature int, last int, missing_left boolean, g double, h double, g_left double, h_left double"


def best_splits(sums: np.ndarray, params: Sequence[Params], usable: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each node (feature, last bin on the left, missing goes left, left gradient, left hessian), by the largest gain above 0.

    `sums` is [node, feature, bin, 2], `usable` [node, feature]; the feature is -1 where no split has a gain. Of equal gains the
    first feature counts, then the lowest cut, then missing values on the left.
    """
    weight, alpha, lam, least = (
        np.array([getattr(p, name) for p in params], float)[:, None, None, None] for name in ("minInfoGain", "regAlpha", "regLambda", "minChildWeight")
    )
    total = sums[np.arange(len(sums)), usable.argmax(axis=1)].sum(axis=1)[:, None, None, None, :]
    ahead = np.cumsum(sums[:, :, 1:, :], axis=2)
    left = np.stack([ahead + sums[:, :, :1, :], ahead], axis=3)  # [node, feature, cut, side of missing, 2]
    right = total - left

    def score(x: np.ndarray) -> np.ndarray:
        g = np.maximum(np.abs(x[..., 0]) - alpha, 0)
        return g * g / (x[..., 1] + lam)

    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (score(left) + score(right) - score(total)) - weight
    hl, hr = left[..., 1], right[..., 1]
    allowed = (hl >= least) & (hr >= least) & (hl > 0) & (hr > 0) & usable[:, :, None, None]
    gain = np.where(allowed, gain, -np.inf)
    flat = gain.reshape(len(sums), -1)
    best = flat.argmax(axis=1)
    at = np.arange(len(sums))
    feature, cut, side = np.unravel_index(best, gain.shape[1:])
    g, h = np.moveaxis(left[at, feature, cut, side], -1, 0)
    return np.where(flat[at, best] > 0, feature, -1), cut + 1, side == 0, g, h


def _splits(forest: Forest, tree: int, level: int):
    """Adds up the sums of each fit, as they arrive, and finds the best split of each node."""
    fits, features, seed = forest.fits, forest.features, forest.seed

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch["fit"].tolist(), batch["sums"]):
                part = np.frombuffer(part, np.int64)
                sums[i] = sums[i] + part if i in sums else part
        nodes = 1 << level
        for some in _chunks(sorted(sums.items())):
            params = [fits[i].params for i, _ in some for _ in range(nodes)]
            usable = np.zeros((len(params), features), bool)
            for k, p in enumerate(params):
                usable[k, columns_of(tree, p.featureSubsetStrategy, features, seed)] = True
            made = np.concatenate([flat.reshape(nodes, features, BINS + 1, 2) for _, flat in some]) / UNIT
            g, h = np.moveaxis(made[np.arange(len(made)), usable.argmax(axis=1)].sum(axis=1), -1, 0)
            fit, node = np.repeat([i for i, _ in some], nodes), np.tile(np.arange(nodes, 2 * nodes), len(some))
            best = best_splits(made, params, usable)
            columns = (fit, node, *best[:3], g, h, *best[3:])
            yield pd.DataFrame(dict(zip([c.split(" ")[0] for c in _SPLITS.split(", ")], columns)))[h > 0]

    return task


def _weight(g: float, h: float, params: Params) -> float:
    g = math.copysign(max(abs(g) - params.regAlpha, 0.0), g)
    return -g / (h + params.regLambda) * params.stepSize if g else 0.0


def _grow_round(data: DataFrame, forest: Forest, tree: int) -> None:
    """One tree for every fit that still grows; a pass for each level."""
    grown = {i: Tree() for i, fit in enumerate(forest.fits) if fit.params.maxIter > tree}
    open_nodes = {i: {1} for i in grown}
    for level in range(max(forest.fits[i].params.maxDepth for i in grown)):
        growing = {i: t for i, t in grown.items() if open_nodes[i] and forest.fits[i].params.maxDepth > level}
        if not growing:
            break
        partial = data.mapInPandas(_histograms(forest, tree, growing, level), "fit int, sums binary")
        rows = partial.repartition("fit").mapInPandas(_splits(forest, tree, level), _SPLITS).collect()  # a row for each fit and node
        following: dict[int, set[int]] = {i: set() for i in growing}
        for r in rows:
            i, node, params = r["fit"], r["node"], forest.fits[r["fit"]].params
            if node not in open_nodes[i]:
                continue
            if r["feature"] < 0:
                grown[i].leaves[node] = _weight(r["g"], r["h"], params)
                continue
            grown[i].splits[node] = r["feature"], r["last"], r["missing_left"]
            for child, g, h in ((2 * node, r["g_left"], r["h_left"]), (2 * node + 1, r["g"] - r["g_left"], r["h"] - r["h_left"])):
                grown[i].leaves[child] = _weight(g, h, params)
                following[i].add(child)
            grown[i].leaves.pop(node, None)
        open_nodes.update(following)
    for i, t in grown.items():
        forest.trees[i].append(t)


def _advanced(forest: Forest):
    """Blocks with the margins of the recent trees added."""
    fits, features, recent = forest.fits, forest.features, forest.recent()

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row, block in _read(batches, features, len(fits)):
            wrapped = block.codes - np.uint8(1)
            margins = np.empty(block.margins.shape)
            for k, i in enumerate(block.fits):
                margin = block.margins[k]
                for done in recent[i]:
                    margin = margin + done.values(block.codes, wrapped)
                margins[k] = margin
            yield pd.DataFrame([row._replace(margins=margins.tobytes())])

    return task


def grow(data: DataFrame, fits: Sequence[Fit], features: int, seed: int, at: Mapping[int, Callable[[DataFrame], None]] | None = None) -> list[list[Tree]]:
    """Trees of every fit over `blocks`. `at` is called with the blocks, margins included, after the rounds it names."""
    at = at or {}
    forest = Forest(fits, features, seed, [[] for _ in fits])
    spark, stored = data.sparkSession, None
    rounds = max((f.params.maxIter for f in fits), default=0)
    data = _dealt(data, len(fits))
    for tree in range(rounds):
        _grow_round(data, forest, tree)
        done = tree + 1
        if done in at or (done < rounds and done - forest.written >= ROUNDS_KEPT):
            before, stored = stored, scratch_path(spark, "margins")
            data = store_blocks(data.mapInPandas(_advanced(forest), _BLOCK), stored)
            forest.written = done
            if before:  # margins of earlier rounds are of no more use
                system, where = file_system(spark, before)
                system.delete(where, True)
        if done in at:
            at[done](data)
    return forest.trees


def _dealt(data: DataFrame, fits: int) -> DataFrame:
    """A block for each group of fits, in as many tasks as their margins will need, or as there are cores."""
    groups = -(-fits // FITS_TOGETHER)
    fixed = sum(F.length(c) for c in ("codes", "label", "fold", "size", "hash"))
    n, entries, held = data.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("label")), F.lit(0)), F.coalesce(F.sum(fixed), F.lit(0))).first()
    stored = n * groups
    size = entries * 8 * fits + held * groups
    tasks = max(1, min(stored, data.sparkSession.sparkContext.defaultParallelism), -(-size // TASK_BYTES))
    parts = data.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(max(groups, 1) - 1))))
    dealt = parts.select(*[F.col(c) for c in _NAMES]).repartition(tasks)
    return store_blocks(dealt, scratch_path(data.sparkSession, "dealt"))


def store_blocks(data: DataFrame, path: str) -> DataFrame:
    """Blocks written to `path` and read back. Rows are large: the writer looks at its memory after each."""
    data.write.options(**{"parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}).parquet(path)
    return data.sparkSession.read.parquet(path)


def held_out(data: DataFrame, fits: Sequence[Fit], features: int, names: Mapping[int, Sequence[str]]) -> DataFrame:
    """(split, score, pos, neg): for the fits in `names`, margins of the rows each did not see, counted by class, under each of its names."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, block in _read(batches, features, len(fits)):
            for k, i in enumerate(block.fits):
                out = block.fold == fits[i].fold
                score, place = np.unique(block.margins[k][out], return_inverse=True)
                pos = np.bincount(place, block.label[out] * block.size[out], len(score))
                neg = np.bincount(place, (1 - block.label[out]) * block.size[out], len(score))
                for name in names.get(i, ()):
                    yield pd.DataFrame({"split": name, "score": score, "pos": pos, "neg": neg})

    return data.mapInPandas(task, "split string, score double, pos double, neg double")


# --- models


TREE_ROWS = "tree int, node int, feature string, cut double, missing_left boolean, value double"


def tree_rows(trees: Sequence[Tree], columns: Sequence[str], edges: Sequence[Sequence[float]]) -> list[tuple]:
    """Trees as rows: a split sends values up to `cut` to node 2k, the others to 2k + 1; a leaf has a value."""
    rows = []
    for t, tree in enumerate(trees):
        for node, (feature, last, missing_left) in tree.splits.items():
            cut = edges[feature][last - 1] if last <= len(edges[feature]) else math.inf
            rows.append((t, node, columns[feature], float(cut), missing_left, None))
        rows += [(t, node, None, None, None, float(v)) for node, v in tree.leaves.items()]
    return sorted(rows, key=lambda r: r[:2])


def margin(rows: Sequence[tuple], low: Callable[[str], str], high: Callable[[str], str]) -> Column:
    """The trees as one expression, which Spark compiles.

    `low` and `high` give the SQL of a feature, never null: minus infinity for a missing value, or NaN, which Spark
    orders behind every number. A split reads the one that sends missing values to its side.
    """
    nodes = {(r[0], r[1]): r for r in rows}

    def written(tree: int, node: int) -> str:
        _, _, feature, cut, missing_left, leaf = nodes[tree, node]
        if feature is None:
            return f"{leaf!r}D"
        limit = "double('Infinity')" if math.isinf(cut) else f"{cut!r}D"
        value = (low if missing_left else high)(feature)
        return f"IF({value} <= {limit}, {written(tree, 2 * node)}, {written(tree, 2 * node + 1)})"

    total = F.lit(0.0)
    for tree in sorted({r[0] for r in rows}):
        total = total + F.expr(written(tree, 1))
    return total


def walked(df: DataFrame, rows: Sequence[tuple], keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """`keys` and the margin of each row of `df`, by walking the stored rows of the trees, level by level."""
    shape = 1 + max(r[0] for r in rows), 1 + max(r[1] for r in rows)
    feature, cut, side, value = np.full(shape, -1), np.zeros(shape), np.zeros(shape, bool), np.zeros(shape)
    for tree, node, name, *at in rows:
        if name is None:
            value[tree, node] = at[2]
        else:
            feature[tree, node], cut[tree, node], side[tree, node] = list(columns).index(name), at[0], at[1]
    depth = (shape[1] - 1).bit_length() - 1
    x = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(f"x{i}") for i, c in enumerate(columns)]
    numbered = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *x)
    schema = T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys] + [T.StructField("margin", T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([batch.column(f"x{i}").to_numpy(zero_copy_only=False) for i in range(len(columns))]).reshape(len(columns), batch.num_rows)
            each, margins = np.arange(batch.num_rows), np.zeros(batch.num_rows)
            for tree in range(shape[0]):
                at = np.ones(batch.num_rows, np.int64)
                for _ in range(depth):
                    used = feature[tree, at]
                    v = x[used, each]
                    left = np.where(np.isnan(v), side[tree, at], v <= cut[tree, at])
                    at = np.where(used < 0, at, 2 * at + ~left)
                margins += value[tree, at]
            yield pa.RecordBatch.from_arrays([*[batch.column(f"k{i}") for i in range(len(keys))], pa.array(margins)], [*keys, "margin"])

    return numbered.mapInArrow(task, schema)
