"""Mixes sources to target weights: exact block quotas, split over output shards by a tree.

Every pass over a source orders its documents by a hash and cuts them into blocks. Quotas say how many
blocks of each source the mix takes. A binary tree over the shards divides them: a node draws how many
blocks of each source go left from the multivariate hypergeometric distribution, so every shard gets its
share of blocks, composed as if all blocks had been shuffled, and sums stay exact. Which blocks a shard
gets follows from a keyed permutation of each source's blocks: disjoint, and known without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmart.llm.common import keeps_names, n_words, others, text_of
from riskmart.session import cut_lineage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
KEY = "doc_id"
BLOCKS_PER_SHARD = 64
#: A mix names its sources: their table, a few numbers each, is held by the driver and every worker.
MOST_SOURCES = 1_000_000
_SPACE = 1 << 62
_BUCKETS = 4096


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    target: float
    #: passes that take every document, then documents up to this hash, -1 for none
    passes: int
    upto: int
    blocks: int

    @property
    def partial(self) -> int:
        """Blocks of the last pass, its last block cut at `upto`."""
        return 0 if self.upto < 0 else int(_slice(np.array([self.upto]), self.blocks)[0]) + 1

    @property
    def quota(self) -> int:
        return self.passes * self.blocks + self.partial


@dataclass(frozen=True)
class Plan:
    sources: tuple[Source, ...]
    shards: int
    seed: int


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """`share` of all sizes by weight; a target stops at `most` times its size, and the others share the excess."""
    total = share * sum(sizes)
    full: set[int] = set()
    while True:
        rest = total - sum(most * sizes[i] for i in sorted(full))
        weight = sum(w for i, w in enumerate(weights) if i not in full)
        given = [most * s if i in full else rest * w / weight for i, (s, w) in enumerate(zip(sizes, weights))]
        over = {i for i, (s, g) in enumerate(zip(sizes, given)) if i not in full and g > most * s}
        if not over:
            return given
        full |= over
        if len(full) == len(sizes):
            return [most * s for s in sizes]


def _slice(hashes: np.ndarray, blocks: int | np.ndarray) -> np.ndarray:
    """Block of a hash: equal slices of the hash space."""
    return np.minimum(np.floor(hashes / _SPACE * blocks), blocks - 1).astype(np.int64)


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser, keyed."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((key * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def permuted(at: np.ndarray, n: int, key: int) -> np.ndarray:
    """Images of positions under a keyed permutation of range(n): a Feistel network that walks cycles back into range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            left, right = right, left ^ (_mixed(right, key * 4 + r) & mask)
        return (left << np.uint64(half)) | right

    x = once(at.astype(np.uint64))
    out = x >= n
    while out.any():
        x[out] = once(x[out])
        out = x >= n
    return x.astype(np.int64)


@lru_cache(maxsize=4)
def shard_offsets(quotas: tuple[int, ...], shards: int, seed: int) -> np.ndarray:
    """[shard, source]: blocks of the source in the shards before it, from the splitting tree."""
    counts = np.zeros((shards, len(quotas)), dtype=np.int64)
    waiting = [(0, shards, np.array(quotas, dtype=np.int64))]
    while waiting:
        low, high, own = waiting.pop()
        if high - low == 1:
            counts[low] = own
            continue
        middle = (low + high) // 2
        total = int(own.sum())
        # Blocks before shard k: floor(k * all / shards), so siblings differ by one block at most.
        every = sum(quotas)
        left = middle * every // shards - low * every // shards
        drawn = np.random.Generator(np.random.Philox(key=seed, counter=[low, high, 0, 0])).multivariate_hypergeometric(own, min(left, total), method="marginals") if total else own
        waiting += [(low, middle, drawn), (middle, high, own - drawn)]
    return np.concatenate([np.zeros((1, len(quotas)), dtype=np.int64), counts.cumsum(axis=0)])


def _keyed(df: DataFrame, source: str, text: str, seed: int, size: Column | None) -> DataFrame:
    """Source, size and hash of every row; rows equal in id, source and text have one hash."""
    value = text_of(text)
    return df.withColumns(
        {
            "__source": F.col(source).cast("string"),
            "__size": n_words(value) if size is None else size.cast("long"),
            "__hash": F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(c) for c in (KEY, source, text) if c in df.columns]), 2),
        }
    )


def plan(df: DataFrame, source: str = "source", text: str = "text", weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, shards: int | None = None, seed: int = 11, size: Column | None = None) -> Plan:
    """What the mix takes of every source.

    Sources are ordered by code point, null last, and weigh `weights`, repeating. A target is met
    by whole passes over the source and one that stops at the document whose middle is nearest: its
    hash is found exactly, from sums over 4096 slices of the hash space and then the documents of
    one slice. Sums combine before they are shuffled, so a source with a third of all rows is spread.
    """
    spark = df.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sized = cut_lineage(_keyed(df, source, text, seed, size).select("__source", "__size", "__hash"), "mix_sizes")
    rows = sized.groupBy("__source").agg(F.sum("__size").alias("size")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows = sorted(rows, key=lambda r: (r["__source"] is None, (r["__source"] or "").encode("utf-8")))
    sizes = [r["size"] or 0 for r in rows]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], share, most)
    block = max(1.0, sum(wanted) / (BLOCKS_PER_SHARD * shards))
    passes = [min(int(t // s), int(most)) if s else 0 for t, s in zip(wanted, sizes)]
    rest = [t - p * s for t, p, s in zip(wanted, passes, sizes)]
    upto = _cut_hashes(sized, [(r["__source"], x) for r, x, p in zip(rows, rest, passes) if x > 0 and p < most])
    return Plan(
        tuple(
            Source(r["__source"], s, t, p, upto.get(r["__source"], -1), max(1, round(s / block)))
            for r, s, t, p in zip(rows, sizes, wanted, passes)
        ),
        shards,
        seed,
    )


def _local(spark: SparkSession, rows: Sequence[tuple], **kinds: pa.DataType) -> DataFrame:
    """A table of the driver's rows. By Arrow: of plain rows, Spark would make a task with a second set of Python workers."""
    return spark.createDataFrame(pa.table(dict(zip(kinds, zip(*rows, strict=True), strict=True)), pa.schema(list(kinds.items()))))


def _cut_hashes(sized: DataFrame, rest: Sequence[tuple[str | None, float]]) -> dict[str | None, int]:
    """For each source the last hash of a pass that takes about so many words."""
    if not rest:
        return {}
    spark = sized.sparkSession
    # One row for each source.
    words = F.broadcast(_local(spark, rest, name=pa.string(), words=pa.float64()))
    part = F.floor(F.col("__hash") / (_SPACE // _BUCKETS)).alias("part")
    slices = sized.groupBy("__source", part).agg(F.sum("__size").alias("size"))
    before = Window.partitionBy("__source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = slices.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    same = F.col("__source").eqNullSafe(F.col("name"))
    crossed = placed.join(words, same).filter((F.col("before") < F.col("words")) & (F.col("before") + F.col("size") >= F.col("words")))
    crossed = crossed.select("name", "part", F.col("before").alias("slice_before"), "words").collect()
    if not crossed:
        return {}
    found = F.broadcast(_local(spark, crossed, name=pa.string(), part=pa.int64(), slice_before=pa.int64(), words=pa.float64()))
    inside = sized.withColumn("p", part).join(found, same & (F.col("p") == F.col("part")))
    # Documents of one slice in 4096 of a source. Those with one hash go together.
    by_hash = inside.groupBy("name", "__hash", "slice_before", "words").agg(F.sum("__size").alias("size"))
    earlier = Window.partitionBy("name").orderBy("__hash").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("slice_before") + F.coalesce(F.sum("size").over(earlier), F.lit(0)) + F.col("size") / 2
    taken = by_hash.withColumn("middle", middle).groupBy("name").agg(
        F.max(F.when(F.col("middle") <= F.col("words"), F.col("__hash"))).alias("upto"), F.min("__hash").alias("first")
    )
    # With no document of the slice taken, the pass ends just before its first one.
    return {r["name"]: r["upto"] if r["upto"] is not None else r["first"] - 1 for r in taken.collect()}


@keeps_names
def draws(df: DataFrame, mix: Plan, source: str = "source", text: str = "text", size: Column | None = None) -> DataFrame:
    """Adds size, source_size, target and draws, an array of (epoch, shard), to every row.

    No shuffle: a row's passes, its blocks and their shards follow from its hash and the plan.
    Rows that are equal in id, source and text have one hash and are
    drawn together; null sources are a source of their own, null texts have no words.
    """
    return _drawn(df, mix, source, text, size).drop("__rank")


def _drawn(df: DataFrame, mix: Plan, source: str, text: str, size: Column | None) -> DataFrame:
    """`draws` with the hash that ranks a row."""
    found = df.sparkSession.sparkContext.broadcast(mix)

    def drawn(names: pd.Series, hashes: pd.Series) -> pd.DataFrame:
        made = found.value
        sources = made.sources
        index = {s.name: i for i, s in enumerate(sources)}
        offsets = shard_offsets(tuple(s.quota for s in sources), made.shards, made.seed)
        own = np.array([index[n if isinstance(n, str) else None] for n in names], dtype=np.int64)
        h = hashes.to_numpy(dtype=np.int64)
        out: list[list[dict]] = [[] for _ in own]
        for i in np.unique(own):
            s = sources[i]
            rows = np.flatnonzero(own == i)
            for epoch in range(s.passes + (s.partial > 0)):
                if epoch == s.passes:
                    rows = rows[h[rows] <= s.upto]
                    at = _slice(h[rows], s.blocks)
                else:
                    at = _slice((_mixed(h[rows], made.seed + epoch) >> np.uint64(2)).astype(np.int64), s.blocks)
                place = permuted(epoch * s.blocks + at, s.quota, made.seed * 131 + int(i))
                shard = np.searchsorted(offsets[:, i], place, side="right") - 1
                for r, x in zip(rows.tolist(), shard.tolist()):
                    out[r].append({"epoch": epoch, "shard": x})
        return pd.DataFrame({"source_size": [sources[i].size for i in own], "target": [sources[i].target for i in own], "draws": out})

    # Spark's filter of empty lists would otherwise be pushed below it, with a copy of it and a second set of workers for that.
    drawn = F.pandas_udf(drawn, "source_size long, target double, draws array<struct<epoch:int,shard:int>>").asNondeterministic()
    keyed = _keyed(df, source, text, mix.seed, size)
    kept = others(df, ("size", "source_size", "target", "draws"))
    return keyed.withColumn("__d", drawn("__source", "__hash")).select(*kept, F.col("__size").alias("size"), "__d.source_size", "__d.target", "__d.draws", F.col("__hash").alias("__rank"))


@keeps_names
def mixed(df: DataFrame, mix: Plan, source: str = "source", text: str = "text", size: Column | None = None) -> DataFrame:
    """The mix: every row as often as it is drawn, shard k in partition k, shuffled inside.

    Keeps the columns of `df`, but for those that `draws` makes, and adds epoch and shard. The one shuffle moves each drawn row once;
    a hot source's blocks are spread over all shards by the tree.
    """
    rows = _drawn(df, mix, source, text, size)
    rows = rows.select(*others(df, ("epoch", "shard", "size", "source_size", "target", "draws")), F.inline("draws"), "__rank")
    rank = F.xxhash64(F.lit(mix.seed), "epoch", "__rank")
    dealt = rows.withColumn("__rank", rank).repartitionById(mix.shards, F.col("shard")).sortWithinPartitions("shard", "__rank")
    return dealt.drop("__rank")
