"""Training data, scaling, training, search, evaluation and the model bank."""

from __future__ import annotations

import itertools
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.ml import Transformer
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmart.calendar import TrainingWindows, training_windows
from riskmart.operators import boosting
from riskmart.schemas import CUSTOMER, LOAN, SNAPSHOT
from riskmart.session import cut_lineage, scratch_path, scratch_scope
from riskmart.sources import store

SPLIT_SEED = 88
#: Rows that one task ranks at most, digits of the hash looked at in one level of the descent, and all digits.
SLICE_ROWS = 1 << 17
DIGITS = 3
HASH_DIGITS = 32
TRAIN_SHARE = 0.8
FOLDS = 3
DRAWS = 100
PARALLELISM = 4
#: Up to so many rows the models on all rows grow in the passes of the search.
GROWN_ALONG = 1_000_000

# The search grid, 1,728 points. Names are those of `boosting.Params`.
SEARCH_GRID: dict[str, list] = {
    "maxIter": [25, 50],
    "maxDepth": [2, 3],
    "stepSize": [0.01, 0.1],
    "subsamplingRate": [0.6, 0.8],
    "featureSubsetStrategy": [0.6, 0.8],
    "minInfoGain": [0.0, 0.1],
    "minChildWeight": [1, 3, 5],
    "regAlpha": [0, 0.1, 1],
    "regLambda": [1, 1.5, 2],
}
# The part of it that Spark's own estimator has, under its names.
ESTIMATOR_GRID: dict[str, list] = {
    **{name: SEARCH_GRID[name] for name in ("maxIter", "maxDepth", "stepSize", "subsamplingRate")},
    "featureSubsetStrategy": ["0.6", "0.8"],
    "minInfoGain": [0.0, 0.1],
    "minInstancesPerNode": [1, 3, 5],
}
SEARCH_SEED = 42


def feature_columns(df: DataFrame, prefix: str = "fe_") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def key_hash(seed: int | str, keys: Sequence[str]) -> Column:
    """md5 of seed and key as text: the same under any partitioning, no shuffle."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def hash_bucket(seed: int | str, keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.conv(F.substring(key_hash(seed, keys), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def _slices(rows: DataFrame, share: float) -> DataFrame:
    """Descends to the slice of each label's hashes in which the row lies that ends its `share`: (of_label, lead, rank, n).

    A level counts the rows that begin like the slice found so far by their next DIGITS digits, at most 16^DIGITS groups a
    label, and a running count picks the one with the wanted row, until every slice has at most SLICE_ROWS rows or
    is a single hash. A label whose share rounds to no row has no slice.
    """
    label = F.col("label").eqNullSafe(F.col("of_label"))
    total = F.count(F.lit(1)).alias("n")
    found = rows.groupBy(F.col("label").alias("of_label")).agg(total).select(
        "of_label", F.lit("").alias("lead"), F.round(F.col("n") * F.lit(share)).cast("long").alias("rank"), "n"
    )
    found = cut_lineage(found.filter("rank > 0"), "slices")
    for digits in range(0, HASH_DIGITS, DIGITS):
        if (found.agg(F.max("n")).first()[0] or 0) <= SLICE_ROWS:
            break
        inside = rows.join(F.broadcast(found.drop("n")), label & F.col("hash").startswith(F.col("lead")))  # one row for each label
        counted = inside.groupBy("of_label", "rank", F.substring("hash", 1, digits + DIGITS).alias("lead")).agg(total)
        running = counted.withColumn("seen", F.sum("n").over(Window.partitionBy("of_label").orderBy("lead")))
        before = F.col("seen") - F.col("n")
        picked = running.filter((F.col("seen") >= F.col("rank")) & (before < F.col("rank")))
        found = cut_lineage(picked.select("of_label", "lead", (F.col("rank") - before).alias("rank"), "n"), "slices")
    return found


def _last_hashes(rows: DataFrame, share: float) -> DataFrame:
    """(of_label, last): the hash up to which `share` of the label's rows lie, exact to a row.

    Hashes are stored once; only the rows of a slice are ranked, so no task sorts more than SLICE_ROWS rows, but for
    rows of one hash, which need no order. One row for each label comes to the driver.
    """
    spark = rows.sparkSession
    with scratch_scope(spark):
        stored = cut_lineage(rows.select("label", "hash"), "hashes")
        found = _slices(stored, share)
        label = F.col("label").eqNullSafe(F.col("of_label"))
        inside = stored.join(F.broadcast(found), label & F.col("hash").startswith(F.col("lead")))
        # Equal hashes are one row with a count; the running count is the rank of their last row.
        counted = inside.groupBy("of_label", "rank", "hash").agg(F.count(F.lit(1)).alias("n"))
        seen = F.sum("n").over(Window.partitionBy("of_label").orderBy("hash"))
        first = counted.withColumn("before", seen - F.col("n")).filter(F.col("before") < F.col("rank"))
        last = first.groupBy("of_label").agg(F.max("hash").alias("last"))
        return spark.createDataFrame(last.collect(), last.schema)


def assign_split(
    df: DataFrame,
    windows: TrainingWindows,
    keys: Sequence[str] = (LOAN, SNAPSHOT),
    train_share: float = TRAIN_SHARE,
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """`split`: oot by date; of the other rows of each label exactly `train_share`, by a hash of the key, train.

    Rows are as many as the share says, rounded; only rows with equal keys may add to that.
    """
    day = F.col(SNAPSHOT)
    earlier = day.between(windows.train_test_start, windows.train_test_end)
    rows = df.filter(earlier).select("label", key_hash(seed, keys).alias("hash"))
    last = F.broadcast(_last_hashes(rows, train_share))  # one row for each label
    split = F.when(day.between(windows.oot_start, windows.oot_end), "oot").when(
        earlier, F.when(key_hash(seed, keys) <= F.col("last"), "train").otherwise("test")
    )
    return df.join(last, F.col("label").eqNullSafe(F.col("of_label")), "left").select(*df.columns, split.alias("split"))


def training_set(labels: DataFrame, features: DataFrame, train_date: str | date | Column) -> DataFrame:
    """Labels of the training calendar with the features of the same customer and snapshot.

    Splits are given to the labels, before the join. The feature store has a row for each key, so a
    hot key can only be on the left, where adaptive execution splits it.
    """
    windows = training_windows(train_date)
    labels, features = [store.between(df, windows.train_test_start, windows.oot_end) for df in (labels, features)]
    marked = assign_split(labels, windows).join(features, [CUSTOMER, SNAPSHOT], "left")
    return marked.select(*[c for c in marked.columns if c != "split"], "split")


def split_stats(df: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), F.avg("label").alias("default_rate"))


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per feature; missing values (null or NaN) were ignored."""

    mean: Mapping[str, float]
    deviation: Mapping[str, float]

    def expression(self, c: str) -> str:
        return f"(NANVL(CAST(`{c}` AS DOUBLE), NULL) - {self.mean[c]!r}D) / {self.deviation[c]!r}D"

    def apply(self, df: DataFrame) -> DataFrame:
        """Replace the features by their scaled values; missing stays missing."""
        return df.select(*[F.expr(self.expression(c)).alias(c) if c in self.mean else F.col(c) for c in df.columns])

    def stages(self) -> list[Transformer]:
        """Scaling, missing flags and the feature vector as savable pipeline stages.

        A missing feature becomes the mean, which is 0 after scaling, with its flag set.
        """
        z = {c: f"__z_{c}" for c in self.mean}
        missing = {c: f"__missing_{c}" for c in self.mean}
        statement = ", ".join(
            [f"COALESCE({self.expression(c)}, 0.0D) AS `{z[c]}`" for c in z]
            + [f"CAST(NANVL(CAST(`{c}` AS DOUBLE), NULL) IS NULL AS DOUBLE) AS `{missing[c]}`" for c in missing]
        )
        return [
            SQLTransformer(statement=f"SELECT *, {statement} FROM __THIS__"),
            VectorAssembler(inputCols=[*z.values(), *missing.values()], outputCol="features"),
        ]


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> Scaler:
    """One aggregate over the training rows; two numbers per feature come back."""
    known = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns}
    stats = train.agg(
        *[F.avg(v).alias(f"m_{c}") for c, v in known.items()],
        *[F.stddev_pop(v).alias(f"s_{c}") for c, v in known.items()],
    ).first()
    # A constant or empty feature is only centred.
    return Scaler({c: stats[f"m_{c}"] or 0.0 for c in columns}, {c: stats[f"s_{c}"] or 1.0 for c in columns})


def auc_by_split(scored: DataFrame, score: str, label: str = "label") -> DataFrame:
    """(split, auc): exact area under the ROC curve of every split, ties counted half, in one pass.

    Null where a split lacks a class; rows without a score or label do not count. Scores are counted
    by class, ranges of them are sorted apart, and the negatives below a range come from a running
    sum over the ranges: no task holds a split.
    """
    value, positive = F.col(score).cast("double"), F.col(label).cast("double")
    known = scored.filter(value.isNotNull() & ~F.isnan(value) & positive.isNotNull())
    return auc_of_counts(known.select("split", value.alias("score"), positive.alias("pos"), (1 - positive).alias("neg")))


def auc_of_counts(counts: DataFrame) -> DataFrame:
    """`auc_by_split` of scores that are counted already, in any number of rows: (split, score, pos, neg)."""
    counted = counts.groupBy("split", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # Stored, so that a range keeps its number when a lost task is run again.
    ranged = cut_lineage(counted.repartitionByRange("split", "score").withColumn("part", F.spark_partition_id()), "scores")
    # One row for each split and range.
    parts = ranged.groupBy("split", "part").agg(F.sum("neg").alias("n"))
    earlier = Window.partitionBy("split").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("split", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0.0)).alias("before"))
    lower = Window.partitionBy("split", "part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("before") + F.coalesce(F.sum("neg").over(lower), F.lit(0.0))
    sums = (
        ranged.join(parts, ["split", "part"])
        .withColumn("wins", F.col("pos") * (below + F.col("neg") / 2))
        .groupBy("split")
        .agg(F.sum("wins").alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    return sums.select("split", F.try_divide("wins", F.col("pos") * F.col("neg")).alias("auc"))


def auc(scored: DataFrame, score: str, label: str = "label") -> float | None:
    """AUC of all rows as one split; null without both classes."""
    with scratch_scope(scored.sparkSession):
        row = auc_by_split(scored.withColumn("split", F.lit("all")), score, label).first()
    return row["auc"] if row else None


def gini(area: float | None) -> float | None:
    return None if area is None else round(2 * area - 1, 3)


def auc_gini(scored: DataFrame, score: str, splits: Sequence[str] = ("train", "test", "oot")) -> DataFrame:
    """AUC and Gini of a score on each split; null for a split that lacks a class or has no rows."""
    asked = scored.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in splits])).alias("split"))
    areas = asked.join(F.broadcast(auc_by_split(scored, score)), "split", "left")  # one row for each split
    return areas.select("split", F.round("auc", 6).alias("auc"), F.round(2 * F.col("auc") - 1, 3).alias("gini"))


def draw_points(draws: int, grid: Mapping[str, Sequence], seed: int = SEARCH_SEED) -> list[dict]:
    """`draws` different points of the grid."""
    points = list(itertools.product(*grid.values()))
    return [dict(zip(grid, point)) for point in random.Random(seed).sample(points, min(draws, len(points)))]


def draw_params(
    estimator: GBTClassifier, draws: int, grid: Mapping[str, Sequence] = ESTIMATOR_GRID, seed: int = SEARCH_SEED
) -> list[dict]:
    """`draws` different points of the grid, as parameters of an estimator."""
    return [{estimator.getParam(name): value for name, value in point.items()} for point in draw_points(draws, grid, seed)]


def random_search(
    train: DataFrame,
    draws: int = DRAWS,
    folds: int = FOLDS,
    parallelism: int = PARALLELISM,
    grid: Mapping[str, Sequence] = ESTIMATOR_GRID,
    seed: int = SEARCH_SEED,
    fold_keys: Sequence[str] = (LOAN, SNAPSHOT),
) -> CrossValidatorModel:
    """Cross-validated search with Spark's own estimator, one fit after the other, chosen by AUC of the probability.

    Folds come from a key hash, so a rerun sees the same ones.
    """
    estimator = GBTClassifier(labelCol="label", featuresCol="features", seed=SPLIT_SEED)
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=draw_params(estimator, draws, grid, seed),
        evaluator=BinaryClassificationEvaluator(labelCol="label", numBins=0),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=seed,
    )
    return validator.fit(train.withColumn("fold", hash_bucket(f"{seed}-fold", fold_keys, folds).cast("int")))


@dataclass(frozen=True)
class Search:
    """What a search found: the mean area of each drawn point over the folds (null without both classes), the best point, and its trees on all rows."""

    points: list[dict]
    areas: list[float | None]
    best: dict
    trees: list[boosting.Tree]


@dataclass(frozen=True)
class Binned:
    """Training rows in blocks, the features' names and the ends of their bins."""

    blocks: DataFrame
    columns: list[str]
    edges: list[list[float]]
    rows: int


def binned(train: DataFrame, columns: Sequence[str], folds: int = 1, seed: int = SEARCH_SEED, keys: Sequence[str] = (LOAN, SNAPSHOT)) -> Binned:
    """Rows cut into bins once, with their fold and a hash for sampling, both from the key: a rerun gives the same ones."""
    edges = boosting.bin_edges(train, columns)
    fold = hash_bucket(f"{seed}-fold", keys, folds)
    row_hash = F.xxhash64(F.lit(seed), *[F.col(k).cast("string") for k in keys])
    made = boosting.blocks(train, columns, edges, F.col("label"), fold, row_hash)
    stored = boosting.store_blocks(made, scratch_path(train.sparkSession, "blocks"))
    return Binned(stored, list(columns), edges, stored.agg(F.sum("rows")).first()[0] or 0)


def search_trees(
    data: Binned, draws: int = DRAWS, folds: int = FOLDS, grid: Mapping[str, Sequence] = SEARCH_GRID, seed: int = SEARCH_SEED
) -> Search:
    """Cross-validated search: all draws and folds grow in the same passes over the rows.

    Draws that differ only in the number of trees share a fit. The best mean area wins, the first of equal ones. Its
    trees on all rows are the same however they are grown: up to GROWN_ALONG rows every draw grows on all rows in the
    same passes, since passes cost more than rows; beyond that the best one does, in passes of its own.
    """
    points = draw_points(draws, grid, seed)
    params = [boosting.Params(**p) for p in points]
    longest: dict[boosting.Params, int] = {}
    for p in params:
        key = replace(p, maxIter=0)
        longest[key] = max(p.maxIter, longest.get(key, 0))
    along = data.rows <= GROWN_ALONG
    fits = [boosting.Fit(replace(p, maxIter=n), k) for p, n in longest.items() for k in range(-1 if along else 0, folds)]
    place = {(replace(f.params, maxIter=0), f.fold): i for i, f in enumerate(fits)}
    found: dict[str, float | None] = {}

    def measure(rounds: int):
        names: dict[int, list[str]] = {}
        for d, p in enumerate(params):
            if p.maxIter == rounds:
                for k in range(folds):
                    names.setdefault(place[replace(p, maxIter=0), k], []).append(f"{d}|{k}")

        def run(blocks: DataFrame) -> None:
            counts = boosting.held_out(blocks, fits, len(data.columns), names)
            found.update((r["split"], r["auc"]) for r in auc_of_counts(counts).collect())  # a row for each draw and fold

        return run

    grown = boosting.grow(data.blocks, fits, len(data.columns), seed, {n: measure(n) for n in {p.maxIter for p in params}})
    by_draw = [[found.get(f"{d}|{k}") for k in range(folds)] for d in range(len(points))]
    areas = [None if None in a else sum(a) / folds for a in by_draw]
    best = max(range(len(points)), key=lambda d: (-1.0 if areas[d] is None else areas[d], -d))
    if along:
        trees = grown[place[replace(params[best], maxIter=0), -1]][: params[best].maxIter]
    else:
        (trees,) = boosting.grow(data.blocks, [boosting.Fit(params[best])], len(data.columns), seed)
    return Search(points, areas, points[best], trees)


@dataclass(frozen=True)
class TreeModel:
    """Boosted trees over scaled features, as rows; scoring is one expression."""

    scaler: Scaler
    rows: list[tuple]

    def probability(self, df: DataFrame, name: str) -> DataFrame:
        """`df` with the probability: features are scaled in one projection, the trees read the scaled values."""
        used = sorted({r[2] for r in self.rows if r[2] is not None})
        mark = "_"
        while any(c.lower().startswith(mark) for c in df.columns):
            mark += "_"
        low, high = ({c: f"{mark}{side}{i}" for i, c in enumerate(used)} for side in ("low", "high"))
        scaled = {c: F.expr(self.scaler.expression(c)) for c in used}
        ends = ((low, float("-inf")), (high, float("nan")))
        values = [F.coalesce(scaled[c], F.lit(end)).alias(names[c]) for names, end in ends for c in used]
        margin = boosting.margin(self.rows, low.__getitem__, high.__getitem__)
        columns = [F.col(f"`{c}`") for c in df.columns]
        return df.select(*columns, *values).select(*columns, (1 / (1 + F.exp(-margin))).alias(name))

    def walked(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """`keys` and the probability, as `walk`, by walking the rows of the trees instead of the expression."""
        walked = boosting.walked(self.scaler.apply(df), self.rows, keys, list(self.scaler.mean))
        return walked.select(*keys, (1 / (1 + F.exp(-F.col("margin")))).alias("walk"))


@dataclass(frozen=True)
class Trained:
    model: TreeModel
    card: DataFrame
    version: str


def fit_trees(data: Binned, params: boosting.Params, scaler: Scaler, seed: int = SEARCH_SEED) -> TreeModel:
    """One model on all rows."""
    (trees,) = boosting.grow(data.blocks, [boosting.Fit(params)], len(data.columns), seed)
    return TreeModel(scaler, boosting.tree_rows(trees, data.columns, data.edges))


def train(
    dataset: DataFrame,
    train_date: str | date,
    draws: int = DRAWS,
    folds: int = FOLDS,
    grid: Mapping[str, Sequence] = SEARCH_GRID,
) -> Trained:
    """Scaler, search and best model on the train split; metrics on all splits.

    The dataset is materialised once in reliable storage, and its train rows once more as blocks of bins, which
    boosting reads for every level. A missing feature stays missing: each split learns its side.
    """
    spark = dataset.sparkSession
    features = feature_columns(dataset)
    data = cut_lineage(dataset.withColumn("label", F.col("label").cast("double")), "training")
    fitted_on = data.filter(F.col("split") == "train")
    scaler = fit_scaler(fitted_on, features)
    rows = binned(scaler.apply(fitted_on), features, folds)
    search = search_trees(rows, draws, folds, grid)
    model = TreeModel(scaler, boosting.tree_rows(search.trees, rows.columns, rows.edges))
    version = "credit_model_" + str(train_date).replace("-", "_")
    card = model_card(spark, version, str(train_date), data, model, search)
    return Trained(model, card, version)


CARD_SCHEMA = (
    "model_version string, train_date date, train_test_start_date date, train_test_end_date date, "
    "oot_start_date date, oot_end_date date, "
    "rows map<string,bigint>, default_rate map<string,double>, auc map<string,double>, gini map<string,double>, "
    "hp_params map<string,string>, score_digest string"
)


def model_card(
    spark: SparkSession,
    version: str,
    train_date: str,
    data: DataFrame,
    model: TreeModel,
    search: Search,
) -> DataFrame:
    """One row: version, calendar, split statistics, metrics and the chosen parameters."""
    windows = spark.range(1).select(*training_windows(train_date).columns()).first()
    stats = {r["split"]: r for r in split_stats(data).collect()}  # three rows
    areas = evaluate(model, data, list(stats))
    chosen = {name: str(value) for name, value in search.best.items()}
    row = (
        version,
        date.fromisoformat(train_date),
        *windows,
        {s: r["row_count"] for s, r in stats.items()},
        {s: round(r["default_rate"], 2) for s, r in stats.items()},
        areas,
        {s: gini(a) for s, a in areas.items()},
        chosen,
        score_digest(probability(model, data), (LOAN, SNAPSHOT)),
    )
    return spark.createDataFrame([row], CARD_SCHEMA)


def probability(model: TreeModel, df: DataFrame, name: str = "model_predictions") -> DataFrame:
    """Predicted probability of default, next to the columns of `df`."""
    return model.probability(df, name)


def score_digest(scored: DataFrame, keys: Sequence[str], score: str = "model_predictions") -> str:
    """A digest of all (key, score) rows in any order: their number, and sum and exclusive or of their hashes. One aggregate."""
    row = F.xxhash64(*keys, score)
    total = F.sum(row.cast("decimal(38,0)")).cast("string")
    made = scored.agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.coalesce(total, F.lit("0")), F.coalesce(F.bit_xor(row), F.lit(0)).cast("string")).alias("digest"))
    return made.first()["digest"]


def evaluate(model: TreeModel, data: DataFrame, splits: Sequence[str]) -> dict[str, float | None]:
    """AUC of the probability on each split. A score is never null, so it is counted without a filter that would repeat it."""
    label = F.col("label").cast("double")
    scored = probability(model, data.filter(label.isNotNull()))
    counts = scored.select("split", F.col("model_predictions").alias("score"), label.alias("pos"), (1 - label).alias("neg"))
    with scratch_scope(data.sparkSession):
        areas = {r["split"]: r["auc"] for r in auc_of_counts(counts).collect()}  # one row for each split
    return {s: areas.get(s) for s in splits}


def save_model(trained: Trained, bank: str) -> str:
    """Trees, scaler and card below `bank`/version; saving a version again replaces it."""
    path = f"{bank}/{trained.version}"
    spark, scaler = trained.card.sparkSession, trained.model.scaler
    spark.createDataFrame(trained.model.rows, boosting.TREE_ROWS).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
    numbers = [(c, scaler.mean[c], scaler.deviation[c]) for c in scaler.mean]
    spark.createDataFrame(numbers, "feature string, mean double, deviation double").coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")
    trained.card.write.mode("overwrite").parquet(f"{path}/card")
    return path


def load_model(bank: str, version: str, spark: SparkSession | None = None) -> TreeModel:
    """The rows of trees and scaler, a few thousand, come to the driver and become an expression."""
    spark = spark or SparkSession.active()
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{bank}/{version}/trees").collect())
    scaler = spark.read.parquet(f"{bank}/{version}/scaler").collect()
    return TreeModel(Scaler({r["feature"]: r["mean"] for r in scaler}, {r["feature"]: r["deviation"] for r in scaler}), rows)


def load_card(spark: SparkSession, bank: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{bank}/{version}/card")
