"""Whole flows: bronze to gold for a date range, training, scoring.

Each step covers the whole range in one pass; there is no loop over dates. A step reads the
tables the step before has written, so a lost executor never costs more than one step.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from riskmart.operators import bronze, gold, modeling, scoring, silver
from riskmart.schemas import CUSTOMER, SNAPSHOT
from riskmart.session import cut_lineage, scratch_scope
from riskmart.sources import store

FEATURE_SOURCES = ("clickstream", "attributes", "financials")


def _write(df: DataFrame, root: str, name: str, start: str | date | None, end: str | date | None) -> dict[str, int]:
    """Replace the snapshots of the range, those that are now empty too."""
    counted, rows = store.observed(df, name)
    store.write_snapshots(counted, f"{root}/{name}", replace=store.days(start, end))
    return {name: rows.get["rows"]}


def _table(spark: SparkSession, root: str, name: str, start: str | date | None, end: str | date | None) -> DataFrame:
    return store.between(store.read_table(spark, f"{root}/{name}"), start, end)


def ingest_snapshot(source: DataFrame, name: str, root: str, day: str | date) -> int:
    """Bronze for one snapshot of one source; returns its row count."""
    return bronze.ingest(source, name, f"{root}/bronze", day, day).get["rows"]


def backfill_features(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    start: str | date | None = None,
    end: str | date | None = None,
    version: int = 2,
) -> dict[str, int]:
    """Bronze, silver and gold of the feature sources; row counts of every table written.

    Version 2 joins the static features of all snapshots the silver tables hold, also those
    outside the range.
    """
    clean = {
        "clickstream": silver.clickstream,
        "attributes": silver.attributes,
        "financials": lambda df: silver.financials(df, version=version),
    }

    def build(name: str) -> dict[str, int]:
        rows = bronze.ingest(sources[name], name, f"{root}/bronze", start, end).get["rows"]
        cleaned = clean[name](_table(spark, f"{root}/bronze", name, start, end))
        return {f"bronze/{name}": rows} | _write(cleaned, root, f"silver/{name}", start, end)

    # The sources do not depend on each other: a small one need not wait for a large one.
    counts: dict[str, int] = {}
    with ThreadPoolExecutor(len(FEATURE_SOURCES)) as pool:
        for written in pool.map(inheritable_thread_target(spark)(build), FEATURE_SOURCES):
            counts |= written
    clicks, attributes, financials = (_table(spark, f"{root}/silver", n, start, end) for n in FEATURE_SOURCES)
    with scratch_scope(spark):
        if version >= 2:
            attributes, financials = (store.read_table(spark, f"{root}/silver/{n}") for n in ("attributes", "financials"))
            if start is not None or end is not None:
                attributes = gold.attributes_needed(attributes, clicks, start, end)
            # Both branches of the store read the static features: join them once.
            static = cut_lineage(gold.static_features(attributes, financials), "static")
            features = gold.feature_store_v2(clicks, static, start, end)
        else:
            features = gold.feature_store_v1(clicks, attributes, financials)
        return counts | _write(features, root, "gold/feature_store", start, end)


def _known(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    return store.read_table(spark, f"{root}/{name}") if store.newest(spark, f"{root}/{name}") else None


def _replace_days(df: DataFrame, root: str, name: str, days: set[date]) -> None:
    """Publish the rows of some snapshots, of which there may be none."""
    listed = {str(d) for d in days}
    store.write_snapshots(df.filter(store.on_days(days)), f"{root}/{name}", replace=lambda day: day in listed)


def _days_of(df: DataFrame) -> set[date]:
    return {r[0] for r in df.select(SNAPSHOT).distinct().collect()}  # one row for each snapshot


def refresh_features(spark: SparkSession, sources: Mapping[str, DataFrame], root: str) -> dict[str, list[date]]:
    """Bring bronze, silver and version 2 of gold up to date with the sources; snapshots rewritten in each table.

    A source's snapshot is rebuilt if its digest is not the one stored with the last refresh, also if it is new or gone. A
    snapshot of gold is rebuilt if its own sources changed, and if it has clicks of a customer whose static features
    were or are in a changed snapshot. What gold owes is written down before anything else changes and crossed out at
    the end, digests last, so a run that dies is made up for by the next.
    """
    static = ("attributes", "financials")
    found = {name: dict(map(tuple, store.snapshot_digests(sources[name]).collect())) for name in FEATURE_SOURCES}  # one row for each snapshot
    known: dict[str, dict[date, str]] = {name: {} for name in FEATURE_SOURCES}
    before = _known(spark, root, "digests")
    for r in before.collect() if before is not None else ():
        known[r["source"]][r[SNAPSHOT]] = r["digest"]
    stale = {n: {d for d in found[n].keys() | known[n].keys() if found[n].get(d) != known[n].get(d)} for n in FEATURE_SOURCES}
    owed = set().union(*stale.values())
    earlier = _known(spark, root, "owed")
    if earlier is not None:
        owed |= _days_of(earlier)

    def clicked_by_changed() -> set[date]:
        clicks, tables = _known(spark, root, "silver/clickstream"), {n: _known(spark, root, f"silver/{n}") for n in static}
        changed = [t.filter(store.on_days(stale[n])).select(CUSTOMER) for n, t in tables.items() if t is not None and stale[n]]
        if clicks is None or not changed:
            return set()
        return _days_of(clicks.join(reduce(DataFrame.unionAll, changed).distinct(), CUSTOMER, "left_semi"))

    if not owed:
        return {}
    owed |= clicked_by_changed()
    store.write_snapshots(spark.createDataFrame([(d,) for d in sorted(owed)], f"{SNAPSHOT} date").withColumn("owed", F.lit(True)), f"{root}/owed")
    clean = {"clickstream": silver.clickstream, "attributes": silver.attributes, "financials": silver.financials}
    written: dict[str, list[date]] = {}
    for name in FEATURE_SOURCES:
        if stale[name]:
            listed = {str(d) for d in stale[name]}
            rows = sources[name].filter(store.on_days(stale[name]))
            bronze.write_load(rows, f"{root}/bronze/{name}", bronze.BATCH, inside=lambda day, listed=listed: day in listed)
            raw = store.read_table(spark, f"{root}/bronze/{name}").filter(store.on_days(stale[name]))
            _replace_days(clean[name](raw), root, f"silver/{name}", stale[name])
            written |= dict.fromkeys((f"bronze/{name}", f"silver/{name}"), sorted(stale[name]))
    owed |= clicked_by_changed()
    with scratch_scope(spark):
        clicks, attributes, financials = (store.read_table(spark, f"{root}/silver/{n}") for n in FEATURE_SOURCES)
        clicks = clicks.filter(store.on_days(owed))
        needed = gold.attributes_needed(attributes, clicks, None, None, owed)
        features = gold.feature_store_v2(clicks, cut_lineage(gold.static_features(needed, financials), "static"))
        _replace_days(features, root, "gold/feature_store", owed)
    written["gold/feature_store"] = sorted(owed)
    digests = [(n, d, x) for n in FEATURE_SOURCES for d, x in found[n].items()]
    everything = store.days(None, None)
    store.write_snapshots(spark.createDataFrame(digests, f"source string, {SNAPSHOT} date, digest string"), f"{root}/digests", replace=everything)
    store.write_snapshots(spark.createDataFrame([], f"owed boolean, {SNAPSHOT} date"), f"{root}/owed", replace=everything)
    return written


def backfill_labels(
    spark: SparkSession,
    loans: DataFrame,
    root: str,
    start: str | date | None = None,
    end: str | date | None = None,
    dpd: int = 30,
    mob: int = 6,
) -> dict[str, int]:
    """Bronze, silver and gold of the loans; row counts of every table written."""
    counts = {"bronze/loans": bronze.ingest(loans, "loans", f"{root}/bronze", start, end).get["rows"]}
    counts |= _write(silver.loans(_table(spark, f"{root}/bronze", "loans", start, end)), root, "silver/loans", start, end)
    labels = gold.label_store(_table(spark, f"{root}/silver", "loans", start, end), dpd, mob)
    return counts | _write(labels, root, "gold/label_store", start, end)


def train_model(
    labels: DataFrame, features: DataFrame, train_date: str | date, bank: str, **search: int
) -> modeling.Trained:
    """Train on the calendar before `train_date` and put the model into the bank.

    `search` sets draws, folds and grid.
    """
    with scratch_scope(labels.sparkSession):
        trained = modeling.train(modeling.training_set(labels, features, train_date), train_date, **search)
        modeling.save_model(trained, bank)
    return trained


def score_range(
    features: DataFrame,
    bank: str,
    version: str,
    root: str,
    start: str | date | None = None,
    end: str | date | None = None,
) -> DataFrame:
    """Score the snapshots from `start` to `end` with a banked model, store the predictions and return them."""
    model = modeling.load_model(bank, version, features.sparkSession)
    path = f"{root}/gold/model_predictions"
    scoring.write_predictions(scoring.score(model, features, version, start, end), path, version, start, end)
    stored = store.read_table(features.sparkSession, path).filter(F.col("model_name") == version)
    return store.between(stored, start, end)
