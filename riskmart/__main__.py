"""Command line for spark-submit: one job per call, one snapshot or a range of them.

    python -m riskmart ingest   --root R --source loans --path loans.csv --snapshotdate 2024-01-01
    python -m riskmart features --root R --data D [--start 2023-01-01 --end 2024-12-01]
    python -m riskmart labels   --root R --data D [--start ... --end ...]
    python -m riskmart train    --root R --snapshotdate 2024-09-01
    python -m riskmart score    --root R --snapshotdate 2024-09-01 --modelname credit_model_2024_09_01
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from riskmart.functions.cleaning import enforce_schema
from riskmart.operators import modeling
from riskmart.plans import jobs
from riskmart.schemas import CLICKSTREAM_TYPES, SOURCES, raw_schema
from riskmart.session import SETTINGS
from riskmart.sources import store

# File names of the sources.
FILES = {
    "loans": "lms_loan_daily.csv",
    "clickstream": "feature_clickstream.csv",
    "attributes": "feature_attributes.csv",
    "financials": "feature_financials.csv",
}


def read_csv(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Source files under their declared schema, columns in the order of each header."""
    return store.read_source(spark, path, raw_schema(name))


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="riskmart")
    parser.add_argument("job", choices=["ingest", "features", "labels", "train", "score"])
    parser.add_argument("--root", required=True, help="root of the mart")
    parser.add_argument("--data", help="folder of the source files")
    parser.add_argument("--source", choices=list(SOURCES))
    parser.add_argument("--path")
    parser.add_argument("--snapshotdate", help="YYYY-MM-DD")
    parser.add_argument("--start")
    parser.add_argument("--end")
    parser.add_argument("--modelname")
    parser.add_argument("--draws", type=int, default=modeling.DRAWS)
    options = parser.parse_args(arguments)

    builder = SparkSession.builder.appName("riskmart")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    start, end = options.start or options.snapshotdate, options.end or options.snapshotdate

    if options.job == "ingest":
        frame = read_csv(spark, options.source, options.path)
        print(jobs.ingest_snapshot(frame, options.source, options.root, options.snapshotdate))
    elif options.job == "features":
        sources = {n: read_csv(spark, n, f"{options.data}/{FILES[n]}") for n in jobs.FEATURE_SOURCES}
        print(jobs.backfill_features(spark, sources, options.root, start, end))
    elif options.job == "labels":
        print(jobs.backfill_labels(spark, read_csv(spark, "loans", f"{options.data}/{FILES['loans']}"), options.root, start, end))
    else:
        clicks = enforce_schema(store.read_table(spark, f"{options.root}/bronze/clickstream"), CLICKSTREAM_TYPES)
        bank = f"{options.root}/model_bank"
        if options.job == "train":
            labels = store.read_table(spark, f"{options.root}/gold/label_store")
            trained = jobs.train_model(labels, clicks, options.snapshotdate, bank, draws=options.draws)
            trained.card.show(truncate=False)
        else:
            jobs.score_range(clicks, bank, options.modelname, options.root, start, end)


if __name__ == "__main__":
    main()
