"""Bronze ingest: source rows into the snapshot-partitioned bronze table, any date range at once."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from riskmart.schemas import SNAPSHOT
from riskmart.sources import store

BATCH = "batch"


def ingest(
    source: DataFrame,
    name: str,
    root: str,
    start: str | date | None = None,
    end: str | date | None = None,
    fmt: str = "parquet",
) -> Observation:
    """Write the snapshots of a source from `start` to `end` to `root`/`name` in one pass.

    Returns the row count of that pass. A bound of None is open; a single snapshot is a range of one
    day. Snapshots of the range that the source no longer has go. What a stream has brought stays.
    """
    counted, rows = store.observed(store.between(source, start, end), f"bronze_{name}")
    write_load(counted, f"{root}/{name}", BATCH, fmt, start, end)
    return rows


def write_load(
    df: DataFrame,
    root: str,
    load: str,
    fmt: str = "parquet",
    start: str | date | None = None,
    end: str | date | None = None,
    inside: Callable[[str], bool] | None = None,
) -> None:
    """Replace what `load` has written before, in the range or on the days that `inside` names, by `df`."""
    inside = inside or store.days(start, end)
    store.write_snapshots(
        df.withColumn(store.LOAD, F.lit(load)),
        root,
        (SNAPSHOT, store.LOAD),
        fmt,
        lambda day, by: by == load and inside(day),
    )
