"""Bronze ingest of newly arrived files as a stream that stops when it has caught up.

For sources that grow by files: the checkpoint remembers which files were read, so each run reads
only new ones. A micro-batch is written by the batch writer as a load of its own, named after stream
and batch; one that is run again replaces itself, so a run that dies is resumed without loss or double
rows, and batch ingests of the same table keep what streams have brought. No state is kept.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha1

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskmart.operators.bronze import write_load
from riskmart.sources import store


def arriving(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "csv", **options: str) -> DataFrame:
    """The files of a folder as a stream under a declared schema; a CSV file whose header differs from it fails."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.options(header=True, enforceSchema=False)
    return reader.options(**options).load(folder)


def arriving_files(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """The names of a folder's files as a stream of `path`; what is in them is not read."""
    listed = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.schema(listed).format("binaryFile").options(**options).load(folder).select("path")


def by_header(schema: T.StructType, **options: str) -> Callable[[DataFrame], DataFrame]:
    """For `ingest_available`: the rows of a batch of CSV files, their columns found by name in each file's own header.

    Headers are read in the cluster, a first line for each file; then the files are read once. A file without a
    declared column fails the batch, which stays to be done again.
    """

    def rows(batch: DataFrame) -> DataFrame:
        # As many names as the stream took into the batch; its log holds them as well.
        files = [store.literal_path(r.path) for r in batch.collect()]
        return store.read_source(batch.sparkSession, files, schema, **options)

    return rows


def ingest_available(arrivals: DataFrame, root: str, checkpoint: str, rows_of: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Add everything that has arrived to the bronze table; returns the rows written.

    `checkpoint` names the stream: it keeps its place, and its loads their names. `rows_of` turns a batch of arrivals into
    rows of the table, where they are not that already.
    """
    stream = sha1(checkpoint.encode()).hexdigest()[:12]
    written = 0

    def write(batch: DataFrame, number: int) -> None:
        nonlocal written
        counted, rows = store.observed(rows_of(batch) if rows_of else batch, f"stream_{stream}_{number}")
        write_load(counted, root, f"stream-{stream}-{number}")
        written += rows.get["rows"]

    query = arrivals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return written
