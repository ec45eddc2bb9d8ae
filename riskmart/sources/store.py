"""Reading sources and the snapshot-partitioned tables of the mart.

A table is one Parquet root partitioned by `snapshot_date`. A date filter prunes folders. Writing a date
range replaces the snapshots of the range, emptied ones included, so a rerun is idempotent. Every write puts its
files into folders of its own and then publishes one new version of the table: the list of its folders. Readers take the
newest list, so they see a write whole or not at all; a write that dies leaves the table as it was.
"""

from __future__ import annotations

import csv
import json
import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from itertools import islice
from operator import and_
from urllib.parse import unquote

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.calendar import as_date
from riskmart.schemas import SNAPSHOT
from riskmart.session import file_system

#: Folder level below a bronze snapshot: which load wrote it. Readers do not see it.
LOAD = "ingest_load"


def _first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, line): the first line of each text file below `paths`, compressed ones included; empty files have none.

    A task opens a file and stops after its first line. The session that reads them has settings of its own, under which a
    file is never cut and never shares a task.
    """
    whole = str(1 << 50)
    reader = spark.newSession()
    for key, value in {
        "spark.sql.files.maxPartitionBytes": whole,
        "spark.sql.files.openCostInBytes": whole,
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1",
    }.items():
        reader.conf.set(key, value)

    def first(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from islice((b for b in batches if len(b)), 1)

    lines = reader.read.text(list(paths)).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    return lines.mapInPandas(first, "file string, line string")


def literal_path(file: str) -> str:
    """A file's name where Spark expects a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", file)


def _headers(spark: SparkSession, paths: Sequence[str], options: Mapping[str, str]) -> dict[tuple[str, ...], list[str]]:
    """The files below `paths` by their header: a row for each file comes to the driver, as in Spark's own listing."""
    delimiter = options.get("sep", options.get("delimiter", ","))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for r in _first_lines(spark, paths).collect():
        line = next(csv.reader([r["line"].removeprefix("\ufeff")], delimiter=delimiter), [])
        # Spark gives the name of a file as a URI.
        by_header.setdefault(tuple(c.strip() for c in line), []).append(literal_path(unquote(r["file"])))
    return {header: sorted(files) for header, files in by_header.items() if header}


def read_text(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """CSV files with a header row as text, undeclared: the columns of all headers, found by name in each file.

    A column that a file lacks is null there; names that differ by case only are one column. Columns come in the order of
    the first header, by code point.
    """
    frames = []
    for header, files in sorted(_headers(spark, [path] if isinstance(path, str) else list(path), options).items()):
        text = T.StructType([T.StructField(c, T.StringType()) for c in header])
        frames.append(spark.read.schema(text).options(header=True, enforceSchema=False, **options).csv(files))
    if not frames:
        return spark.createDataFrame([], T.StructType())
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_source(spark: SparkSession, path: str | list[str], schema: T.StructType, **options: str) -> DataFrame:
    """CSV files with a header row under a declared schema: one scan, no inference pass.

    Columns are found by their name in each file's own header, whatever their order; names differ by
    case only at most. A file without one of them is refused, columns that are not declared are not read.
    """
    paths = [path] if isinstance(path, str) else list(path)
    declared = {f.name.lower(): f for f in schema.fields}
    frames = []
    for header, files in sorted(_headers(spark, paths, options).items()):
        named = [c.lower() for c in header]
        missing = sorted(set(declared) - set(named))
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(missing)}")
        own = T.StructType([T.StructField(c, declared[c.lower()].dataType if c.lower() in declared else T.StringType()) for c in header])
        read = spark.read.schema(own).options(header=True, enforceSchema=False, **options).csv(files)
        frames.append(read.select(*[F.col(f"`{c.lower()}`").alias(f.name) for c, f in declared.items()]))
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, frames)


#: Folder level below a partition: which write made it. Readers do not see it.
WRITE = "written_by"
_VERSIONS = "_versions"
#: Versions whose folders stay: readers of the one before may still be at work.
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class Version:
    """A published state of a table: its number, the columns of its rows and its folders, relative to the root."""

    number: int = 0
    schema: T.StructType = field(default_factory=T.StructType)
    folders: tuple[str, ...] = ()


def _versions(spark: SparkSession, root: str) -> list[int]:
    system, where = file_system(spark, f"{root}/{_VERSIONS}")
    if not system.exists(where):
        return []
    names = [s.getPath().getName() for s in system.listStatus(where)]
    return sorted(int(n) for n in names if n.isdigit())


def _version(spark: SparkSession, root: str, number: int) -> Version:
    system, where = file_system(spark, f"{root}/{_VERSIONS}/{number:020d}")
    opened = system.open(where)
    try:
        made = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8"))
    finally:
        opened.close()
    return Version(number, T.StructType.fromJson(made["schema"]), tuple(made["folders"]))


def newest(spark: SparkSession, root: str) -> Version | None:
    """The version readers see; none for a folder that was not written here."""
    numbers = _versions(spark, root)
    return _version(spark, root, numbers[-1]) if numbers else None


def read_table(spark: SparkSession, root: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Every snapshot of a table, in its newest version."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    version = newest(spark, root)
    if version is None:
        return (reader.schema(schema) if schema is not None else reader).load(root).drop(LOAD)
    columns = version.schema if schema is None else schema
    if not version.folders:
        return spark.createDataFrame([], columns).drop(LOAD)
    read = reader.schema(columns).option("basePath", root).load([f"{root}/{f}" for f in version.folders])
    return read.drop(LOAD, WRITE)


def snapshot(df: DataFrame, day: str | date | Column, column: str = SNAPSHOT) -> DataFrame:
    return df.filter(F.col(column) == as_date(day))


def in_range(start: str | date | Column | None, end: str | date | Column | None, column: str = SNAPSHOT) -> Column:
    """Closed date range; a bound of None is open. One day is a range from it to itself."""
    bounds = [F.col(column) >= as_date(start)] if start is not None else []
    bounds += [F.col(column) <= as_date(end)] if end is not None else []
    return reduce(and_, bounds, F.lit(True))


def on_days(dates: Iterable[date], column: str = SNAPSHOT) -> Column:
    """Whether a row's snapshot is one of a list, at most as long as the calendar."""
    return F.col(column).isin(sorted(dates))


def between(
    df: DataFrame, start: str | date | Column | None, end: str | date | Column | None, column: str = SNAPSHOT
) -> DataFrame:
    return df.filter(in_range(start, end, column)) if start is not None or end is not None else df


def _folders(spark: SparkSession, root: str, depth: int) -> dict[tuple[str, ...], str]:
    """Folders of a table down to `depth` levels of partitions: values in the order of the levels: path below the root."""
    system, top = file_system(spark, root)
    found = {(): ("", top)} if system.exists(top) else {}
    for _ in range(depth):
        found = {
            (*values, s.getPath().getName().partition("=")[2]): (f"{path}/{s.getPath().getName()}".lstrip("/"), s.getPath())
            for values, (path, folder) in found.items()
            for s in system.listStatus(folder)
            if s.isDirectory() and "=" in s.getPath().getName()
        }
    return {values: path for values, (path, _) in found.items()}


@dataclass(frozen=True)
class Staged:
    """A write whose files are in place and not published yet."""

    root: str
    write: str
    schema: T.StructType
    depth: int
    replace: Callable[..., bool] | None


def stage(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (SNAPSHOT,),
    fmt: str = "parquet",
    replace: Callable[..., bool] | None = None,
) -> Staged:
    """Write the rows below the table's root, into folders that no version names.

    The rebalance hint brings a partition's rows together into files of the advisory size; a
    snapshot with far more rows than the others is split over several tasks.
    """
    write = uuid.uuid4().hex[:16]
    writer = df.withColumn(WRITE, F.lit(write)).hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("append").partitionBy(*partition_by, WRITE)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(root)
    return Staged(root, write, df.schema, len(partition_by), replace)


def publish(spark: SparkSession, staged: Staged) -> int:
    """Make a staged write the newest version; returns its number.

    The partitions it holds take the place of the old ones, and those go that `replace` says it stands for but lacks.
    The list is written aside and renamed to the next free number, which fails if another writer has taken it: then the
    step is done again on the other's version. Folders of versions before the last KEPT_VERSIONS are removed.
    """
    folders = _folders(spark, staged.root, staged.depth + 1)
    made = {values[:-1]: path for values, path in folders.items() if values[-1] == staged.write}
    while True:
        before = newest(spark, staged.root) or Version()
        kept = [f for f in before.folders if (v := _values(f)) not in made and not (staged.replace and staged.replace(*v))]
        known = {f.name.lower() for f in staged.schema.fields}
        schema = T.StructType([*staged.schema.fields, *[f for f in before.schema.fields if f.name.lower() not in known]])
        version = Version(before.number + 1, schema, tuple(sorted([*kept, *made.values()])))
        if _renamed(spark, staged.root, version):
            _remove_old(spark, staged.root)
            return version.number


def _values(folder: str) -> tuple[str, ...]:
    """Values of a folder's partitions, without the level of the write."""
    return tuple(level.partition("=")[2] for level in folder.split("/"))[:-1]


def _renamed(spark: SparkSession, root: str, version: Version) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{root}/{_VERSIONS}/{version.number:020d}")
    aside = jvm.org.apache.hadoop.fs.Path(f"{root}/{_VERSIONS}/.{uuid.uuid4().hex}")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(aside, False)
    try:
        out.write(bytearray(json.dumps({"schema": version.schema.jsonValue(), "folders": version.folders}).encode("utf-8")))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(system.makeQualified(aside), system.makeQualified(target), never)
    except Py4JJavaError as refused:
        system.delete(aside, False)
        if not refused.java_exception.getClass().getSimpleName().startswith("FileAlreadyExists"):
            raise
        return False
    return True


def _remove_old(spark: SparkSession, root: str) -> None:
    """Remove lists before the last KEPT_VERSIONS, and the folders that only they name."""
    numbers = _versions(spark, root)
    old, kept = numbers[:-KEPT_VERSIONS], numbers[-KEPT_VERSIONS:]
    used = {f for n in kept for f in _version(spark, root, n).folders}
    for n in old:
        for folder in set(_version(spark, root, n).folders) - used:
            system, where = file_system(spark, f"{root}/{folder}")
            system.delete(where, True)
        system, where = file_system(spark, f"{root}/{_VERSIONS}/{n:020d}")
        system.delete(where, False)


def write_snapshots(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (SNAPSHOT,),
    fmt: str = "parquet",
    replace: Callable[..., bool] | None = None,
) -> int:
    """Replace the partitions present in `df`, and drop those that `replace` says `df` stands for but lacks.

    `replace` gets the values of a partition, as text, in the order of `partition_by`. Without it
    other partitions stay. Readers see all of it or nothing; returns the number of the new version.
    """
    return publish(df.sparkSession, stage(df, root, partition_by, fmt, replace))


def days(start: str | date | None, end: str | date | None) -> Callable[[str], bool]:
    """Whether a partition's date, as text, is in a closed range with open bounds."""
    low, high = (str(x) if x is not None else None for x in (start, end))
    return lambda day: (low is None or day >= low) and (high is None or day <= high)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows in the pass that writes them; read `.get["rows"]` after the action."""
    counter = Observation(name)
    return df.observe(counter, F.count(F.lit(1)).alias("rows")), counter


def snapshot_counts(df: DataFrame, column: str = SNAPSHOT) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def stored_counts(spark: SparkSession, root: str, bounds: Sequence[str] = (), column: str = SNAPSHOT) -> DataFrame:
    """(snapshot, row_count, and min_c and max_c of each column of `bounds`) of a stored Parquet table, without a scan.

    Spark answers counts and bounds by partition folder from the files' footers, read in tasks; no page of data is read.
    Then folders of a snapshot are added up. Bounds are of whole numbers and dates, whose footers hold them exactly; a column
    that is null throughout a file has no bounds there, and asking for them fails. A table without files gives no rows.
    """
    reader = spark.newSession()
    reader.conf.set("spark.sql.sources.useV1SourceList", "")
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    version = newest(spark, root)
    if version is not None and not version.folders:
        rows = spark.createDataFrame([], version.schema)
        return rows.groupBy(column).agg(*_counts_and_bounds(F.count(F.lit(1)), {c: (F.min(c), F.max(c)) for c in bounds}))
    if version is None:
        rows = reader.read.parquet(root)
        levels = [f for f in (column, LOAD, WRITE) if f in rows.columns]
    else:
        levels = [*(level.partition("=")[0] for level in version.folders[0].split("/"))]
        known = T.StructType([f for f in version.schema.fields if f.name not in levels])
        for level in levels:
            known.add(version.schema[level] if level in version.schema.names else T.StructField(level, T.StringType()))
        rows = reader.read.schema(known).option("basePath", root).parquet(*[f"{root}/{f}" for f in version.folders])
    for c in bounds:
        if not isinstance(rows.schema[c].dataType, (T.IntegralType, T.DateType)):
            raise TypeError(f"{c} is neither a whole number nor a date")
    sizes = rows.groupBy(*levels).agg(*_counts_and_bounds(F.count(F.lit(1)), {c: (F.min(c), F.max(c)) for c in bounds}))
    ends = {c: (F.min(f"min_{c}"), F.max(f"max_{c}")) for c in bounds}
    return sizes.groupBy(column).agg(*_counts_and_bounds(F.sum("row_count"), ends))


def _counts_and_bounds(count: Column, ends: Mapping[str, tuple[Column, Column]]) -> list[Column]:
    return [count.alias("row_count"), *[x for c, (low, high) in ends.items() for x in (low.alias(f"min_{c}"), high.alias(f"max_{c}"))]]


def snapshot_digests(df: DataFrame, column: str = SNAPSHOT) -> DataFrame:
    """(snapshot, digest): number of rows and 128 bits of all their values, whatever the order of rows and columns.

    Exclusive or and sum of two hashes of each row, in one aggregate; a null is told from any value.
    """
    values = [x for c in sorted(df.columns) if c != column for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    total = F.sum(F.xxhash64(F.lit(1), *values).cast("decimal(38,0)")).cast("string")
    parts = (F.count(F.lit(1)).cast("string"), F.bit_xor(F.xxhash64(*values)).cast("string"), total)
    return df.groupBy(column).agg(F.concat_ws(":", *parts).alias("digest"))
