"""Session settings the package is designed for, and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale. The caller owns the session; a cluster's own values win.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # A method the JVM will not compile is worse than an operator outside whole-stage code: long models score in small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the Python call site of every column costs more than small plans take to run.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = 8, app: str = "riskmart", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    options = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores if cores != "*" else os.cpu_count()),
        **conf,
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, as set by the cluster.

    Only a session whose driver and executors are one process gets a temporary folder of its own
    where that setting is missing.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        current = spark.sparkContext.getCheckpointDir()
        if current is not None:
            return os.path.dirname(current.rstrip("/"))
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="riskmart-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


_open_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("open_scopes", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; no two runs share one."""
    path = f"{shared_folder(spark).rstrip('/')}/riskmart/{name}-{uuid.uuid4().hex[:12]}"
    for scope in _open_scopes.get()[-1:]:
        scope.append(path)
    return path


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """`df` written once as a table in the shared folder and read back.

    Losing executors then costs no recomputation, and readers still prune columns and push
    filters down, which a checkpointed RDD would not allow.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it names it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the scratch tables written inside: for jobs whose results are stored elsewhere.

    A DataFrame that reads such a table must not leave the scope.
    """
    made: list[str] = []
    token = _open_scopes.set((*_open_scopes.get(), made))
    try:
        yield
    finally:
        _open_scopes.reset(token)
        for path in made:
            system, where = file_system(spark, path)
            system.delete(where, True)
