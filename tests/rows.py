"""Helpers to build small frames and read small results."""

from pyspark.sql import DataFrame, SparkSession


def frame(spark: SparkSession, schema: str, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def values(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as tuples, in a repeatable order."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
