import random

import pytest
from pyspark.sql import functions as F

from riskmart.operators.joins import outer_chain
from tests.rows import frame, values


def tables(spark, seed):
    """Keys on any subset of the sides, a hot one, copies and null keys."""
    rng = random.Random(seed)

    def side(name, parts):
        rows = [("hot", "d1", i) for i in range(12)] + [(f"only-{name}", "d1", i) for i in range(5)]
        rows += [(rng.choice(["a", "b", "c", "d", "e", None]), rng.choice(["d1", "d2", None]), i) for i in range(30)]
        return frame(spark, f"k string, d string, {name} int", *rows).repartition(parts)

    return side("x", 5), side("y", 3), side("z", 1)


@pytest.mark.parametrize("on", [["k"], ["k", "d"]])
@pytest.mark.parametrize("seed", [1, 2])
def test_same_rows_as_full_joins(spark, on, seed):
    x, y, z = tables(spark, seed)
    x, y, z = (df if i == 0 or len(on) == 2 else df.drop("d") for i, df in enumerate((x, y, z)))
    columns = ["k", "d", "x", "y", "z"]
    assert values(outer_chain([x, y], on), *columns[:4]) == values(x.join(y, on, "full"), *columns[:4])
    assert outer_chain([x], on) is x
    # In a chain a row that matches none of the first tables still meets the later ones.
    chained = x.join(y, on, "full").join(z, on, "full")
    assert values(outer_chain([x, y, z], on), *columns) == values(chained, *columns)


def test_hot_keys_are_split_by_adaptive_execution(spark):
    """Forty hot keys: the join of their side is run with split tasks, and no task gets a share that matters."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
        "spark.sql.shuffle.partitions": "200",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 50 < 40, F.concat(F.lit("hot"), F.col("id") % 40)).otherwise(F.col("id").cast("string"))
        left = spark.range(600_000, numPartitions=8).select(hot.alias("k"), F.xxhash64("id").alias("l"))
        right = spark.range(40).select(F.concat(F.lit("hot"), "id").alias("k"), F.col("id").alias("r"))
        counted = outer_chain([left, right], ["k"]).groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in counted.collect()]
        assert sum(sizes) == 600_000 and max(sizes) < 60_000
        assert "SortMergeJoin(skew=true)" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
