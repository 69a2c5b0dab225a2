"""Plan shapes that must hold for large and skewed data."""

import pytest
from pyspark.sql import functions as F

from salesops.operators import dimensions as dim
from salesops.operators import rows
from salesops.session import materialize, tune


@pytest.fixture
def tiny_partitions(spark):
    """Make a few kilobytes count as a large partition, so that skew shows in a test."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)
    tune(spark)


def test_a_hot_foreign_key_is_split_over_tasks(tiny_partitions):
    """A third of the rows refer to one parent: its partition is split, and no row is lost."""
    spark = tiny_partitions
    fact = spark.range(0, 60_000, numPartitions=8).select(
        F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "P0").otherwise(F.concat(F.lit("P"), F.col("id") % 997)).alias("fk")
    )
    mapping = materialize(spark.range(997).select(F.concat(F.lit("P"), "id").alias("old_id"), F.col("id").alias("new_id")))
    result = dim.repoint_fk(fact, "fk", mapping)
    counted = result.groupBy().agg(F.count(F.lit(1)).alias("n"), F.count("fk").alias("found"))
    assert tuple(counted.first()) == (60_000, 60_000)
    counted.collect()
    assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()


def test_missing_keys_do_not_share_a_partition(spark):
    """Rows without a key get many different join keys."""
    fact = spark.range(10_000).select(F.col("id").alias("k"), F.lit(None).cast("string").alias("fk"))
    keys = fact.select(dim._join_key(fact, F.col("fk")).alias("key"))
    assert keys.distinct().count() > 3000
    assert keys.where("key is null").count() == 0


def test_hot_key_reaches_the_shuffle_once_per_task(spark):
    """Keep-last merges copies of a key before the shuffle."""
    df = spark.range(0, 50_000, numPartitions=4).select(F.lit("hot").alias("pk"), F.col("id").alias("o"), F.lit("x").alias("v"))
    plan = rows._last_per_key(df, ["pk"], F.col("o"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange hashpartitioning")
