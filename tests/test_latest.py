from datetime import datetime

from pyspark.sql import functions as F

from strata.operators import latest_per_key

SCHEMA = "meta_id string, kafka_timestamp timestamp, offset bigint, partition int, name string"


def _at(second):
    return datetime(2024, 1, 1, 0, 0, second)


def test_newest_then_offset_then_partition(spark):
    rows = spark.createDataFrame([
        ("a", _at(1), 9, 0, "old"), ("a", _at(2), 1, 0, "new"),
        ("b", _at(1), 1, 0, "lower"), ("b", _at(1), 2, 0, "higher"),
        ("c", _at(1), 1, 0, "first"), ("c", _at(1), 1, 3, "last"),
        ("d", None, 5, 0, "timeless"), ("d", _at(0), 1, 0, "timed"),
        ("e", None, 5, 0, "lone"),
        ("", _at(1), 1, 0, "empty key"),
    ], SCHEMA)
    got = {r.meta_id: r.name for r in latest_per_key(rows).collect()}
    assert got == {"a": "new", "b": "higher", "c": "last", "d": "timed", "e": "lone", "": "empty key"}
    assert latest_per_key(rows).columns == rows.columns


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("meta_id"),
        F.timestamp_seconds(F.col("id") % 100).alias("kafka_timestamp"),
        F.col("id").alias("offset"),
        F.lit(0).alias("partition"),
    )
    newest = latest_per_key(rows)
    assert newest.count() == rows.select("meta_id").distinct().count()
    assert newest.filter("meta_id = 'hot'").first().offset == 19899
    plan = newest._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange hashpartitioning(meta_id") < partial
