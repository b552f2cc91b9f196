"""Tasks that fail and are run again must not change any result."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from strata import folders
from strata.operators import upsert
from strata.sources import read_current
from tests.test_upsert import SCHEMA


@pytest.fixture
def failing_once(tmp_path):
    """Column that is True, and makes each task that reads it fail at its 20th row, once."""
    seen = str(tmp_path / "seen")
    os.mkdir(seen)

    @F.udf("boolean")
    def true(task, row):
        if row == 20:
            try:
                os.mkdir(f"{seen}/{task}")
            except FileExistsError:
                return True
            raise RuntimeError("lost")
        return True

    yield true
    assert os.listdir(seen)


def _rows(spark, failing_once, partitions):
    rows = spark.range(0, 400, 1, partitions).withColumn("task", F.spark_partition_id())
    return rows.filter(failing_once("task", F.col("id") % (400 // partitions)))


def test_upsert_survives_lost_tasks(spark, failing_once):
    table = folders.scratch(spark)
    rows = _rows(spark, failing_once, 8).select(
        F.col("id").cast("string").alias("meta_id"),
        F.col("id").cast("int").alias("v"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 3).cast("int")).alias("kafka_date"),
    )
    upsert(rows, table, writer="w", batch_id=0)
    got = sorted(r.v for r in read_current(spark, table, schema=SCHEMA).collect())
    assert got == list(range(400))


def test_keeping_columns_survives_lost_tasks(spark, failing_once):
    table = folders.scratch(spark)
    day = F.lit(date(2024, 1, 1)).alias("kafka_date")
    key = F.col("id").cast("string").alias("meta_id")
    first = spark.range(400).select(key, day, F.col("id").cast("int").alias("v"), F.lit("x").alias("extra"))
    upsert(first, table, writer="w", batch_id=0)
    rows = _rows(spark, failing_once, 8).select(key, day, (F.col("id") + 1000).cast("int").alias("v"))
    upsert(rows, table, writer="w", batch_id=1)
    got = read_current(spark, table, schema=None).collect()
    assert sorted(r.v for r in got) == list(range(1000, 1400)) and {r.extra for r in got} == {"x"}
