"""The same upsert and compaction on a Delta table, where Delta Lake is deployed.

Chosen explicitly; importing Delta raises where it is missing. There is no Delta Lake in
the environment this library is tested in, so this module has not been run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.schemas import KEY, PARTITION_DATE


def upsert_delta(batch: DataFrame, table: str, key: str = KEY) -> None:
    from delta.tables import DeltaTable

    spark = batch.sparkSession
    if not DeltaTable.isDeltaTable(spark, table):
        batch.write.format("delta").partitionBy(PARTITION_DATE).option("mergeSchema", "true").save(table)
        return
    spark.conf.set("spark.databricks.delta.schema.autoMerge.enabled", "true")
    merge = DeltaTable.forPath(spark, table).alias("t").merge(batch.alias("s"), f"t.{key} = s.{key}")
    merge.whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()


def compact_delta(spark: SparkSession, table: str) -> None:
    from delta.tables import DeltaTable

    DeltaTable.forPath(spark, table).optimize().executeCompaction()
