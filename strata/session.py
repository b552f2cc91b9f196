"""Spark sessions for the jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str, *, shuffle_partitions: int | None = None, delta: bool = False
) -> SparkSession:
    """A session for one job.

    ``shuffle_partitions`` is the starting number; adaptive execution merges small ones.
    ``delta`` registers Delta Lake, whose jars must then be deployed.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        # Partitions, and with them files, of a good size, not as many as there are cores.
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB")
        # Unlike the default type, this one has statistics that let scans skip row groups.
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if delta:
        builder = builder.config(
            "spark.sql.extensions", "io.delta.sql.DeltaSparkSessionExtension"
        ).config("spark.sql.catalog.spark_catalog", "org.apache.spark.sql.delta.catalog.DeltaCatalog")
    return builder.getOrCreate()
