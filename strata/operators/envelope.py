"""Log record -> raw-layer row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.schemas import BRONZE


def envelope(log: DataFrame) -> DataFrame:
    """Cast and rename a log record, stamp the ingest time and derive its date.

    ``log`` has the columns of Spark's Kafka source; the key, headers and timestamp type
    are left behind. A map-only projection: no shuffle.
    """
    return log.select(
        F.col("topic").cast("string"),
        F.col("partition").cast("int"),
        F.col("offset").cast("bigint"),
        F.col("timestamp").cast("timestamp").alias("kafka_timestamp"),
        F.col("value").cast("string").alias("raw_values"),
        F.current_timestamp().alias("igs_timestamp"),
        F.to_date(F.col("timestamp").cast("timestamp")).alias("kafka_date"),
    ).select(*BRONZE.names)
