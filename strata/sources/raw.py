"""Streaming read of the raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.schemas import BRONZE


def read_raw(
    spark: SparkSession,
    path: str,
    *,
    table_format: str = "parquet",
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Rows appended to the raw table since the reader's checkpoint.

    ``delta`` also tolerates files that were rewritten; the parquet table is append-only,
    so none are. ``max_files`` or ``max_bytes`` bound one micro-batch.
    """
    reader = spark.readStream.format(table_format)
    if table_format == "delta":
        reader = reader.option("ignoreChanges", "true")
    else:
        reader = reader.schema(BRONZE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)
