"""Captured lines of a server-sent-event feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_feed(
    spark: SparkSession, path: str, *, stream: bool = True, max_files: int | None = None
) -> DataFrame:
    """One row per line (``value``), with the file and block that hold it."""
    reader = spark.readStream if stream else spark.read
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
