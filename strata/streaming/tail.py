"""Records that a log gains from now on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata import folders, layers
from strata.operators.tail import end_offsets, tail_after
from strata.sources.log import read_file_log, statistics_session

_MARKS = "topic string, partition int, mark long"


def last_offsets(spark: SparkSession, path: str) -> DataFrame:
    """The last offset of every topic partition of a file log, as ``mark``.

    A log kept by topic and partition tells it by the statistics in the footers of its files; no
    record is read. Another one is aggregated.
    """
    return end_offsets(read_file_log(statistics_session(spark), path, stream=False))


def tail_file_log(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Stream of the records beyond the end that a file log has when ``checkpoint`` is first used.

    That end is kept beside the checkpoint, so that a tail that was stopped goes on where it
    was: what arrived meanwhile is delivered, too.
    """
    kept = f"{checkpoint}/start_marks"
    if not folders.is_complete(spark, kept):
        layers.whole_folder(last_offsets(spark, path).coalesce(1)).parquet(kept)
    return tail_after(read_file_log(spark, path), spark.read.schema(_MARKS).parquet(kept))


def preview_tail(
    log: DataFrame, *, rows: int = 20, checkpoint: str | None = None, drain: bool = False
) -> StreamingQuery:
    """Print the first ``rows`` records of each micro-batch, with the value as text.

    A look at a log, not a delivery of it: what a micro-batch holds beyond ``rows`` is not
    printed, and Spark says so. ``run_capture`` delivers every record. Runs until stopped, or
    until the source is empty with ``drain``. Without a ``checkpoint`` the progress goes to a
    scratch folder, and a rerun starts anew.
    """
    shown = log.withColumn("value", F.col("value").cast("string"))
    progress = checkpoint or folders.scratch(log.sparkSession)
    writer = shown.writeStream.format("console").options(
        truncate="false", numRows=rows, checkpointLocation=progress
    )
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()
