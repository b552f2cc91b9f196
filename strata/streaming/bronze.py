"""Log -> raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from strata.operators.envelope import envelope
from strata.schemas import COMPRESSION, PARTITION_DATE
from strata.streaming.loss import guarded


def run_bronze(
    log: DataFrame,
    landing_path: str,
    checkpoint: str,
    table_format: str = "parquet",
    *,
    gather_dates: bool = False,
    gaps: str | None = None,
) -> StreamingQuery:
    """Append what the log holds beyond the checkpoint, partitioned by date, and stop.

    Map-only by default: each task writes the dates of its own slice of the log, which are one
    or two where a log is read soon after it is written. A backlog of many dates would make one
    file per task and date; ``gather_dates`` rebalances the records first, so that each date
    becomes few files of even size. Failures are raised.

    ``gaps="fail"`` lets a micro-batch fail that leaves out offsets of a file log, before anything
    of it is committed; ``gaps="accept"`` takes it all the same.
    """
    if gaps not in (None, "fail", "accept"):
        raise ValueError(f"gaps can fail or be accepted, not {gaps}")
    rows = envelope(log)
    if gaps:
        rows = guarded(rows, log, accept=gaps == "accept")
    if gather_dates:
        rows = rows.hint("rebalance", PARTITION_DATE)
    sink = rows.writeStream.partitionBy(PARTITION_DATE)
    if table_format == "parquet":
        sink = sink.options(**COMPRESSION)
    query = (
        sink.trigger(availableNow=True)
        .outputMode("append")
        .options(path=landing_path, checkpointLocation=checkpoint)
        .format(table_format)
        .start()
    )
    query.awaitTermination()
    return query
