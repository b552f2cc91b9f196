"""Log -> log kept as parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from strata import folders
from strata.operators.tail import TOPIC_PARTITION
from strata.schemas import COMPRESSION, LOG


def run_capture(
    log: DataFrame, path: str, checkpoint: str, *, drain: bool = True, by_partition: bool | None = None
) -> StreamingQuery:
    """Append the records of a log to files, with their own positions.

    Files are kept by topic and partition, so that readers of some of them open no others and the
    last offsets are known from the files' statistics. A log goes on as it was begun; ``by_partition``
    tells how a new one is.

    Spark's file sink lists what it committed, and its readers go by that list: they never see
    the output of an attempt that failed half-way. Drains the source and stops; without
    ``drain`` it runs until stopped.
    """
    sink = log.select(*LOG.names).writeStream.format("parquet").options(
        path=path, checkpointLocation=checkpoint, **COMPRESSION
    )
    names = folders.names(log.sparkSession, path)
    parted = any(name.startswith(f"{TOPIC_PARTITION[0]}=") for name in names)
    begun = not parted and any(name.endswith(".parquet") for name in names)
    if by_partition and begun:
        raise ValueError(f"{path} was begun without folders by topic and partition")
    if parted or (by_partition is not False and not begun):
        sink = sink.partitionBy(*TOPIC_PARTITION)
    if not drain:
        return sink.start()
    query = sink.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
