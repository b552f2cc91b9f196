"""Records of a log after a start point."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOPIC_PARTITION = ["topic", "partition"]


def end_offsets(log: DataFrame) -> DataFrame:
    """The last offset of every topic partition, as ``mark``."""
    return log.groupBy(*TOPIC_PARTITION).agg(F.max("offset").alias("mark"))


def tail_after(log: DataFrame, marks: DataFrame) -> DataFrame:
    """Records of ``log`` past ``marks``; a topic partition without a mark is read whole.

    Each topic's smallest mark becomes an offset filter that reaches the file scan, where it
    skips the row groups before the marks, however many topic partitions there are. The exact
    marks are joined to what is left. One row per topic is looked at to build the filter.
    """
    bounds = marks.groupBy("topic").agg(
        F.min("mark").alias("mark"), F.max("partition").alias("last"),
        F.count_distinct("partition").alias("n"), F.min("partition").alias("first"),
    ).collect()
    if not bounds:
        return log

    def may_be_past(bound):
        past = F.col("offset") > bound.mark
        beyond = (F.col("partition") > bound.last) | (F.col("partition") < bound.first)
        # A partition in between that has no mark may hold any offset.
        whole = bound.last - bound.first + 1 == bound.n
        return (F.col("topic") == bound.topic) & ((past | beyond) if whole else F.lit(True))

    known = F.col("topic").isin([bound.topic for bound in bounds])
    near = log.filter(reduce(or_, map(may_be_past, bounds), ~known))
    return (
        near.join(marks, TOPIC_PARTITION, "left")
        .filter(F.col("mark").isNull() | (F.col("offset") > F.col("mark")))
        .select(*log.columns)
    )
