"""Missing offsets of a log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.tail import TOPIC_PARTITION

_BLOCK = 32     # offsets per block, one bit each; half a bigint, so that no mask is negative
_FAN_BITS = 20  # blocks per parent block; three levels cover every offset


def _between(spans: DataFrame) -> DataFrame:
    """Neighbouring spans of one ``parent`` that leave offsets out between them."""
    window = Window.partitionBy(*TOPIC_PARTITION, "parent").orderBy("lo")
    return spans.select(
        *TOPIC_PARTITION,
        F.lag("hi").over(window).alias("prev_offset"),
        F.col("lo").alias("offset"),
    ).filter(F.col("offset") - F.col("prev_offset") > 1)


def _inside(blocks: DataFrame) -> DataFrame:
    """Offsets left out inside a block, whose bits are at most ``_BLOCK`` array elements."""
    bits = F.filter(F.sequence("lo", "hi"), lambda x: F.getbit("mask", (x % _BLOCK).cast("int")) == 1)
    pairs = F.arrays_zip(
        F.slice("present", 1, F.size("present") - 1).alias("prev_offset"),
        F.slice("present", 2, F.size("present") - 1).alias("offset"),
    )
    return (
        blocks.filter(F.bit_count("mask") < F.col("hi") - F.col("lo") + 1)
        .withColumn("present", bits)
        .select(*TOPIC_PARTITION, F.inline(pairs).alias("prev_offset", "offset"))
        .filter(F.col("offset") - F.col("prev_offset") > 1)
    )


def offset_gaps(log: DataFrame) -> DataFrame:
    """Every ``(topic, partition, prev_offset, offset)`` with offsets missing in between.

    A topic partition may hold a third of a log, so it is never sorted as one group. One
    hash aggregation, combined before its shuffle, reduces the log to one bit mask per block
    of offsets; a record read twice sets the same bit. Everything else is derived from the
    masks: gaps inside a block by itself, gaps between blocks level by level, with at most
    2^20 blocks per group.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("offset") % _BLOCK).cast("int"))
    lowest = F.bit_count(F.col("mask").bitwiseAND(-F.col("mask")) - 1)
    highest = F.length(F.bin("mask")) - 1
    start = F.col("block") * _BLOCK
    # The filter is spelt out so that every use of the masks has it, and they are built once.
    blocks = (
        log.withColumn("block", F.expr(f"offset div {_BLOCK}"))
        .filter("block IS NOT NULL")
        .groupBy(*TOPIC_PARTITION, "block")
        .agg(F.bit_or(bit).alias("mask"))
        .withColumns({"lo": start + lowest, "hi": start + highest})
    )

    found = [_inside(blocks)]
    level = blocks.select(*TOPIC_PARTITION, "block", "lo", "hi")
    for _ in range(3):
        level = level.withColumn("parent", F.shiftright("block", _FAN_BITS))
        found.append(_between(level))
        level = level.groupBy(*TOPIC_PARTITION, F.col("parent").alias("block")).agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi")
        )
    return reduce(DataFrame.unionByName, found)
