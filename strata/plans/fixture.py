"""A log of JSON payloads derived from the ``events`` table.

One record per event, built from native expressions. ``events`` itself has no ties, bad
payloads or late rows, so some payloads are spoilt, by rules on the event id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC = "events"
PARTITIONS = 4

# An event id divisible by the number gets the defect; the first that applies.
TRUNCATED = 97
NO_META = 89
NULL_VALUE = 83
BAD_TIME = 79
FRACTIONAL_TIME = 73

# After this many records of a partition, one offset is left unused.
RECORDS_PER_MARKER = 50


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, because the file source takes a plain path for a folder.
    schema = read_events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events}}.parquet")


def _hour_epoch() -> Column:
    """Epoch seconds of the event's hour. Whole hours make ties per key."""
    return F.datediff("ts", F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + F.hour("ts") * 3600


def _every(number: int) -> Column:
    return F.col("event_id") % number == 0


def payload() -> Column:
    """The event as JSON text."""
    event_id = F.col("event_id").cast("string")
    seconds = _hour_epoch().cast("string")
    time = (
        F.when(_every(BAD_TIME), F.lit('"abc"'))
        .when(_every(FRACTIONAL_TIME), F.concat(F.lit('"'), seconds, F.lit('.7"')))
        .otherwise(seconds)
    )
    meta = F.concat(
        F.lit('"meta":{"uri":"/e/'), event_id,
        F.lit('","request_id":"r'), event_id,
        F.lit('","id":"'), F.col("user_id").cast("string"),
        F.lit('","domain":"'), F.col("event_type"),
        F.lit('.example","stream":"events"},'),
    )
    escaped = F.replace(
        F.replace(F.col("props"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')
    )
    text = F.concat(
        F.lit('{"$schema":"/events/1",'),
        F.when(_every(NO_META) & ~_every(TRUNCATED), F.lit("")).otherwise(meta),
        F.lit('"id":'), event_id,
        F.lit(',"type":"'), F.col("event_type"),
        F.lit('","title":"t'), event_id,
        F.lit('","comment":"'), escaped,
        F.lit('","timestamp":'), time,
        F.lit(',"user":"'), F.col("user_id").cast("string"),
        F.lit('","bot":'), F.when(F.col("event_id") % 2 == 0, "true").otherwise("false"),
        F.lit("}"),
    )
    return (
        F.when(_every(TRUNCATED), F.substring(text, 1, 20))
        .when(_every(NO_META), text)
        .when(~_every(NULL_VALUE), text)
    )


def log_records(events: DataFrame) -> DataFrame:
    """The events as log records, with the columns of the Kafka source."""
    return events.select(
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        F.expr(f"event_id div {PARTITIONS}").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        payload().cast("binary").alias("value"),
    )


def log_with_markers(events: DataFrame) -> DataFrame:
    """The log with offsets left unused between its records, as transaction markers do."""
    skipped = F.expr(f"offset + offset div {RECORDS_PER_MARKER}")
    return log_records(events).withColumn("offset", skipped)


def feed_lines(events: DataFrame) -> DataFrame:
    """The events as a server-sent-event feed: several lines each, with their event id.

    An event without a payload has a data line without the space, which is no payload line.
    """
    data = F.coalesce(F.concat(F.lit("data: "), payload()), F.lit("data:none"))
    lines = F.array(
        F.lit(":ok"),
        F.lit("event: message"),
        F.concat(F.lit("id: "), F.col("event_id").cast("string")),
        data,
        F.lit(""),
    )
    return events.select("event_id", F.posexplode(lines).alias("line", "value"))
