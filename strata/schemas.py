"""Declared schemas of the layers."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names, types and order of the tables and of the payload.

LOG = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.BinaryType()),
])

BRONZE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("kafka_timestamp", T.TimestampType()),
    T.StructField("raw_values", T.StringType()),
    T.StructField("igs_timestamp", T.TimestampType()),
    T.StructField("kafka_date", T.DateType()),
])

META_FIELDS = ["uri", "request_id", "id", "domain", "stream"]

PAYLOAD_FIELDS = [
    "$schema", "meta", "id", "type", "namespace", "title", "title_url", "comment",
    "timestamp", "user", "bot", "parsedcomment", "corrupt_json",
]

# Silver column -> where it comes from in the parsed payload.
SILVER_FROM_PAYLOAD = {
    "kafka_schema": "$schema",
    "meta_url": "meta.uri",
    "meta_request_id": "meta.request_id",
    "meta_id": "meta.id",
    "meta_domain": "meta.domain",
    "meta_stream": "meta.stream",
    "id": "id",
    "type": "type",
    "namespace": "namespace",
    "title": "title",
    "title_url": "title_url",
    "comment": "comment",
    "kafka_timestamp": "timestamp",
    "user": "user",
    "bot": "bot",
    "parsedcomment": "parsedcomment",
    "corrupt_json": "corrupt_json",
}

# End of the fixed values.

# A published payload and where in the captured feed it is from.
PAYLOAD_FILE = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()),
])

# JSON text takes half the space of Spark's default codec, at no cost in time.
COMPRESSION = {"compression": "zstd"}

CORRUPT = "corrupt_json"
KEY = "meta_id"
EVENT_TIME = "kafka_timestamp"
PARTITION_DATE = "kafka_date"
INGEST_TIME = "igs_timestamp"


def _strings(names: list[str]) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


PAYLOAD = T.StructType([
    T.StructField(name, T.StructType(_strings(META_FIELDS)) if name == "meta" else T.StringType())
    for name in PAYLOAD_FIELDS
])

SILVER = T.StructType(
    [
        T.StructField(name, T.TimestampType() if name == EVENT_TIME else T.StringType())
        for name in SILVER_FROM_PAYLOAD
    ]
    + [T.StructField(INGEST_TIME, T.TimestampType()), T.StructField(PARTITION_DATE, T.DateType())]
)
