"""Topic-like logs: a Kafka topic, or parquet files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.schemas import LOG


def kafka_options(
    servers: str,
    topic: str,
    *,
    start: str = "earliest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
    max_records_per_task: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``max_offsets`` bounds one micro-batch. ``min_partitions`` splits the topic's
    partitions into more tasks, where a topic has fewer partitions than the cluster cores;
    ``max_records_per_task`` splits those that hold more records than others.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "kafka.security.protocol": "PLAINTEXT",
        "subscribe": topic,
        "startingOffsets": start,
        "failOnDataLoss": "true",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_records_per_task is not None:
        options["maxRecordsPerPartition"] = str(max_records_per_task)
    return options


def read_kafka(spark: SparkSession, servers: str, topic: str, **limits: int | None) -> DataFrame:
    """Stream of a topic from its earliest record; fails when records were lost.

    Needs Spark's Kafka connector on the class path and raises without it.
    """
    options = kafka_options(servers, topic, **limits)
    return spark.readStream.format("kafka").options(**options).load()


def read_kafka_tail(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Stream of the records that arrive from now on."""
    options = kafka_options(servers, topic, start="latest")
    return spark.readStream.format("kafka").options(**options).load()


def read_file_log(
    spark: SparkSession,
    path: str,
    *,
    stream: bool = True,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """A log kept as parquet files by ``run_capture`` or another of Spark's file sinks.

    Only what the sink committed is read, and only the log's columns. ``max_files`` or
    ``max_bytes`` bound one micro-batch.
    """
    reader = (spark.readStream if stream else spark.read).schema(LOG)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path).select(*LOG.names)


def statistics_session(spark: SparkSession) -> SparkSession:
    """A session whose reads answer smallest, greatest and count from the statistics of files."""
    found = spark.newSession()
    sources = [x for x in found.conf.get("spark.sql.sources.useV1SourceList").split(",") if x != "parquet"]
    found.conf.set("spark.sql.sources.useV1SourceList", ",".join(sources))
    found.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return found
