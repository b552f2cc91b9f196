"""Feed lines -> Kafka topic, or files of payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.sse import sse_payloads
from strata.schemas import COMPRESSION, PAYLOAD_FILE


def run_publish(
    feed: DataFrame,
    checkpoint: str,
    *,
    topic: str | None = None,
    servers: str | None = None,
    path: str | None = None,
) -> StreamingQuery:
    """Publish the JSON payloads of a feed to Kafka (``servers``, ``topic``) or to files (``path``).

    Map-only either way. Files hold each payload with the file and block of the feed it is
    from; positions in a topic are Kafka's to give. Lines that are not JSON are dropped; the
    query's progress counts them as ``observedMetrics["feed"]``.
    """
    if (path is None) == (servers is None) or (servers is not None and topic is None):
        raise ValueError("give either path, or servers and topic")
    counted = sse_payloads(feed).observe(
        "feed",
        F.count("*").alias("n_payloads"),
        F.count_if(~F.col("is_json")).alias("n_not_json"),
    )
    good = counted.filter("is_json")
    if servers is not None:
        options = {"kafka.bootstrap.servers": servers, "topic": topic}
        sink = good.select("value").writeStream.format("kafka").options(**options)
    else:
        sink = good.select(*PAYLOAD_FILE.names).writeStream.format("parquet").options(path=path, **COMPRESSION)
    query = sink.trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
    return query
