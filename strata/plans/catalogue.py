"""One query per operator, over the whole ``events`` table.

Queries that write first use a new folder under the session's ``spark.checkpoint.dir`` and
return a read of the result. Event times are compared as epoch seconds, so that the
session's time zone does not matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import folders, layers
from strata.operators import (
    compact,
    end_offsets,
    envelope,
    flatten,
    latest_per_key,
    offset_gaps,
    record_class,
    sse_payloads,
    tail_after,
    upsert,
    valid,
)
from strata.operators.latest import LINEAGE
from strata.plans import fixture
from strata.schemas import PARTITION_DATE, PAYLOAD_FILE, SILVER, SILVER_FROM_PAYLOAD
from strata.sources import read_current, read_feed, read_file_log, read_raw
from strata.streaming import (
    apply_batch,
    read_rejects,
    run_bronze,
    run_capture,
    run_publish,
    run_silver,
    tail_file_log,
)

# Which of the log's partitions arrive in which batch: all records, older ones late.
TWO_BATCHES = [(0, 2), (1, 3)]
THREE_BATCHES = [(2, 3), (0,), (1,)]

# No int holds a number of characters times this.
WIDE = 1 << 40

# Micro-batches of a backlog, by offset, and after how many of them its folders are folded.
BACKLOG_BATCHES = 12
BACKLOG_FOLD_EVERY = 4


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.log_records(fixture.read_events(spark, sf_dir))


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(_log(spark, sf_dir))


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(_bronze(spark, sf_dir), LINEAGE)


def _state(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(
        "meta_id", "id", "type", F.unix_seconds("kafka_timestamp").alias("event_second"), *more
    )


def _raw_columns(bronze: DataFrame) -> DataFrame:
    return bronze.select("topic", "partition", "offset", "kafka_date", "raw_values")


def _upsert_batches(
    spark: SparkSession, sf_dir: str, table: str, batches: list[tuple[int, ...]], **options: bool
) -> None:
    for batch_id, partitions in enumerate(batches):
        arrived = _bronze(spark, sf_dir).filter(F.col("partition").isin(*partitions))
        rows = flatten(arrived, LINEAGE)
        apply_batch(rows, table, writer="pinned", batch_id=batch_id, **options)


def _drain_bronze(spark: SparkSession, sf_dir: str, root: str, **options) -> str:
    log = fixture.log_records(fixture.stream_events(spark, sf_dir))
    run_bronze(log, f"{root}/bronze", f"{root}/bronze_checkpoint", **options)
    return f"{root}/bronze"


def _days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list]:
    """The events with their ``day``, and the two newest days, the older first."""
    events = fixture.read_events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    newest = events.select("day").distinct().orderBy(F.desc("day")).limit(2).collect()
    return events, [row.day for row in reversed(newest)]


def _capture(arrived: DataFrame, root: str) -> str:
    """Let events arrive at a log that is kept as files; returns its path."""
    spark = arrived.sparkSession
    events = arrived.drop("day")
    events.write.mode("append").parquet(f"{root}/arrived")
    stream = spark.readStream.schema(events.schema).parquet(f"{root}/arrived")
    run_capture(fixture.log_records(stream), f"{root}/log", f"{root}/log_checkpoint")
    return f"{root}/log"


def _stamped(rows: DataFrame) -> DataFrame:
    """With whether the ingest time is set; the time itself differs from run to run."""
    return rows.withColumn("is_stamped", F.col("igs_timestamp").isNotNull())


def bronze_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_columns(_bronze(spark, sf_dir))


def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = spark.read.parquet(_drain_bronze(spark, sf_dir, folders.scratch(spark)))
    return _stamped(landed).select(*_raw_columns(landed).columns, "is_stamped")


def bronze_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a job that fails where a micro-batch leaves out offsets; this log has them all."""
    landed = spark.read.parquet(_drain_bronze(spark, sf_dir, folders.scratch(spark), gaps="fail"))
    return _raw_columns(landed)


def bronze_rerun_no_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with more records arriving in between, and a third without."""
    root = folders.scratch(spark)
    events, (_, newest) = _days(spark, sf_dir)
    for arrived in (F.col("day") < newest, F.col("day") == newest, F.lit(False)):
        log = _capture(events.filter(arrived), root)
        run_bronze(read_file_log(spark, log), f"{root}/bronze", f"{root}/bronze_checkpoint")
    landed = spark.read.parquet(f"{root}/bronze")
    return landed.groupBy("partition").agg(F.count("*").alias("n"))


def bronze_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One date of a table that is partitioned by date."""
    _, (_, newest) = _days(spark, sf_dir)
    landed = _drain_bronze(spark, sf_dir, folders.scratch(spark), gather_dates=True)
    return _raw_columns(spark.read.parquet(landed).filter(F.col(PARTITION_DATE) == newest))


def offset_gaps_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = offset_gaps(fixture.log_with_markers(fixture.read_events(spark, sf_dir)))
    return gaps.select("topic", "partition", "prev_offset", "offset")


def rows_per_kafka_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir).groupBy("kafka_date").agg(F.count("*").alias("n"))


def silver_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    same = [name for name in SILVER_FROM_PAYLOAD if name != "kafka_timestamp"]
    return _flat(spark, sf_dir).select(
        "partition", "offset", *same, F.unix_seconds("kafka_timestamp").alias("event_second")
    )


def valid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(spark, sf_dir).groupBy(record_class().alias("class")).agg(F.count("*").alias("n"))


def latest_per_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(latest_per_key(valid(_flat(spark, sf_dir))))


def silver_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = folders.scratch(spark)
    apply_batch(_flat(spark, sf_dir), table, writer="pinned", batch_id=0)
    return _state(_stamped(read_current(spark, table)), "is_stamped")


def merge_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = folders.scratch(spark)
    _upsert_batches(spark, sf_dir, table, TWO_BATCHES)
    return _state(read_current(spark, table))


def merge_by_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer event wins, whichever batch is processed first."""
    found = []
    for first, batches in enumerate((TWO_BATCHES, TWO_BATCHES[::-1])):
        table = folders.scratch(spark)
        _upsert_batches(spark, sf_dir, table, batches, by_event_time=True)
        found.append(_state(read_current(spark, table), F.lit(first).alias("first_batch")))
    return found[0].unionByName(found[1])


def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = folders.scratch(spark)
    landed = _drain_bronze(spark, sf_dir, root)
    run_silver(read_raw(spark, landed), f"{root}/silver", f"{root}/silver_checkpoint")
    return _state(read_current(spark, f"{root}/silver"))


def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the current state does not take, kept by the job that writes the state."""
    root = folders.scratch(spark)
    landed = _drain_bronze(spark, sf_dir, root)
    rejects = f"{root}/rejects"
    run_silver(
        read_raw(spark, landed), f"{root}/silver", f"{root}/silver_checkpoint", rejects=rejects
    )
    return read_rejects(spark, rejects).select("class", "topic", "partition", "offset", "raw_values")


def silver_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = folders.scratch(spark)
    _upsert_batches(spark, sf_dir, table, THREE_BATCHES)
    return _state(read_current(spark, table))


def silver_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch without a valid record leaves no folder behind."""
    table = folders.scratch(spark)
    rows = _flat(spark, sf_dir)
    apply_batch(rows, table, writer="pinned", batch_id=0)
    rejects = rows.filter(record_class() != "valid")
    apply_batch(rejects, table, writer="pinned", batch_id=1)
    batches = F.lit(len(layers.live(spark, table))).alias("n_batches")
    return _state(read_current(spark, table), batches)


def compaction_preserves_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = folders.scratch(spark)
    _upsert_batches(spark, sf_dir, table, THREE_BATCHES)
    compact(spark, table, min_share=0)
    batches = F.lit(len(layers.live(spark, table))).alias("n_folders")
    return _state(read_current(spark, table), batches)


def compaction_notes_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders too large to fold: readers compare the noted keys instead."""
    table = folders.scratch(spark)
    _upsert_batches(spark, sf_dir, table, THREE_BATCHES)
    compact(spark, table, min_share=float("inf"), note_from=0)
    batches = F.lit(len(layers.live(spark, table))).alias("n_folders")
    return _state(read_current(spark, table), batches)


def current_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One date of an updated table, whose updates are noted by date."""
    table = folders.scratch(spark)
    _upsert_batches(spark, sf_dir, table, THREE_BATCHES)
    compact(spark, table, min_share=float("inf"), note_from=0)
    _, (_, newest) = _days(spark, sf_dir)
    return _state(read_current(spark, table).filter(F.col(PARTITION_DATE) == newest), PARTITION_DATE)


def _upsert_evolving(spark: SparkSession, sf_dir: str, table: str, longer: int) -> None:
    """Two batches, of which the one numbered ``longer`` has a column more."""
    for batch_id, partitions in enumerate(TWO_BATCHES):
        arrived = _bronze(spark, sf_dir).filter(F.col("partition").isin(*partitions))
        rows = latest_per_key(valid(flatten(arrived, LINEAGE))).select(*SILVER.names)
        if batch_id == longer:
            rows = rows.withColumn("title_length", F.length("title"))
        upsert(rows, table, writer="pinned", batch_id=batch_id)


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch adds a column; keys it does not hold have none."""
    table = folders.scratch(spark)
    _upsert_evolving(spark, sf_dir, table, longer=1)
    return _state(read_current(spark, table), "title_length")


def schema_evolution_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch lacks a column that the first one added; keys keep what they had."""
    table = folders.scratch(spark)
    _upsert_evolving(spark, sf_dir, table, longer=0)
    return _state(read_current(spark, table), "title_length")


def schema_evolution_back_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after compaction."""
    table = folders.scratch(spark)
    _upsert_evolving(spark, sf_dir, table, longer=0)
    compact(spark, table, min_share=0)
    return _state(read_current(spark, table), "title_length")


def schema_evolution_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches that have a column as int, bigint and int."""
    table = folders.scratch(spark)
    length = F.length("title")
    sizes = (length, length.cast("bigint") * WIDE, length)
    for batch_id, (partitions, size) in enumerate(zip(THREE_BATCHES, sizes)):
        arrived = _bronze(spark, sf_dir).filter(F.col("partition").isin(*partitions))
        rows = latest_per_key(valid(flatten(arrived, LINEAGE))).select(*SILVER.names)
        rows = rows.withColumn("title_size", size)
        upsert(rows, table, writer="pinned", batch_id=batch_id)
    return _state(read_current(spark, table), "title_size")


def silver_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many micro-batches, with the compaction that a job runs by default."""
    table = folders.scratch(spark)
    for batch_id in range(BACKLOG_BATCHES):
        arrived = _bronze(spark, sf_dir).filter(F.col("offset") % BACKLOG_BATCHES == batch_id)
        apply_batch(flatten(arrived, LINEAGE), table, writer="pinned", batch_id=batch_id)
        if batch_id % BACKLOG_FOLD_EVERY == BACKLOG_FOLD_EVERY - 1:
            compact(spark, table)
    return _state(read_current(spark, table))


def sse_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fixture.feed_lines(fixture.read_events(spark, sf_dir))
    return sse_payloads(lines).select("event_id", "value", "is_json")


def _feed_files(lines: DataFrame, root: str) -> str:
    lines.select("value").write.mode("append").text(f"{root}/feed")
    return f"{root}/feed"


def _published(spark: SparkSession, root: str) -> DataFrame:
    feed = read_feed(spark, f"{root}/feed")
    run_publish(feed, f"{root}/feed_checkpoint", path=f"{root}/published")
    return spark.read.schema(PAYLOAD_FILE).parquet(f"{root}/published").select("value")


def feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads of captured feed files."""
    root = folders.scratch(spark)
    _feed_files(fixture.feed_lines(fixture.read_events(spark, sf_dir)), root)
    return _published(spark, root)


def publish_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in two runs, with feed files added in between."""
    root = folders.scratch(spark)
    lines = fixture.feed_lines(fixture.read_events(spark, sf_dir))
    for half in (0, 1):
        _feed_files(lines.filter(F.col("event_id") % 2 == half), root)
        found = _published(spark, root)
    return found


def publish_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads that are handed to the topic's sink."""
    lines = fixture.feed_lines(fixture.read_events(spark, sf_dir))
    return sse_payloads(lines).filter("is_json").select("value")


def feed_to_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All jobs in a row: captured log -> raw table -> current state."""
    root = folders.scratch(spark)
    log = read_file_log(spark, _capture(fixture.read_events(spark, sf_dir), root))
    run_bronze(log, f"{root}/bronze", f"{root}/bronze_checkpoint")
    run_silver(read_raw(spark, f"{root}/bronze"), f"{root}/silver", f"{root}/silver_checkpoint")
    return _state(read_current(spark, f"{root}/silver"))


def tail_after_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What arrived after all but the newest day was seen."""
    bronze = _bronze(spark, sf_dir).select("topic", "partition", "offset", "kafka_date")
    newest_day = bronze.agg(F.max("kafka_date")).scalar()
    seen = bronze.filter(F.col("kafka_date") < newest_day)
    return tail_after(bronze, end_offsets(seen))


def _delivered(spark: SparkSession, root: str) -> DataFrame:
    """What a tail has delivered once it is drained; a rerun goes on where it stopped."""
    tail = tail_file_log(spark, f"{root}/log", f"{root}/tail_checkpoint")
    run_capture(tail, f"{root}/tail", f"{root}/tail_checkpoint")
    text = F.col("value").cast("string").alias("value")
    found = read_file_log(spark, f"{root}/tail", stream=False)
    return found.select("topic", "partition", "offset", text)


def tail_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in a stream that starts at the end of a log kept as files."""
    root = folders.scratch(spark)
    events, (_, newest) = _days(spark, sf_dir)
    log = _capture(events.filter(F.col("day") < newest), root)
    tail_file_log(spark, log, f"{root}/tail_checkpoint")
    _capture(events.filter(F.col("day") == newest), root)
    return _delivered(spark, root)


def tail_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tail that is stopped while records arrive, and goes on with the same checkpoint."""
    root = folders.scratch(spark)
    events, (older, newest) = _days(spark, sf_dir)
    _capture(events.filter(F.col("day") < older), root)
    for day in (None, older, newest):
        if day is not None:
            _capture(events.filter(F.col("day") == day), root)
        found = _delivered(spark, root)
    return found


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_envelope": bronze_envelope,
    "bronze_stream": bronze_stream,
    "bronze_checked": bronze_checked,
    "bronze_rerun_no_dup": bronze_rerun_no_dup,
    "bronze_pruned": bronze_pruned,
    "offset_gaps": offset_gaps_query,
    "rows_per_kafka_date": rows_per_kafka_date,
    "silver_flatten": silver_flatten,
    "valid_records": valid_records,
    "latest_per_key": latest_per_key_query,
    "silver_first_load": silver_first_load,
    "merge_two_batches": merge_two_batches,
    "merge_by_event_time": merge_by_event_time,
    "silver_stream": silver_stream,
    "rejected_records": rejected_records,
    "silver_current": silver_current,
    "current_pruned": current_pruned,
    "silver_empty_batch": silver_empty_batch,
    "compaction_preserves_rows": compaction_preserves_rows,
    "compaction_notes_updates": compaction_notes_updates,
    "schema_evolution": schema_evolution,
    "schema_evolution_back": schema_evolution_back,
    "schema_evolution_back_folded": schema_evolution_back_folded,
    "schema_evolution_widened": schema_evolution_widened,
    "silver_backlog": silver_backlog,
    "sse_extract": sse_extract,
    "feed_stream": feed_stream,
    "publish_log": publish_log,
    "publish_stream": publish_stream,
    "feed_to_state": feed_to_state,
    "tail_after_mark": tail_after_mark,
    "tail_stream": tail_stream,
    "tail_resumed": tail_resumed,
}
