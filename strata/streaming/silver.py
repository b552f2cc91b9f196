"""Raw table -> current state."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata import layers
from strata.operators.compact import MIN_SHARE, NOTE_FROM_BYTES, compact
from strata.operators.delta import compact_delta, upsert_delta
from strata.operators.latest import LINEAGE, latest_per_key
from strata.operators.refine import flatten, valid
from strata.operators.upsert import upsert
from strata.schemas import EVENT_TIME, SILVER
from strata.streaming.rejects import REJECT_LINEAGE, parsed_once, write_rejects

log = logging.getLogger(__name__)

# Micro-batches after which their folders are folded while a long backlog is still drained.
FOLD_EVERY = 64


def newest_valid(rows: DataFrame, *more: str) -> DataFrame | None:
    """The refined rows to upsert, one per key and with ``more`` columns, or None when none is valid.

    The check stops at the first valid row, before the shuffle of the deduplication, so it
    costs little beside the write; the batch is not cached for it. ``take`` looks into a
    few tasks first, where ``isEmpty`` would start them all.
    """
    kept = valid(rows)
    if not kept.select(F.lit(1)).take(1):
        return None
    return latest_per_key(kept).select(*SILVER.names, *more)


def apply_batch(
    rows: DataFrame, table: str, *, writer: str, batch_id: int, by_event_time: bool = False
) -> bool:
    """Upsert one batch of flattened rows; returns whether anything was written.

    With ``by_event_time`` a row of the table that is newer, by the order within a batch, stays, so
    that the order of batches does not matter. The table then keeps the log position, too.
    """
    newest = newest_valid(rows, *(LINEAGE if by_event_time else ()))
    return newest is not None and upsert(
        newest, table, writer=writer, batch_id=batch_id, distinct_keys=True,
        newer_by=(EVENT_TIME, *LINEAGE) if by_event_time else (),
    )


def run_silver(
    raw: DataFrame,
    table: str,
    checkpoint: str,
    *,
    table_format: str = "parquet",
    min_share: float = MIN_SHARE,
    note_from: int = NOTE_FROM_BYTES,
    fold_every: int = FOLD_EVERY,
    by_event_time: bool = False,
    rejects: str | None = None,
) -> StreamingQuery:
    """Upsert what the raw table gained since the checkpoint, stop, then compact.

    ``min_share`` and ``note_from`` are those of ``compact``, which also runs after every
    ``fold_every`` micro-batches of a long backlog. ``by_event_time`` is that of ``apply_batch``;
    it and ``rejects``, where the rows go that are dropped otherwise, are for parquet tables.

    Only the payload text and the log position are read from the raw table. The payload is
    parsed once, in the stream's own plan. A failing batch ends the stream with an error;
    a failing compaction is only logged, as the state is complete without it.
    """
    spark = raw.sparkSession
    if table_format == "delta" and (by_event_time or rejects):
        raise ValueError("by_event_time and rejects are for parquet tables")

    def fold() -> None:
        try:
            if table_format == "delta":
                compact_delta(spark, table)
            else:
                compact(spark, table, min_share=min_share, note_from=note_from)
        except Exception:
            log.warning("compaction of %s failed", table, exc_info=True)

    if table_format == "delta":
        def write(batch: DataFrame, batch_id: int) -> None:
            newest = newest_valid(batch)
            if newest is not None:
                upsert_delta(newest, table)
    else:
        writer = layers.writer_of(spark, checkpoint)

        def write(batch: DataFrame, batch_id: int) -> None:
            with parsed_once(batch, rejects is not None) as rows:
                if rejects:
                    write_rejects(rows, rejects, writer=writer, batch_id=batch_id)
                apply_batch(rows, table, writer=writer, batch_id=batch_id, by_event_time=by_event_time)
            if batch_id % fold_every == fold_every - 1:
                fold()

    lineage = REJECT_LINEAGE if rejects else LINEAGE
    stream = flatten(raw, lineage).writeStream.foreachBatch(write)
    query = stream.trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
    fold()
    return query
