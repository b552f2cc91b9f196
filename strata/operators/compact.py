"""Fewer, larger files for the current state."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata import folders, layers
from strata.layers import Layer
from strata.operators.merged import layer_rows, read_layers
from strata.operators.upsert import write_layer
from strata.schemas import KEY, PARTITION_DATE


# The keys of a smaller folder are few enough to be broadcast as they are.
NOTE_FROM_BYTES = 32 * 1024 * 1024
MIN_SHARE = 0.25


def compact(
    spark: SparkSession,
    table: str,
    *,
    key: str = KEY,
    partition: str = PARTITION_DATE,
    min_share: float = MIN_SHARE,
    note_from: int = NOTE_FROM_BYTES,
    most_noted: int | None = None,
) -> bool:
    """Fold the newest folders into one; the table's rows and columns stay the same.

    An older folder is taken along only while the newer ones add up to ``min_share`` of its
    size. A large table is so rewritten once per large amount of changes, not on every run.
    ``min_share=0`` folds everything. Folders of ``note_from`` bytes or more, which stay
    beside an older one, get a note of the keys they update. A note of more than ``most_noted``
    bytes (by default, what Spark broadcasts) would make every reader shuffle the table; such a
    folder is folded into the next older one instead. Returns whether anything was folded.
    """
    limit = _broadcast_limit(spark) if most_noted is None else most_noted
    chosen = _worth_folding(spark, table, layers.live(spark, table), min_share)
    folding = len(chosen) > 1
    if folding:
        _fold(spark, table, chosen, key, partition)
    while (wide := _note_updates(spark, table, key, partition, note_from, limit)) is not None:
        _fold(spark, table, wide, key, partition)
        folding = True
    return folding


def _fold(spark: SparkSession, table: str, chosen: list[Layer], key: str, partition: str) -> None:
    rows = read_layers(spark, table, chosen, key, schema=None)
    write_layer(rows, layers.fold_of(chosen).path(table), partition, key)


def _broadcast_limit(spark: SparkSession) -> int:
    value = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(value)


def _note_updates(
    spark: SparkSession, table: str, key: str, partition: str, note_from: int, limit: int
) -> list[Layer] | None:
    """Note which keys a large folder shares with older ones, for readers to compare.

    Most keys of an event log are new, so there are few. One pass over the key and the date here
    spares every reader a join with all keys of the folder. A note is kept by the date of the row
    that is replaced, so that a reader of one date reads the notes of that date. Stops at the oldest
    folder whose note is beyond ``limit``, and returns it with the next older one, to be folded.
    """
    live = layers.live(spark, table)
    for at, layer in reversed(list(enumerate(live[:-1], 1))):
        done = folders.is_complete(spark, layer.updates(table))
        if not done:
            if folders.size(spark, layer.path(table)) < note_from:
                continue
            rows = layer_rows(spark, table, live[at - 1:], schema=None)
            own = F.col(layers.COLUMN) == layer.value
            replaced, own_keys = rows.filter(~own).select(key, partition), rows.filter(own).select(key)
            shared = replaced.join(own_keys, key, "left_semi").hint("rebalance", partition)
            layers.whole_folder(shared).partitionBy(partition).parquet(layer.updates(table))
        if 0 <= limit < folders.size(spark, layer.updates(table)):
            return live[at - 1:at + 1]
    return None


def _worth_folding(
    spark: SparkSession, table: str, newest_first: list[Layer], min_share: float
) -> list[Layer]:
    chosen: list[Layer] = []
    total = 0
    for layer in newest_first:
        size = folders.size(spark, layer.path(table))
        if chosen and size * min_share > total:
            break
        chosen.append(layer)
        total += size
    return chosen
