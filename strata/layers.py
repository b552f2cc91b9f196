"""Folders of an upserted parquet table.

Each upserted batch is one folder with at most one row per key, and newer folders win.
Nothing is rewritten by an upsert, so its cost is that of the batch. Compaction writes one
folder in place of several neighbours; ``last`` and ``first`` say which it stands for.

One job writes a table at a time. Readers may run beside it: complete folders never change.
Folders that a later one stands for are left in place, for readers that still use them.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from strata import folders
from strata.schemas import COMPRESSION

COLUMN = "layer"

_FOLD = "fold"
_NAME = re.compile(COLUMN + r"=(\d{12})-(\d{12})-(\d+)-(\w+)")
_WRITER = re.compile(r"writer=(\w+)")


@dataclass(frozen=True)
class Layer:
    last: int
    first: int
    batch_id: int
    writer: str

    @property
    def value(self) -> str:
        return f"{self.last:012d}-{self.first:012d}-{self.batch_id}-{self.writer}"

    def path(self, table: str) -> str:
        return f"{table}/{COLUMN}={self.value}"

    def updates(self, table: str) -> str:
        """Where compaction notes the keys of this folder that older folders hold too."""
        return f"{updates_root(table)}/{COLUMN}={self.value}"

    def stands_for(self, other: Layer) -> bool:
        return self.writer == _FOLD and self.first <= other.first and other.last <= self.last


def updates_root(table: str) -> str:
    return f"{table}/_updates_by_date"


def fold_of(layers: list[Layer]) -> Layer:
    return Layer(max(x.last for x in layers), min(x.first for x in layers), 0, _FOLD)


def _all(spark: SparkSession, table: str) -> list[Layer]:
    found = (_NAME.fullmatch(name) for name in folders.names(spark, table))
    return [Layer(int(m[1]), int(m[2]), int(m[3]), m[4]) for m in found if m]


def live(spark: SparkSession, table: str) -> list[Layer]:
    """The complete folders that make up the table now, newest first."""
    kept: list[Layer] = []
    for layer in sorted(_all(spark, table), key=lambda x: (-x.last, x.first)):
        if any(newer.stands_for(layer) for newer in kept):
            continue
        if folders.is_complete(spark, layer.path(table)):
            kept.append(layer)
    return kept


def next_layer(spark: SparkSession, table: str, writer: str, batch_id: int) -> Layer | None:
    """Where to write a batch, or None when it was delivered before and is complete.

    A half-written folder of the same batch is written over as long as nothing came after
    it; otherwise the batch goes last, since the batch processed last wins.
    """
    if writer == _FOLD or not re.fullmatch(r"\w+", writer):
        raise ValueError(f"not a writer's name: {writer}")
    known = _all(spark, table)
    newest = max((x.last for x in known), default=0)
    mine = [x for x in known if (x.writer, x.batch_id) == (writer, batch_id)]
    if any(folders.is_complete(spark, x.path(table)) for x in mine):
        return None
    for layer in mine:
        if layer.last == newest:
            return layer
    return Layer(newest + 1, newest + 1, batch_id, writer)


def whole_folder(rows: DataFrame) -> DataFrameWriter:
    """Writer of a complete folder, in place of what a failed attempt left there.

    A folder counts by the marker its job leaves, so the marker is not left to the settings.
    """
    return rows.write.mode("overwrite").options(**COMPRESSION, **{
        "partitionOverwriteMode": "static",
        "mapreduce.fileoutputcommitter.marksuccessfuljobs": "true",
    })


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that owns ``checkpoint``, made up on first use and kept there.

    Batch ids restart at 0 with a new checkpoint; a new name keeps them apart from the old.
    """
    for name in folders.names(spark, checkpoint):
        if match := _WRITER.fullmatch(name):
            return match[1]
    writer = uuid.uuid4().hex
    folders.make(spark, f"{checkpoint}/writer={writer}")
    return writer
