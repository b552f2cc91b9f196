"""Records that the refined layer does not take, with their payload and the reason."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import folders, layers
from strata.operators.latest import LINEAGE
from strata.operators.refine import is_valid, record_class
from strata.schemas import BRONZE, INGEST_TIME

_COLUMNS = ["topic", "partition", "offset", "raw_values"]
REJECT_LINEAGE = (*LINEAGE, *(name for name in _COLUMNS if name not in LINEAGE))
REJECTS = T.StructType([
    T.StructField("class", T.StringType()), *(BRONZE[name] for name in _COLUMNS), BRONZE[INGEST_TIME],
])


@contextmanager
def parsed_once(batch: DataFrame, twice: bool) -> Iterator[DataFrame]:
    """The batch, kept while it is written ``twice``, so that its payloads are parsed once."""
    if not twice:
        yield batch
        return
    kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def write_rejects(rows: DataFrame, path: str, *, writer: str, batch_id: int) -> None:
    """The invalid rows of a micro-batch as a folder of its own; a batch delivered again replaces it."""
    found = rows.filter(~is_valid()).select(record_class().alias("class"), *REJECTS.names[1:])
    layers.whole_folder(found.hint("rebalance")).parquet(f"{path}/batch={writer}-{batch_id:012d}")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """All rejected records; folders that are not complete are left out."""
    found = [f"{path}/{name}" for name in folders.names(spark, path) if name.startswith("batch=")]
    done = [folder for folder in found if folders.is_complete(spark, folder)]
    if not done:
        return spark.createDataFrame([], REJECTS)
    return spark.read.schema(REJECTS).parquet(*done).select(*REJECTS.names)
