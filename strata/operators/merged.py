"""Folders of an upserted table -> one row per key."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import folders, layers
from strata.layers import Layer
from strata.schemas import PARTITION_DATE

# Up to so many keys are looked up by a filter of literals, which skips row groups by their statistics,
# dictionaries and bloom filters. Spark hands on lists of ten at most.
MOST_LITERALS = 200
_LIST = 10

Wanted = Callable[[DataFrame, str], DataFrame]


def with_keys(keys: DataFrame) -> Wanted:
    """Restricts rows to those whose key is among ``keys``, a table of one column that was written."""
    if keys.count() > MOST_LITERALS:
        wanted = keys.toDF("wanted_key")
        return lambda rows, key: rows.join(wanted, F.col(key) == F.col("wanted_key"), "left_semi")
    values = [row[0] for row in keys.collect()]
    lists = [values[i:i + _LIST] for i in range(0, len(values), _LIST)]
    return lambda rows, key: rows.filter(reduce(or_, [F.col(key).isin(x) for x in lists], F.lit(False)))


def layer_rows(
    spark: SparkSession, table: str, chosen: list[Layer], schema: T.StructType | None
) -> DataFrame:
    """All rows of the ``chosen`` folders, and which folder each is from.

    Folders whose columns have narrower types are read as the wider ones by Spark's Parquet reader.
    """
    if schema is None:
        schema = columns_of(spark, table, chosen)
    with_layer = T.StructType([*schema.fields, T.StructField(layers.COLUMN, T.StringType())])
    reader = spark.read.schema(with_layer).option("basePath", table)
    return reader.parquet(*(layer.path(table) for layer in chosen))


def read_layers(
    spark: SparkSession, table: str, chosen: list[Layer], key: str, schema: T.StructType | None,
    wanted: Wanted | None = None,
) -> DataFrame:
    """Newest row per key over the ``chosen`` folders, which are ordered newest first.

    A folder has a key once, so nothing is sorted or grouped: a row is left out when a newer
    folder updates its key. Where compaction noted a folder's updates, only those keys are
    compared, and not the keys it added; the notes are read by date as the rows are. Spark
    broadcasts the keys when they turn out small; no folder is shuffled then. ``wanted`` restricts
    rows and updates to some keys before they are compared.
    """
    wanted = wanted or (lambda rows, key: rows)
    rows = wanted(layer_rows(spark, table, chosen, schema), key)
    newer = chosen[:-1]
    if not newer:
        return rows.drop(layers.COLUMN)

    noted = [layer for layer in newer if folders.is_complete(spark, layer.updates(table))]
    others = [layer.value for layer in newer if layer not in noted]
    updates = rows.filter(F.col(layers.COLUMN).isin(others)).select(key, layers.COLUMN)
    older = F.col(layers.COLUMN) < F.col("updated_in")
    kept = rows
    if noted:
        notes = wanted(_notes(spark, table, noted, rows.schema[key]), "updated_key")
        # A date tells which notes to read. Replaced rows without one are compared by key alone.
        same = (F.col(key) == F.col("updated_key")) & (F.col(PARTITION_DATE) == F.col("updated_date"))
        kept = kept.join(notes, same & older, "left_anti")
        without = notes.filter("updated_date IS NULL").select("updated_key", "updated_in")
        updates = updates.union(without)
    if noted or others:
        updates = updates.toDF("updated_key", "updated_in")
        kept = kept.join(updates, (F.col(key) == F.col("updated_key")) & older, "left_anti")
    return kept.drop(layers.COLUMN)


def _notes(spark: SparkSession, table: str, noted: list[Layer], key: T.StructField) -> DataFrame:
    """Which keys folders update, the date of the row that each replaces, and the folder."""
    schema = T.StructType([
        key, T.StructField(PARTITION_DATE, T.DateType()), T.StructField(layers.COLUMN, T.StringType())
    ])
    reader = spark.read.schema(schema).option("basePath", layers.updates_root(table))
    found = reader.parquet(*(layer.updates(table) for layer in noted))
    return found.select(*schema.names).toDF("updated_key", "updated_date", "updated_in")


def columns_of(spark: SparkSession, table: str, newest_first: list[Layer]) -> T.StructType:
    """The columns of the table, as its newest folder tells: it has those before it, at least as wide."""
    for layer in newest_first:
        try:
            found = spark.read.parquet(layer.path(table)).schema
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # a batch without rows has no file
                raise
            continue
        # No date tells the partition's type, when all are NULL.
        return T.StructType([
            T.StructField(f.name, T.DateType()) if f.name == PARTITION_DATE else f for f in found
        ])
    return T.StructType()
