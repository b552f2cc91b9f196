"""The current state of an upserted table: one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata import layers
from strata.operators.evolve import as_declared
from strata.operators.merged import columns_of, read_layers
from strata.schemas import KEY, SILVER


def read_current(
    spark: SparkSession, table: str, key: str = KEY, schema: T.StructType | None = SILVER
) -> DataFrame:
    """The table as of now: the declared columns of ``schema``, then others that it has.

    A column that the table holds as a wider type than declared is read as that. ``schema=None``
    declares none; the table must exist then.
    """
    chosen = layers.live(spark, table)
    if not chosen and schema is None:
        raise FileNotFoundError(f"no batch was written to {table}")
    columns = as_declared(schema or T.StructType(), columns_of(spark, table, chosen))
    if not chosen:
        return spark.createDataFrame([], columns)
    return read_layers(spark, table, chosen, key, columns).select(*columns.names)
