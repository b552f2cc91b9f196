"""Keyed upsert into the current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import folders, layers
from strata.operators.evolve import reconciled
from strata.operators.merged import columns_of, read_layers, with_keys
from strata.schemas import KEY, PARTITION_DATE


def upsert(
    batch: DataFrame,
    table: str,
    *,
    writer: str,
    batch_id: int,
    key: str = KEY,
    partition: str = PARTITION_DATE,
    distinct_keys: bool = False,
    newer_by: Sequence[str] = (),
) -> bool:
    """Insert or update the rows of ``batch``, which has one row per key.

    The table is created by its first batch. A later batch replaces the columns it has; columns
    that only the table has keep their values, and columns that only the batch has are added.
    Types of a column may differ as long as one holds the values of both: the table gets the wider
    one. Delivering a batch again changes nothing, and returns False.

    A batch that repeats a key, has a null key, or whose columns conflict with the table's, raises
    and leaves the table as it was. ``distinct_keys`` vouches for the keys, which are not looked at
    then. Without ``newer_by`` the batch processed last wins; with it, the row that has the greater
    values in these columns, compared from left to right, with null as the smallest.

    ``rebalance`` gathers each date into few files of even size, and splits a date that
    holds a large share of the rows over several tasks.
    """
    spark = batch.sparkSession
    target = layers.next_layer(spark, table, writer, batch_id)
    if target is None:
        return False
    live = layers.live(spark, table)
    known = columns_of(spark, table, live)
    rows = reconciled(batch, known, fixed=partition)
    if not distinct_keys:
        rows = one_row_per_key(rows, key)
    lacking = [field.name for field in known if field.name not in rows.columns]
    staged = f"{table}/_staged/{target.value}"
    looks_up = bool(live) and bool(lacking or newer_by)
    try:
        if looks_up:
            layers.whole_folder(rows).parquet(staged)
            rows = spark.read.schema(rows.schema).parquet(staged)
            rows = _beside_current(rows, table, live, key, known, lacking, newer_by)
        write_layer(rows, target.path(table), partition, key)
    except BaseException:
        folders.remove(spark, target.path(table))
        raise
    finally:
        if looks_up:
            folders.remove(spark, staged)
    return True


def one_row_per_key(rows: DataFrame, key: str) -> DataFrame:
    """The rows, which fail where they are computed if a key is null or repeated.

    The second row of a key is looked for where the first two of each task have met
    (``WindowGroupLimit``), so that a key repeated by a large share of the rows is no large group.
    """
    of_key = Window.partitionBy(key).orderBy(key)
    name = "__nth_of_key"
    while name in rows.columns:
        name = f"_{name}"
    second = F.concat(F.lit(f"a batch has several rows of one {key}: "), F.col(key).cast("string"))
    fails = (
        F.when(F.col(key).isNull(), F.raise_error(F.lit(f"a batch has a row without {key}")))
        .when(F.col(name) == 2, F.raise_error(second))
    )
    numbered = rows.withColumn(name, F.row_number().over(of_key)).filter(F.col(name) <= 2)
    return numbered.filter(fails.cast("boolean").isNull()).drop(name)


def _beside_current(
    staged: DataFrame, table: str, live: list[layers.Layer], key: str, known: T.StructType,
    lacking: list[str], newer_by: Sequence[str],
) -> DataFrame:
    """The batch with the columns that it lacks, without rows that the table has newer.

    Only the rows of the batch's keys are looked up, by a filter or a semi-join on the scan of the
    table, and joined to the batch, which is as large.
    """
    spark = staged.sparkSession
    known_order = [name for name in newer_by if name in known.names]
    wanted = with_keys(staged.select(key))
    current = read_layers(spark, table, live, key, known, wanted=wanted)
    order = F.struct(*[
        (F.col(f"`{x}`") if x in known_order else F.lit(None).cast(staged.schema[x].dataType)).alias(x)
        for x in newer_by
    ]) if newer_by else F.lit(None)
    kept = current.select(
        F.col(key).alias("kept_key"), order.alias("kept_order"), F.struct(*lacking or [key]).alias("kept")
    )
    joined = staged.select(F.struct("*").alias("new")).join(kept, F.col(f"new.{key}") == F.col("kept_key"), "left")
    if newer_by:
        own = F.struct(*[F.col(f"new.`{x}`").alias(x) for x in newer_by])
        joined = joined.filter(F.col("kept_key").isNull() | (own > F.col("kept_order")))
    return joined.select("new.*", *[F.col(f"kept.`{x}`").alias(x) for x in lacking])


def write_layer(rows: DataFrame, path: str, partition: str, key: str) -> None:
    """Files with a bloom filter of their keys, sized by what they hold, so that a lookup skips them."""
    writer = layers.whole_folder(rows.hint("rebalance", partition)).options(**{
        f"parquet.bloom.filter.enabled#{key}": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
        f"parquet.bloom.filter.candidates.number#{key}": "16",
    })
    writer.partitionBy(partition).parquet(path)
