"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.schemas import EVENT_TIME, KEY

LINEAGE = ("offset", "partition")


def newest_first(lineage: Sequence[str] = LINEAGE) -> list[Column]:
    """Event time, then log position. Rows without an event time come last."""
    return [F.col(EVENT_TIME).desc_nulls_last(), *(F.col(name).desc() for name in lineage)]


def latest_per_key(
    rows: DataFrame, key: str = KEY, order: Sequence[Column] | None = None
) -> DataFrame:
    """One row per ``key``: the first by ``order``.

    Event time has whole-second precision, so ties are common; the log position decides
    them and makes the answer the same on every run. Spark keeps the first row per key in
    each input task (``WindowGroupLimit``) before the one shuffle on the key, so a key that
    holds a large share of all rows sends at most one row per task.
    """
    window = Window.partitionBy(key).orderBy(*(order or newest_first()))
    return rows.withColumn("rn", F.row_number().over(window)).filter("rn = 1").drop("rn")
