"""Raw-layer row -> refined row: parse, flatten, classify, filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import epoch_text_to_timestamp
from strata.schemas import (
    CORRUPT,
    EVENT_TIME,
    INGEST_TIME,
    KEY,
    PARTITION_DATE,
    PAYLOAD,
    SILVER_FROM_PAYLOAD,
)

_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def parse_payload(bronze: DataFrame, lineage: Sequence[str] = ()) -> DataFrame:
    """The payload's fields as top-level columns, after the ``lineage`` columns.

    ``inline(array(...))`` rather than a projected struct: a filter on the fields cannot
    be pushed below it, where Catalyst would parse every record once more for the filter
    and again for the projection. Unreadable text gives a row of NULLs with the text in
    ``corrupt_json``; blank or NULL text gives a row of NULLs.
    """
    parsed = F.from_json("raw_values", PAYLOAD, _JSON_OPTIONS)
    return bronze.select(*lineage, F.inline(F.array(parsed)))


def flatten(bronze: DataFrame, lineage: Sequence[str] = ()) -> DataFrame:
    """The refined table's columns, stamped and dated, after the ``lineage`` columns.

    ``kafka_timestamp`` and ``kafka_date`` come from the payload here, not from the log.
    """
    fields = [
        (epoch_text_to_timestamp(F.col(source)) if name == EVENT_TIME else F.col(source)).alias(name)
        for name, source in SILVER_FROM_PAYLOAD.items()
    ]
    return (
        parse_payload(bronze, lineage)
        .select(*lineage, *fields)
        .withColumn(INGEST_TIME, F.current_timestamp())
        .withColumn(PARTITION_DATE, F.to_date(EVENT_TIME))
    )


def is_valid() -> Column:
    return F.col(KEY).isNotNull() & F.col(CORRUPT).isNull()


def valid(rows: DataFrame) -> DataFrame:
    """Rows that carry a key and parsed cleanly; the others are dropped silently."""
    return rows.filter(is_valid())


def record_class() -> Column:
    """``valid``, ``corrupt`` (unreadable text) or ``keyless`` (readable, or blank, without a key)."""
    return (
        F.when(F.col(CORRUPT).isNotNull(), "corrupt")
        .when(F.col(KEY).isNull(), "keyless")
        .otherwise("valid")
    )
