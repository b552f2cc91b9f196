"""Payload lines of a server-sent-event feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import is_json

# Fixed value: what a payload line starts with, the space included.
DATA_PREFIX = "data: "


def sse_payloads(lines: DataFrame, column: str = "value") -> DataFrame:
    """The payload text of the feed's data lines, and whether it is JSON.

    Blank lines, comments and other fields of the feed are dropped. The text itself is
    passed on unchanged; lines that are not JSON are flagged in ``is_json`` and are the
    caller's to count and drop.
    """
    return lines.filter(F.col(column).startswith(DATA_PREFIX)).withColumns({
        column: F.substring(column, len(DATA_PREFIX) + 1, 2**31 - 1),
        "is_json": is_json(F.substring(column, len(DATA_PREFIX) + 1, 2**31 - 1)),
    })
