"""Epoch seconds held as text -> timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds beyond this do not fit Spark's microsecond timestamps.
_MAX_SECONDS = 9_223_372_036_854

_WHOLE_SECONDS = r"^[\s\p{Cntrl}]*([+-]?\d+)(?:\.\d*)?[\s\p{Cntrl}]*$"


def epoch_seconds(text: Column) -> Column:
    """Whole seconds in ``text``; NULL when it is no plain number (``abc``, ``1.7e9``).

    A fraction is cut off, not rounded. Gives the same answer with ANSI mode on or off,
    so one bad payload never fails the job.
    """
    return F.regexp_extract(text, _WHOLE_SECONDS, 1).try_cast("bigint")


def epoch_text_to_timestamp(text: Column) -> Column:
    """Timestamp of epoch-seconds text.

    Computed from the epoch itself and not through a local wall-clock string, so the
    repeated hour of a clock change keeps both of its instants.
    """
    seconds = epoch_seconds(text)
    return F.when(seconds.between(-_MAX_SECONDS, _MAX_SECONDS), F.timestamp_seconds(seconds))
