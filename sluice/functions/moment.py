"""Points in time (the session's zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_moment(value: Column) -> Column:
    """Epoch seconds or ISO 8601 to a timestamp; NULL for missing, empty, 0 and what can't be read."""
    value = value.cast("string")
    seconds = F.when(value.rlike(r"^\d+(\.\d+)?$"), F.timestamp_seconds(F.floor(value.try_cast("double"))))
    return F.when(value.isin("", "0"), None).otherwise(F.coalesce(seconds, F.when(~value.rlike(r"^\d+$"), F.try_to_timestamp(value))))


def week_of(*moments: Column) -> Column:
    """Monday of the first that is there."""
    return F.date_trunc("WEEK", F.coalesce(*moments)).cast("date")
