"""Dates and timestamps; what cannot be read becomes null instead of an error."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first and last second of timestamps counted in 64-bit nanoseconds.
EPOCH_BOUNDS = (-9223372036.0, 9223372036.0)

def epoch_timestamp(seconds: Column) -> Column:
    """Epoch seconds, as number or text, fractions kept; null outside ``EPOCH_BOUNDS``."""
    number = seconds.try_cast("double")
    return F.timestamp_seconds(F.when(number.between(*EPOCH_BOUNDS), number))


def as_date(value: Column) -> Column:
    """The date of a date, a timestamp or a text that starts with one."""
    return value.try_cast("date")


def day_or_yesterday(day: dt.date | str | None) -> Column:
    """The given day, or yesterday."""
    if day is None:
        return F.date_sub(F.current_date(), 1)
    return F.lit(str(day)).cast("date")
