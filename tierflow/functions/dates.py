"""Epoch seconds to calendar dates, in a named zone and not in the session's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch seconds of 0001-01-02 and 9999-12-31, a day inside the calendar's
# ends so that every zone's date exists.
FIRST_SECOND, LAST_SECOND = -62_135_510_400, 253_402_214_400


def epoch_to_date(seconds: Column, time_zone: str = "UTC") -> Column:
    """Calendar date of an epoch second in ``time_zone``; NULL outside years 1 to 9999."""
    utc = F.timestamp_add(
        "SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    )
    if time_zone != "UTC":
        utc = F.convert_timezone(F.lit("UTC"), F.lit(time_zone), utc)
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), utc.cast("date"))


def epoch_to_dt(seconds: Column, time_zone: str = "UTC") -> Column:
    """Partition value ``yyyy-MM-dd`` of an epoch second in ``time_zone``."""
    return epoch_to_date(seconds, time_zone).cast("string")
