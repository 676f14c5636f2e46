"""Numbers from local timestamps, independent of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_micros(ts: Column) -> Column:
    """Microseconds of a ``timestamp_ntz`` since 1970.

    Differences of such timestamps taken through ``timestamp_diff`` pass through the session's zone
    and are off around its clock changes; days and clock fields are not.
    """
    days = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    minutes = (days * 24 + F.hour(ts)) * 60 + F.minute(ts)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
