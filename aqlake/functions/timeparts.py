"""Time expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds of 0001-01-01 00:00:00 and 9999-12-31 23:59:59, the years Spark prints.
_FIRST_SECOND = -62_135_596_800
_LAST_SECOND = 253_402_300_799


def epoch_to_ntz(epoch_seconds: Column) -> Column:
    """Epoch seconds as a zone-less UTC wall clock; out-of-range input gives NULL.

    Built from an interval because casting an instant to TIMESTAMP_NTZ goes
    through the session zone, which maps two instants to one at a clock change.
    """
    seconds = F.when(epoch_seconds.between(_FIRST_SECOND, _LAST_SECOND), epoch_seconds)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    zero = F.lit(0)
    return start + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def calendar_parts(ts: Column | str, prefix: str = "meas_") -> list[Column]:
    """year, quarter, month, day and hour of ``ts``, each named with ``prefix``."""
    return [
        F.year(ts).alias(f"{prefix}year"),
        F.quarter(ts).alias(f"{prefix}quarter"),
        F.month(ts).alias(f"{prefix}month"),
        F.day(ts).alias(f"{prefix}day"),
        F.hour(ts).alias(f"{prefix}hour"),
    ]


def local_stamp(utc_ts: Column, zone: str = "Europe/Warsaw") -> Column:
    """Minute-grain text of a UTC wall clock as seen in ``zone``.

    Hours and minutes are joined by ``-``: a colon in a file name breaks
    Hadoop path globs.
    """
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_ts)
    return F.date_format(local, "yyyy-MM-dd'T'HH-mm")
