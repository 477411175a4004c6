"""Tolerant parsing and calendar boundaries.

Spark's ANSI mode stays on; bad text becomes NULL through the ``try_`` forms, so that the caller can
split a table into accepted and rejected rows instead of losing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text form of a reading's time.
OFFSET_PATTERN = "yyyy-MM-dd'T'HH:mm:ssXXX"


def offset_timestamp(text: Column, pattern: str | None = OFFSET_PATTERN) -> Column:
    """Instant named by the text; ``pattern=None`` accepts any form Spark reads by default."""
    return F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)


def calendar_date(year: Column, month: Column, day: Column) -> Column:
    """Date from three numbers; NULL for a missing part or a day that does not exist."""
    return F.try_to_date(F.format_string("%d-%02d-%02d", year, month, day), "yyyy-MM-dd")


def zoned(t: Column, zone: str | None, instant: bool) -> Column:
    """Wall-clock time in ``zone``. ``instant`` says that ``t`` is a TIMESTAMP; otherwise it is a
    TIMESTAMP_NTZ holding UTC."""
    if zone is None:
        return t
    source = None if instant else F.lit("UTC")
    return F.convert_timezone(source, F.lit(zone), t)


def civil_date(t: Column, zone: str | None = None, instant: bool = False) -> Column:
    return F.to_date(zoned(t, zone, instant))


def hour_start(t: Column, zone: str | None = None, instant: bool = False) -> Column:
    """Start of the hour, in the type of the time it is given (NTZ once a zone is applied)."""
    hour = F.date_trunc("hour", zoned(t, zone, instant))
    return hour if instant and zone is None else hour.cast("timestamp_ntz")


def iso_text(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
