"""Clock times, service days and epochs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_seconds(hms: Column) -> Column:
    """``HH:MM:SS`` to seconds after midnight; the hour may pass 24. NULL when a part is no number."""
    hours, minutes, seconds = (
        F.split_part(hms, F.lit(":"), F.lit(i)).try_cast("int") for i in (1, 2, 3)
    )
    return hours * 3600 + minutes * 60 + seconds


def midnight_epoch(start_date: Column, tz: str) -> Column:
    """Epoch of the local midnight of a ``YYYYMMDD`` day."""
    year, month, day = (
        F.substring(start_date, pos, length).try_cast("int") for pos, length in ((1, 4), (5, 2), (7, 2))
    )
    return F.unix_timestamp(
        F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0), F.lit(tz))
    )


def scheduled_epoch(start_date: Column, seconds: Column, tz: str) -> Column:
    """Epoch of a timetable entry: local midnight plus elapsed seconds."""
    return midnight_epoch(start_date, tz) + seconds


def iso_epoch(text: Column) -> Column:
    """ISO-8601 text to epoch seconds; NULL for missing or empty text."""
    return F.unix_timestamp(F.try_to_timestamp(text))


def minutes_to_seconds(minutes: Column) -> Column:
    """Minutes to whole seconds, half to even; a missing value counts as none."""
    return F.bround(F.coalesce(minutes, F.lit(0)) * 60).cast("long")


def year_of(month: Column) -> Column:
    """Year out of a ``YYYY-MM`` text."""
    return F.substring(month, 1, 4).cast("int")


def present(epoch: Column) -> Column:
    """An epoch of 0 counts as missing."""
    return F.nullif(epoch, F.lit(0))
