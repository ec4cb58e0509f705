"""Timestamps as text, in UTC, whatever time zone the session has."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def utc(ts: Column) -> Column:
    """The UTC wall clock of an instant, as TIMESTAMP_NTZ."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch)


def iso_stamp(wall_clock: Column) -> Column:
    """``2020-01-02T03:04:30.12Z`` of a TIMESTAMP_NTZ; no zeros end the fraction."""
    return F.concat(F.replace(wall_clock.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def minute_stamp(wall_clock: Column) -> Column:
    """``202001020304`` of a TIMESTAMP_NTZ, cut to the minute."""
    return F.translate(F.substring(wall_clock.cast("string"), 1, 16), "- :", "")
