"""Lenient parsing and calendar parts of naive timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

STAMP = "yyyy-MM-dd HH:mm:ss"


def parse_stamp(value: Column) -> Column:
    """Timestamp without zone; unparsable text becomes null."""
    return F.try_to_timestamp(value, F.lit(STAMP)).cast("timestamp_ntz")


def parse_day(value: Column) -> Column:
    """Date of the first ten characters; unparsable text becomes null."""
    return F.try_to_date(F.substring(value, 1, 10), "yyyy-MM-dd")


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def days_between(start: Column, end: Column) -> Column:
    """Calendar days crossed, not full 24-hour periods."""
    return F.datediff(end, start)


def epoch_seconds(stamp: Column) -> Column:
    return F.unix_timestamp(stamp.cast("timestamp"))
