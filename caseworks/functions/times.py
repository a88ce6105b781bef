"""Date and time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseworks.functions.values import as_column


def as_datetime_text(value: Column | str) -> Column:
    """'yyyy-MM-dd HH:mm:ss' of a zone-less timestamp."""
    return F.substring(as_column(value).cast("timestamp_ntz").cast("string"), 1, 19)


EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def clock_seconds(value: Column | str) -> Column:
    """Seconds of a zone-less timestamp since 1970, fractions cut off: a compact form to group and rank by."""
    since = as_column(value).cast("timestamp_ntz") - F.expr(EPOCH)
    return since.cast("interval second").cast("bigint")


def seconds_as_datetime_text(seconds: Column | str) -> Column:
    """'yyyy-MM-dd HH:mm:ss' of :func:`clock_seconds`."""
    return (F.expr(EPOCH) + F.expr("INTERVAL '1' SECOND") * as_column(seconds)).cast("string")


def seconds_as_date(seconds: Column | str) -> Column:
    days = F.floor(as_column(seconds) / 86400).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def whole_minutes(start: Column | str, end: Column | str) -> Column:
    """Completed minutes between two :func:`clock_seconds`, cut towards zero."""
    return ((as_column(end) - as_column(start)) / 60).cast("bigint")


def clock_minutes(clock: Column | str) -> Column:
    """Minutes since midnight of an 'HH:mm:ss' text."""
    clock = as_column(clock)
    hours, minutes = (F.split_part(clock, F.lit(":"), F.lit(i)).cast("bigint") for i in (1, 2))
    return hours * 60 + minutes


def month_number(day: Column | str) -> Column:
    """202501 for a day in January 2025."""
    day = as_column(day)
    return (F.year(day) * 100 + F.month(day)).cast("bigint")
