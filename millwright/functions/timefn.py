"""Date and time functions. Sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layouts of dates and the local zone of the service records.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SECONDS = "yyyy-MM-dd HH:mm:ss"
DAY_DASHED = "yyyy-MM-dd"
DAY_COMPACT = "yyyyMMdd"
DAY_FIRST = "dd-MM-yyyy"
LOCAL_ZONE = "Asia/Jakarta"


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_MICROS)


def micros_text(micros: Column) -> Column:
    """Epoch microseconds as UTC text with whole seconds."""
    return F.date_format(F.timestamp_micros(micros), SECONDS)


def parse_ts(text: Column) -> Column:
    return F.try_to_timestamp(text)


def local_wall_clock(ts_utc: Column) -> Column:
    """Wall clock in the local zone, without a zone of its own."""
    return F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_ZONE), ts_utc.cast("timestamp_ntz"))


def text_date(text: Column) -> Column:
    """Date part of an ISO text, null when it is none."""
    return F.try_to_date(F.substring(text, 1, 10), DAY_DASHED)
