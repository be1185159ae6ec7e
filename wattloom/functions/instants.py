"""Column functions on timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How the carbon feed writes an instant, without and with seconds.
SETTLEMENT_FORMATS = ["yyyy-MM-dd'T'HH:mm'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'"]
# Fixed value: how the weather feed writes an hour; UTC is implied.
WEATHER_FORMAT = "yyyy-MM-dd'T'HH:mm"

HOUR_SECONDS = 3600


def settlement_instant(text: Column) -> Column:
    """Carbon-feed instant; NULL for anything in neither of the two formats."""
    # Only one of them can fit, and a format that doesn't is costly: it raises an error in every row.
    short, long = (F.try_to_timestamp(text, F.lit(f)) for f in SETTLEMENT_FORMATS)
    return F.when(text.rlike(":[^:]*:"), long).otherwise(short)


def weather_instant(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(WEATHER_FORMAT))


def iso_instant(text: Column) -> Column:
    """ISO-8601 with seconds and offset; NULL instead of an ANSI error on junk."""
    return F.try_to_timestamp(text)


def time_key(ts: Column) -> Column:
    """yyyyMMddHH as BIGINT, the surrogate key shared by facts and the calendar."""
    return F.date_format(ts, "yyyyMMddHH").cast("bigint")


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def iso_weekday(ts: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(ts) + 1


def hour_index(ts: Column) -> Column:
    """Whole hours since the epoch; lets RANGE frames and blocks count real hours."""
    return F.floor(F.unix_timestamp(ts) / HOUR_SECONDS).cast("bigint")


def resolution_seconds(resolution: Column) -> Column:
    """PT15M / PT30M / PT60M ... in seconds; an hour when absent or written otherwise."""
    minutes = F.regexp_extract(resolution, r"^PT(\d+)M", 1).try_cast("int")
    return F.coalesce(F.try_multiply(minutes, F.lit(60)), F.lit(HOUR_SECONDS))


def point_instant(start: Column, position: Column, step_seconds: Column) -> Column:
    """Instant of the 1-based point `position` in a period that begins at `start`.

    Counted in long seconds, so that an absurd position gives an absurd instant and no overflow.
    """
    return F.timestamp_seconds(F.unix_timestamp(start) + (position.cast("bigint") - 1) * step_seconds)


def local_time(ts: Column, zone: Column | str) -> Column:
    """UTC instant as wall-clock time of a zone, daylight saving included."""
    return F.from_utc_timestamp(ts, zone)
