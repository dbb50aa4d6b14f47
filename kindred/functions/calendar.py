"""Calendar and clock columns.

All wall-clock values are ``TIMESTAMP_NTZ`` computed with explicit zones,
so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def parse_date(col) -> Column:
    """Text or date to date; unparseable text gives null."""
    return F.try_to_date(_c(col).cast("string"))


def publish_date_local(ts_utc, zone: str = "America/New_York") -> Column:
    """Date of a UTC wall-clock timestamp seen in ``zone``."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone),
                                        _c(ts_utc).cast("timestamp_ntz")))


def day_name(d) -> Column:
    """Full English day name, e.g. ``Monday``."""
    return F.date_format(_c(d), "EEEE")


def weekpart(d) -> Column:
    """``weekend`` for Saturday/Sunday; everything else, null included, is ``weekday``."""
    return F.when(F.weekday(_c(d)) >= 5, F.lit("weekend")).otherwise(F.lit("weekday"))


def day_of_month(d) -> Column:
    return F.dayofmonth(_c(d))


def month(d) -> Column:
    return F.month(_c(d))


def epoch_to_utc(sec) -> Column:
    """Epoch seconds to a UTC wall-clock ``TIMESTAMP_NTZ``."""
    return F.timestamp_add("SECOND", _c(sec).cast("long"), F.expr(EPOCH_NTZ))


def epoch_to_text(sec) -> Column:
    """Epoch seconds to ``yyyy-MM-dd HH:mm:ss`` text, UTC."""
    return F.date_format(epoch_to_utc(sec), "yyyy-MM-dd HH:mm:ss")


def text_to_timestamp(text) -> Column:
    """Text to ``TIMESTAMP_NTZ``; invalid text gives null."""
    return F.try_to_timestamp(_c(text), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def to_local(ts_utc, zone: str) -> Column:
    """UTC wall clock to the wall clock of ``zone`` (daylight saving aware)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(ts_utc))


def session_start(visit_start, country, home_country: str, home_zone: str) -> Column:
    """Wall clock of the session start: local time for the home country, else UTC."""
    utc = epoch_to_utc(visit_start)
    return F.when(_c(country) == F.lit(home_country), to_local(utc, home_zone)).otherwise(utc)


def business_hours(hour) -> Column:
    """8 <= hour < 18 is ``business_hours``; all else, null included, is not."""
    h = _c(hour)
    return F.when((h >= 8) & (h < 18), F.lit("business_hours")) \
        .otherwise(F.lit("non_business_hours"))
