"""Time stamps of the form ``Sun Jan 23 00:00:00 +0000 2011``, always in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The time pattern after the day name, and the two hour labels.
CREATION_TIME = "MMM dd HH:mm:ss Z yyyy"
PADDED_HOUR = "%02d/%02d %02d"
UNPADDED_HOUR = "%d/%d %d"


def parse_creation_time(text: Column) -> Column:
    """The instant as a time stamp without zone, in UTC; NULL when malformed.

    Spark parsers refuse the pattern letters for the day name, so it is checked
    and cut. Counting microseconds from the epoch keeps the result independent
    of the session time zone.
    """
    named = text.rlike("^(Mon|Tue|Wed|Thu|Fri|Sat|Sun) ")
    instant = F.try_to_timestamp(F.when(named, F.substr(text, F.lit(5))), F.lit(CREATION_TIME))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def between_exclusive(time: Column, low: str, high: str) -> Column:
    """Both bounds are UTC and excluded."""
    return (time > F.lit(low).cast("timestamp_ntz")) & (time < F.lit(high).cast("timestamp_ntz"))


def hour_of(time: Column) -> Column:
    """The start of the hour. ``date_trunc`` would go through the session time zone."""
    return F.timestamp_add("HOUR", F.hour(time), time.cast("date").cast("timestamp_ntz"))


def hour_label(time: Column, form: str) -> Column:
    """Month, day and hour, taken from the fields and so free of the session time zone."""
    return F.format_string(form, F.month(time), F.day(time), F.hour(time))
