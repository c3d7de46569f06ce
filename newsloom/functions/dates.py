"""Dates and epochs, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import strip

PADDED_ISO = r"^\d{4}-\d{2}-\d{2}([T ].*)?$"
WITH_ZONE = r"[T ].*(Z|[+-]\d{2}(:?\d{2})?)$"


def to_unix(c: Column) -> Column:
    """Epoch seconds of a padded ISO date or timestamp; no zone means UTC; else null."""
    t = strip(c)
    zoned = (
        F.when(t.rlike(WITH_ZONE), t)
        .when(F.length(t) > 10, F.concat(t, F.lit("Z")))
        .otherwise(F.concat(t, F.lit("T00:00:00Z")))
    )
    return F.when(t.rlike(PADDED_ISO), F.unix_seconds(F.try_to_timestamp(zoned)))


def utc_datetime(epoch: Column) -> Column:
    """Zone-less UTC timestamp of epoch seconds, fractions kept to the microsecond."""
    micros = F.rint(epoch.cast("double") * 1000000).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def iso_from_epoch(c: Column) -> Column:
    """`yyyy-MM-ddTHH:mm:ss` in UTC, with microseconds only where there are any."""
    ts = utc_datetime(c)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, ".SSSSSS")
    return F.when(fraction == ".000000", whole).otherwise(F.concat(whole, fraction))


def epoch_day(c: Column) -> Column:
    """Calendar date (UTC) of epoch seconds."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(c / 86400).cast("int"))
