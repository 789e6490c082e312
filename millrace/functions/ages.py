"""Coarse ages such as `3h`, and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seconds of a unit (fixed values of the format).
UNITS = {"m": 60, "h": 3600, "d": 86400, "w": 604800}
#: How a run's file is stamped.
STAMP = "yyyy-MM-dd'T'HH-mm-ss'Z'"


def age_seconds(age: Column) -> Column:
    """Seconds of an age; null if it is empty, its unit unknown or its number none."""
    unit = F.right(age, F.lit(1))
    seconds = F.lit(None).cast("long")
    for u, s in UNITS.items():
        seconds = F.when(unit == u, s).otherwise(seconds)
    number = F.substring(age, F.lit(1), F.length(age) - 1)
    return F.when(number.rlike(r"\A[0-9]+\z"), number.try_cast("long")) * seconds


def age_of(seconds: Column) -> Column:
    """The age that a feed shows: minutes below an hour, hours below a day, days below a week, else weeks."""
    out = F.concat(F.floor(seconds / UNITS["w"]).cast("string"), F.lit("w"))
    for u, top in (("d", UNITS["w"]), ("h", UNITS["d"]), ("m", UNITS["h"])):
        out = F.when(seconds < top, F.concat(F.floor(seconds / UNITS[u]).cast("string"), F.lit(u))).otherwise(out)
    return F.when(seconds >= 0, out)


def age_unit(age: Column) -> Column:
    """The last character of an age, `?` if there is none."""
    return F.right(F.coalesce(F.nullif(age, F.lit("")), F.lit("?")), F.lit(1))


def posted_at(captured: Column, age: Column) -> Column:
    return F.timestamp_add("SECOND", -age_seconds(age), captured)


def iso(ts: Column) -> Column:
    """ISO 8601 in UTC, with microseconds only if there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.when(F.date_format(ts, "SSSSSS") == "000000", whole).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970, as a whole number."""
    return F.unix_millis(ts)


def run_stamp(ts: Column) -> Column:
    return F.date_format(ts, STAMP)


def stamped(name: Column, prefix: str = "posts_") -> Column:
    """The time in a run file's name; null if there is none."""
    return F.try_to_timestamp(F.regexp_extract(name, rf"{prefix}([0-9T:Z-]+Z)", 1), F.lit(STAMP))


def boundary(last: Column, now: Column, max_age_days: int, overlap_hours: int) -> Column:
    """Where an incremental run stops: the later of the last capture and the oldest age wanted, less an overlap. A null last is a first run."""
    floor = F.timestamp_add("DAY", F.lit(-max_age_days), now)
    return F.timestamp_add("HOUR", F.lit(-overlap_hours), F.greatest(last, floor))
