"""Calendar and clock arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

# Last moment of an open version, and the casing of the quarter names.
OPEN_END = "9999-12-31"
QUARTER_NAMES = {1: "First", 2: "second", 3: "third", 4: "fourth"}


def moment(value: datetime | date | str | Column) -> Column:
    """A load time as a zone-free timestamp."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def open_end() -> Column:
    return moment(OPEN_END)


def date_key(day: Column) -> Column:
    """20240131 for 2024-01-31."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def sunday_week(day: Column) -> Column:
    """Week of the year; week 1 holds January 1 and weeks start on Sunday."""
    lead_days = F.dayofweek(F.trunc(day, "year")) - 2
    return F.floor((F.dayofyear(day) + lead_days) / 7) + 1


def short_name(name: Column) -> Column:
    return F.upper(F.left(name, F.lit(3)))


def quarter_name(day: Column) -> Column:
    names = F.lit(None).cast("string")
    for number, text in QUARTER_NAMES.items():
        names = F.when(F.quarter(day) == number, F.lit(text)).otherwise(names)
    return names


def clock_text(ts: Column) -> Column:
    """HH:mm:ss of a timestamp, read off its text form, so the clock never shifts."""
    return F.substring(ts.cast("string"), 12, 8)


def exact_clock_text(ts: Column) -> Column:
    """Clock text with the fraction of a second, if there is one."""
    return F.substring(ts.cast("string"), 12, 15)


def add_minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(mins=minutes.cast("int"))


def add_seconds(ts: Column, seconds: int) -> Column:
    return ts + F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))


def minute_number(ts: Column) -> Column:
    """Minutes since 1970, seconds cut off."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def minutes_crossed(start: Column, end: Column) -> Column:
    """Minute boundaries between two moments (06:00:30 to 06:01:10 is 1), not elapsed minutes."""
    return minute_number(end) - minute_number(start)


def band_end(anchor: Column, ts: Column, size: int, fold_negative: bool = True) -> Column:
    """End of the ``size``-minute band that holds ``ts``, counted from ``anchor``.

    With ``fold_negative`` a moment before the anchor is counted by the absolute
    band number and so lands at or after the anchor; without, in its own band.
    """
    band = F.floor(minutes_crossed(anchor, ts) / size) + 1
    return add_minutes(anchor, (F.abs(band) if fold_negative else band) * size)


def to_zone(ts: Column, zone: str | None) -> Column:
    """UTC clock to the clock of ``zone``; unchanged without one."""
    return ts if zone is None else F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)
