"""Shift summaries: sensor readings rolled up into time bands, keyed and upserted."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions import clock
from ..operators.lookups import (
    Lookup, UNKNOWN, look_up, with_date_and_time_keys, with_location, with_next_day,
)
from ..operators.merge import KeyRules, MergeResult, upsert
from ..operators.partitioned import Partitions, upsert_partitions
from ..operators.rollup import MEASURES, before_shift_end, latest, roll_up
from ..operators.shifts import attribute_shift
from ..operators.status import flag_readings
from ..sources.tables import settle

SUMMARY_KEY = ("LocationKey", "AttributeKey", "ReportingDateKey", "ReportingTimeKey")
EASTERN = "America/New_York"


@dataclass(frozen=True)
class Summary:
    """A summary's band width, measure names and which attribute version a band belongs to."""

    band_minutes: int
    measures: tuple[str, ...]
    effective_dated: bool
    until_shift_end: bool


CURRENT_SHIFT = Summary(
    5, ("AverageMinute", "MinValueMinute", "MaxValueMinute", "CumulativeTotalMinute",
        "ActualRunningAverage"), effective_dated=True, until_shift_end=False,
)
PAST_SHIFT = Summary(
    60, ("Averagehourly", "MinValuehourly", "MaxValuehourly", "CumulativeTotalhourly",
         "ActualRunningAverage"), effective_dated=False, until_shift_end=True,
)


@dataclass(frozen=True)
class Dimensions:
    """Tables that a summary row is keyed by."""

    attribute: DataFrame
    calendar: DataFrame
    time_of_day: DataFrame
    location: DataFrame
    bridge: DataFrame
    crew: DataFrame
    shift: DataFrame


@dataclass(frozen=True)
class RollupOptions:
    """Departures from the strict rules: see ``flag_readings`` and ``band_end``."""

    dedupe: bool = False
    close_open_off: bool = False
    fold_negative: bool = True
    default_keys: bool = False
    convert_from_utc_to: str | None = None


STRICT = RollupOptions()


def bands(readings: DataFrame, summary: Summary, options: RollupOptions = STRICT) -> DataFrame:
    """Readings rolled up into bands from the latest shift start on."""
    anchor = latest(readings, "ShiftStartTime")
    rows = before_shift_end(readings) if summary.until_shift_end else readings
    rows = rows.select(
        "ElementAttributeID", "ElementID", "Attribute", "Value", "CategoryName",
        clock.to_zone(F.col("Time"), options.convert_from_utc_to).alias("Time"),
    )
    flagged = flag_readings(rows, options.close_open_off, options.dedupe)
    return roll_up(flagged, anchor, summary.band_minutes, options.fold_negative)


def summary_rows(readings: DataFrame, dims: Dimensions, summary: Summary,
                 options: RollupOptions = STRICT) -> DataFrame:
    """Bands with all keys resolved; the lookups run on bands, far fewer than readings."""
    names = (("ElementAttributeID", "AttributeID"), ("Attribute", "Name"))
    attribute = Lookup(
        "Attribute", "AttributeKey", "AttributeKey", names, required=True,
        effective_at="ReportingTime" if summary.effective_dated else None,
        current_only=not summary.effective_dated,
    )
    keyed = look_up(bands(readings, summary, options), dims.attribute, attribute)
    keyed = with_date_and_time_keys(
        keyed, dims.calendar, dims.time_of_day, "ReportingTime", "ReportingDateKey",
        "ReportingTimeKey", UNKNOWN if options.default_keys else None,
    )
    keyed = keyed.withColumn("_date", F.to_date("ReportingTime"))
    today = Lookup("Date", "DateKey", "_today_key", (("_date", "Date"),), unknown=None,
                   also=(("NextDateKey", "_next_key"),))
    keyed = look_up(keyed, with_next_day(dims.calendar), today)
    keyed = with_location(keyed, dims.location, "ElementID", "ElementID", "Element")
    keyed = attribute_shift(
        keyed, dims.bridge, dims.crew, dims.shift,
        day=F.col("_date"), time_of_day=clock.clock_text(F.col("ReportingTime")),
        mine=F.col("_mine"), plant_key=F.col("_plant_key"),
        date_key=F.col("_today_key"), next_date_key=F.col("_next_key"),
    )
    return keyed.select(
        "ReportingDateKey", "ReportingTimeKey", "LocationKey", "CrewKey", "ShiftEndDateKey",
        "ShiftTimeKey", "AttributeKey",
        *[F.col(plain).alias(name) for plain, name in zip(MEASURES, summary.measures)],
    )


def merge_summary(target: DataFrame, rows: DataFrame, summary: Summary, as_of: datetime,
                  duplicates: str = "raise") -> MergeResult:
    """Upsert on location, attribute, date and time; crew and shift stay as first loaded."""
    return upsert(target, rows, KeyRules(SUMMARY_KEY, duplicates), as_of, update=summary.measures)


def load_summary(target: DataFrame, readings: DataFrame, dims: Dimensions, summary: Summary,
                 as_of: datetime, options: RollupOptions = STRICT,
                 duplicates: str = "raise") -> MergeResult:
    """Readings to merged summary. The bands are written once before the merge reads them."""
    rows = settle(summary_rows(readings, dims, summary, options))
    return merge_summary(target, rows, summary, as_of, duplicates)


#: How a stored summary is laid out.
BY_DAY = Partitions(("ReportingDateKey",))


def load_summary_into(path: str, readings: DataFrame, dims: Dimensions, summary: Summary, as_of: datetime,
                      options: RollupOptions = STRICT, duplicates: str = "raise", parts: Partitions = BY_DAY) -> DataFrame:
    """``load_summary`` into a table partitioned by day at ``path``: only days with bands are read, and only days
    in which a row changes are written. The change feed is returned. With ``stale="remove"`` in ``parts``, rows of those
    days that the readings no longer give go.
    """
    rows = settle(summary_rows(readings, dims, summary, options))
    return upsert_partitions(path, rows, KeyRules(SUMMARY_KEY, duplicates), parts, as_of, update=summary.measures)
