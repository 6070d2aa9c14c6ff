"""Whole loads on hand-made tables."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shiftloom.operators.lookups import with_date_and_time_keys, with_location
from shiftloom.plans import calendar
from shiftloom.plans.summary import CURRENT_SHIFT, Dimensions, RollupOptions, load_summary
from shiftloom.sources import generators

NOW = datetime(2024, 2, 1)
EARLY, END = datetime(2020, 1, 1), datetime(9999, 12, 31)


def test_load_dates_twice(spark):
    empty = generators.date_columns(spark.createDataFrame([], "Date date"), NOW)
    once = calendar.load_dates(empty, date(2024, 1, 1), 1, NOW).state
    assert once.count() == 366
    more = calendar.load_dates(once, date(2024, 12, 1), 1, NOW)
    assert more.inserted.count() == 365 - 31
    assert more.state.where("DateKey = 20240101").first()["Week"] == 1


@pytest.fixture
def dims(spark):
    days = generators.calendar_years(spark, date(2024, 1, 1), 1)
    attribute = spark.createDataFrame(
        [(1, "A1", "flow", 1, EARLY, END)], "AttributeKey long, AttributeID string, Name string, IsCurrent int, "
        "EffectiveStartTime timestamp_ntz, EffectiveEndTime timestamp_ntz")
    location = spark.createDataFrame(
        [(5, "L5", None, "E1", "north", "E one"), (6, "P6", "M1", None, None, "North")],
        "LocationKey long, LocationID string, MineID string, ElementID string, Plant string, Name string")
    bridge = spark.createDataFrame(
        [(date(2024, 1, 1), "M1", 1, "06:00:00", "17:59:59", 20240101, "c", "D"),
         (date(2024, 1, 1), "M1", 2, "18:00:00", "05:59:59", 20240102, "c", "N")],
        "ProductionDate date, MineID string, ShiftOrder int, ShiftStartTime string, ShiftEndTime string, "
        "ShiftEndDateKey int, CrewCode string, CrewID string")
    crew = spark.createDataFrame([(31, "C", "d", 1), (32, "C", "n", 1)],
                                 "CrewKey long, CrewCode string, CrewID string, IsCurrent int")
    shift = spark.createDataFrame(
        [(41, 1, 6, "06:00:00", "17:59:59", 1), (42, 2, 6, "18:00:00", "05:59:59", 1)],
        "ShiftKey long, ShiftOrder int, LocationKey long, ShiftStartTime string, ShiftEndTime string, IsCurrent int")
    return Dimensions(attribute, generators.date_columns(days, NOW), generators.clock_rows(spark, NOW), location,
                      bridge, crew, shift)


TARGET = ("ReportingDateKey int, ReportingTimeKey int, LocationKey long, CrewKey long, ShiftEndDateKey int, "
          "ShiftTimeKey long, AttributeKey long, AverageMinute double, MinValueMinute double, "
          "MaxValueMinute double, CumulativeTotalMinute double, ActualRunningAverage double, "
          "CreatedDate timestamp_ntz, ModifiedDate timestamp_ntz")
READINGS = ("ElementAttributeID string, ElementID string, Attribute string, Value string, CategoryName string, "
            "Time timestamp_ntz, ShiftStartTime timestamp_ntz")


def reading(hour, minute, value="2", day=1, month=1):
    return ("a1", "e1", "Flow", value, "Process", datetime(2024, month, day, hour, minute), datetime(2024, 1, 1, 6))


def test_load_summary(spark, dims):
    empty = spark.createDataFrame([], TARGET)
    first = [reading(6, 1), reading(6, 2, "4"), reading(19, 0), reading(7, 0, "x", day=2)]
    stage = spark.createDataFrame(first, READINGS)
    loaded = load_summary(empty, stage, dims, CURRENT_SHIFT, NOW)
    columns = ["ReportingDateKey", "ReportingTimeKey", "LocationKey", "CrewKey", "ShiftEndDateKey",
               "ShiftTimeKey", "AverageMinute", "CumulativeTotalMinute"]
    assert sorted(tuple(r) for r in loaded.state.select(*columns).collect()) == [
        (20240101, 21901, 5, 31, 20240101, 41, 3.0, 6.0),
        (20240101, 68701, 5, 32, 20240102, 42, 2.0, 2.0),
        (20240102, 25501, 5, -1, 20240102, 41, None, None)]
    moved = spark.createDataFrame([reading(6, 1), reading(6, 2, "8"), reading(19, 0)], READINGS)
    again = load_summary(loaded.state, moved, dims, CURRENT_SHIFT, datetime(2024, 3, 1))
    assert again.inserted.count() == 0
    assert [r.AverageMinute for r in again.existing.where("ModifiedDate > CreatedDate").collect()] == [5.0]


def test_load_summary_from_utc(spark, dims):
    stage = spark.createDataFrame([reading(11, 1)], READINGS)
    options = RollupOptions(convert_from_utc_to="America/New_York")
    loaded = load_summary(spark.createDataFrame([], TARGET), stage, dims, CURRENT_SHIFT, NOW, options)
    assert loaded.inserted.first()["ReportingTimeKey"] == 21901


def test_missing_date_key(spark, dims):
    rows = spark.createDataFrame([(datetime(2030, 1, 1, 6),), (datetime(2024, 1, 1, 6, 0, 0, 5),)], "t timestamp_ntz")
    args = (rows, dims.calendar, dims.time_of_day, "t", "d", "c")
    found = sorted(with_date_and_time_keys(*args).select("d", "c").collect(), key=repr)
    assert [tuple(r) for r in found] == [(20240101, None), (None, 21601)]
    filled = with_date_and_time_keys(*args, unknown=-1).agg(F.min("d"), F.min("c")).first()
    assert tuple(filled) == (-1, -1)


def test_location_level_must_be_known(spark, dims):
    with pytest.raises(ValueError):
        with_location(dims.location, dims.location, "Name", "Name", "Site")
