from datetime import date, datetime

from pyspark.sql import functions as F

from shiftloom.functions import clock, text
from shiftloom.sources import generators


def values(df):
    return [tuple(row) for row in df.collect()]


def test_number_or_null(spark):
    texts = ["Calc Failed", "1.5", "1.5d", "NaN", "$1,000", "", None, " -2e3 ", ".5", "5.", "-", "1,5"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    found = [r[0] for r in rows.select(text.number_or_null(F.col("v"))).collect()]
    assert found == [None, 1.5, None, None, None, None, None, -2000.0, 0.5, 5.0, None, None]


def test_after_first(spark):
    rows = spark.createDataFrame([("DOM\\a\\b",), ("plain",), ("end\\",), (None,)], "v string")
    found = [r[0] for r in rows.select(text.after_first(F.col("v"), "\\")).collect()]
    assert found == ["a\\b", "plain", "", None]


def test_path_depth(spark):
    rows = spark.createDataFrame([("a",), ("a\\b\\c",)], "v string")
    assert [r[0] for r in rows.select(text.path_depth(F.col("v"))).collect()] == [1, 3]


def test_attribute_tests_ignore_case(spark):
    rows = spark.createDataFrame([("Pump MODE",), ("tank LEVELS",), ("level %",), ("Level % x",)], "a string")
    found = values(rows.select(text.is_state_attribute(F.col("a")), text.is_level_attribute(F.col("a"))))
    assert found == [(True, False), (False, True), (False, True), (False, False)]


def test_minutes_cross_boundaries(spark):
    rows = spark.range(1).select(
        clock.minutes_crossed(clock.moment("2024-01-01 06:00:30"), clock.moment("2024-01-01 06:01:10")),
        clock.minutes_crossed(clock.moment("2024-01-01 06:00:00"), clock.moment("2024-01-01 05:52:00")),
    )
    assert values(rows) == [(1, -8)]


def test_band_end_folds_early_readings(spark):
    anchor = clock.moment("2024-01-01 06:00:00")
    early = {-8: ("06:05:00", "05:55:00"), 0: ("06:05:00",) * 2, 4: ("06:05:00",) * 2, 5: ("06:10:00",) * 2}
    for minutes, (folded, own) in early.items():
        ts = clock.add_minutes(anchor, F.lit(minutes))
        row = spark.range(1).select(
            clock.clock_text(clock.band_end(anchor, ts, 5)),
            clock.clock_text(clock.band_end(anchor, ts, 5, fold_negative=False)),
        )
        assert values(row) == [(folded, own)]


def test_zone_follows_summer_time(spark):
    row = spark.range(1).select(
        clock.to_zone(clock.moment("2024-07-01 12:00:00"), "America/New_York"),
        clock.to_zone(clock.moment("2024-01-01 12:00:00"), "America/New_York"),
    )
    assert values(row) == [(datetime(2024, 7, 1, 8), datetime(2024, 1, 1, 7))]


def test_calendar_covers_years(spark):
    days = generators.calendar_years(spark, date(2023, 3, 1), 2)
    assert days.agg(F.count("*"), F.min("Date"), F.max("Date")).first() == (
        731, date(2023, 3, 1), date(2025, 2, 28))


def test_clock_rows(spark):
    rows = generators.clock_rows(spark, datetime(2024, 1, 1))
    assert rows.agg(F.count("*"), F.min("TimeKey"), F.max("TimeKey")).first() == (86400, 1, 86400)
    texts = rows.where("TimeKey in (1, 43201, 86400)").orderBy("TimeKey").select("Time24Hr", "Time12Hr", "Hour12")
    assert values(texts) == [
        ("00:00:00", "12:00:00 AM", 12), ("12:00:00", "12:00:00 PM", 12), ("23:59:59", "11:59:59 PM", 11)]


def test_pairs_and_splits(spark):
    rows = spark.createDataFrame([("a,b,c", "x,y")], "l string, r string")
    assert values(text.paired_rows(rows, "l", "r", ("p", "q")).select("position", "p", "q")) == [
        (1, "a", "x"), (2, "b", "y")]
    assert values(text.split_rows(rows, "l", "item").select("position", "item")) == [
        (1, "a"), (2, "b"), (3, "c")]
