"""Row generators for the calendar and the clock."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import clock

SECONDS_PER_DAY = 86_400


def calendar_days(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per day from ``first`` to ``last``, both read from the one row of ``bounds``."""
    return bounds.select(F.explode(F.sequence(first, last)).alias("Date"))


def calendar_years(spark: SparkSession, start: date, years: int) -> DataFrame:
    """One row per day of the ``years`` years from ``start``, the end day left out."""
    first = F.lit(str(start)).cast("date")
    past_end = F.add_months(first, 12 * years)
    return calendar_days(spark.range(1), first, F.date_sub(past_end, 1))


def date_columns(days: DataFrame, as_of: datetime) -> DataFrame:
    """All columns of the date dimension for rows that hold a ``Date``."""
    day = F.col("Date")
    week_day, month = F.date_format(day, "EEEE"), F.date_format(day, "MMMM")
    small = "smallint"
    return days.select(
        clock.date_key(day).alias("DateKey"),
        day,
        F.dayofmonth(day).cast(small).alias("Day"),
        clock.sunday_week(day).cast(small).alias("Week"),
        week_day.alias("WeekDayName"),
        clock.short_name(week_day).alias("WeekDayNameShort"),
        F.dayofweek(day).cast(small).alias("DayOfWeek"),
        F.dayofyear(day).cast(small).alias("DayOfYear"),
        F.month(day).cast(small).alias("Month"),
        month.alias("MonthName"),
        clock.short_name(month).alias("MonthNameShort"),
        F.quarter(day).cast(small).alias("Quarter"),
        clock.quarter_name(day).alias("QuarterName"),
        F.year(day).cast(small).alias("Year"),
        F.trunc(day, "year").alias("FirstOfYear"),
        clock.moment(as_of).alias("CreatedDate"),
        clock.moment(as_of).alias("ModifiedDate"),
    )


def clock_rows(spark: SparkSession, as_of: datetime) -> DataFrame:
    """The time dimension: one row per second of the day, keys from 1."""
    second = F.col("id")
    hour, minute = F.floor(second / 3600), F.floor(second / 60) % 60
    hour12 = (hour + 11) % 12 + 1

    def two(number: Column) -> Column:
        return F.lpad(number.cast("string"), 2, "0")

    tail = F.concat_ws(":", two(minute), two(second % 60))
    half = F.when(hour < 12, F.lit("AM")).otherwise(F.lit("PM"))
    text24 = F.concat_ws(":", two(hour), tail)
    small = "smallint"
    return spark.range(SECONDS_PER_DAY).select(
        (second + 1).cast("int").alias("TimeKey"),
        text24.alias("Time24Hr"),
        F.concat_ws(" ", F.concat_ws(":", two(hour12), tail), half).alias("Time12Hr"),
        text24.alias("Time24HrTimeType"),
        hour.cast(small).alias("Hour24"),
        hour12.cast(small).alias("Hour12"),
        minute.cast(small).alias("MinuteNumber"),
        (second % 60).cast(small).alias("SecondNumber"),
        clock.moment(as_of).alias("CreatedDate"),
        clock.moment(as_of).alias("ModifiedDate"),
    )
