"""Date and time dimensions and their presentation views."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from ..operators.merge import AUDIT, KeyRules, MergeResult, insert_only
from ..sources import generators

DATE_KEY = KeyRules(("DateKey",), duplicates="unique")


def load_dates(target: DataFrame, start: date, years: int, as_of: datetime) -> MergeResult:
    """Add the days of ``years`` years from ``start`` that the date dimension lacks."""
    return merge_dates(target, generators.calendar_years(target.sparkSession, start, years), as_of)


def merge_dates(target: DataFrame, days: DataFrame, as_of: datetime) -> MergeResult:
    """Add the given days that the date dimension lacks."""
    return insert_only(target, generators.date_columns(days, as_of), DATE_KEY, as_of)


def load_times(spark: SparkSession, as_of: datetime) -> DataFrame:
    """The whole time dimension. Written by overwriting, so a second run changes nothing."""
    return generators.clock_rows(spark, as_of)


def date_view(dates: DataFrame) -> DataFrame:
    return dates.drop(*AUDIT)


def time_view(times: DataFrame) -> DataFrame:
    """Audit columns and the typed time left out."""
    return times.drop(*AUDIT, "Time24HrTimeType")
