"""Time-band roll-up of flagged sensor readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clock, text

BAND_KEYS = ["ReportingTime", "Attribute", "ElementID", "ElementAttributeID"]
MEASURES = ["Average", "MinValue", "MaxValue", "CumulativeTotal", "RunningAverage"]


def latest(rows: DataFrame, column: str) -> Column:
    """Largest value of a column as a scalar subquery."""
    return rows.agg(F.max(column).alias("m")).scalar()


def before_shift_end(readings: DataFrame) -> DataFrame:
    """Readings up to one second before the latest shift end."""
    return readings.where(F.col("Time") <= clock.add_seconds(latest(readings, "ShiftEndTime"), -1))


def roll_up(flagged: DataFrame, anchor: Column, band_minutes: int,
            fold_negative: bool = True) -> DataFrame:
    """Average, minimum, maximum, total and running average per band, attribute and sensor.

    A row stands for ``_weight`` copies of which ``_stopped`` are stopped. Copies do
    not move the average, minimum and maximum, as all rows of a group have the same
    weight. The total counts each copy; levels have none. The running average counts
    a stopped copy as 0 and leaves out running copies without a value. Spellings that
    differ in case are one band, under the smallest of them.
    """
    rows = flagged.where(~text.is_state_attribute(F.col("Attribute"))).select(
        "Attribute", "ElementID", "ElementAttributeID", "_stopped", "_weight",
        clock.band_end(anchor, F.col("Time"), band_minutes, fold_negative).alias("ReportingTime"),
        text.number_or_null(F.col("Value")).alias("_value"),
    )
    value, weight, stopped = F.col("_value"), F.col("_weight"), F.col("_stopped")
    counted = F.sum(F.when(value.isNull(), stopped).otherwise(weight))
    running = F.coalesce(F.sum(value * (weight - stopped)), F.lit(0.0))
    total = F.sum(value * weight)
    names = BAND_KEYS[1:]
    bands = rows.groupBy("ReportingTime", *[text.fold(F.col(c)).alias(f"_{c}") for c in names]).agg(
        *[F.min(c).alias(c) for c in names],
        F.avg(value).alias("Average"),
        F.min(value).alias("MinValue"),
        F.max(value).alias("MaxValue"),
        total.alias("_total"),
        F.when(counted != 0, running / counted).alias("RunningAverage"),
    )
    cumulative = F.when(~text.is_level_attribute(F.col("Attribute")), F.col("_total"))
    return bands.select(
        *BAND_KEYS, "Average", "MinValue", "MaxValue", cumulative.alias("CumulativeTotal"),
        "RunningAverage",
    )
