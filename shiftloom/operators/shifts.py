"""Crew and shift attribution."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clock
from .lookups import UNKNOWN, Lookup, current_rows, resolve

DAY, NIGHT = 1, 2


def crew_shift_bridge(stage: DataFrame, shift: DataFrame, calendar: DataFrame,
                      time_of_day: DataFrame, location: DataFrame, as_of: datetime) -> DataFrame:
    """Shift rosters with the location of their shift and the keys of their end date and start time."""
    specs = [
        Lookup("Shift", "LocationKey", "_location",
               (("ScheduleID", "ScheduleID"), ("ShiftOrder", "ShiftOrder")),
               current_only=True, unknown=None),
        Lookup("Date", "DateKey", "ShiftEndDateKey", (("ShiftEndDate", "Date"),), unknown=None),
        Lookup("Time", "TimeKey", "ShiftStartTimeKey",
               (("ShiftStartTime", "Time24HrTimeType"),), unknown=None),
        Lookup("Location", "LocationID", "LocationID", (("_location", "LocationKey"),),
               unknown=None, also=(("MineID", "MineID"),)),
    ]
    tables = {"Shift": shift, "Date": calendar, "Time": time_of_day, "Location": location}
    return resolve(stage, specs, tables).select(
        "ShiftID", "ShiftDescription", "ShiftOrder", "LocationID", "MineID", "CrewID", "CrewCode",
        "ScheduleID", "ShiftStartDate", "ShiftEndDate", "ShiftStartTime", "ShiftEndTime",
        "ShiftEndDateKey", "ShiftStartTimeKey", "ProductionDate",
        clock.moment(as_of).alias("CreatedDate"), clock.moment(as_of).alias("ModifiedDate"),
    )


def _rosters(bridge: DataFrame, crew: DataFrame, order: int, prefix: str) -> DataFrame:
    """Rosters of one shift order with the current crew's key, under ``prefix`` names."""
    spec = Lookup("Crew", "CrewKey", "_crew", (("CrewCode", "CrewCode"), ("CrewID", "CrewID")),
                  current_only=True, unknown=None)
    rows = resolve(bridge.where(F.col("ShiftOrder") == order), [spec], {"Crew": crew})
    return rows.select(
        F.col("ProductionDate").alias(f"{prefix}date"), F.col("MineID").alias(f"{prefix}mine"),
        F.col("ShiftStartTime").alias(f"{prefix}from"), F.col("ShiftEndTime").alias(f"{prefix}to"),
        F.col("ShiftEndDateKey").alias(f"{prefix}end"), F.col("_crew").alias(f"{prefix}crew"),
    )


def _shifts(shift: DataFrame, order: int, prefix: str) -> DataFrame:
    rows = current_rows(shift).where(F.col("ShiftOrder") == order)
    return rows.select(
        F.col("LocationKey").alias(f"{prefix}location"), F.col("ShiftKey").alias(f"{prefix}key"),
        F.col("ShiftStartTime").alias(f"{prefix}from"), F.col("ShiftEndTime").alias(f"{prefix}to"),
    )


def _within(value: Column, prefix: str) -> Column:
    """False, not unknown, when the roster is missing: the night side then answers."""
    inside = value.between(F.col(f"{prefix}from"), F.col(f"{prefix}to"))
    return F.coalesce(inside, F.lit(False))


def attribute_shift(rows: DataFrame, bridge: DataFrame, crew: DataFrame, shift: DataFrame,
                    day: Column, time_of_day: Column, mine: Column, plant_key: Column,
                    date_key: Column, next_date_key: Column) -> DataFrame:
    """Add ShiftEndDateKey, ShiftTimeKey and CrewKey; none of them is ever NULL.

    A moment inside the day roster belongs to it, any other moment to the night
    roster. Without a roster the end date is the day itself inside the day shift and
    the next day otherwise. Day and night tables join by equality, once per role.
    """
    columns = rows.columns
    rows = rows.withColumns({
        "_day": day, "_clock": time_of_day, "_at_mine": mine, "_at_plant": plant_key,
        "_today": date_key, "_tomorrow": next_date_key,
    })
    for order, prefix in ((DAY, "_dr_"), (NIGHT, "_nr_")):
        on = (F.col("_day") == F.col(f"{prefix}date")) & (F.col("_at_mine") == F.col(f"{prefix}mine"))
        rows = rows.join(_rosters(bridge, crew, order, prefix), on, "left")
    for order, prefix in ((DAY, "_ds_"), (NIGHT, "_ns_")):
        on = F.col("_at_plant") == F.col(f"{prefix}location")
        rows = rows.join(_shifts(shift, order, prefix), on, "left")
    on_roster, on_shift = _within(F.col("_clock"), "_dr_"), _within(F.col("_clock"), "_ds_")

    def choose(test: Column, yes: str, no: str) -> Column:
        return F.when(test, F.col(yes)).otherwise(F.col(no))

    unknown = F.lit(UNKNOWN)
    return rows.select(
        *columns,
        F.coalesce(
            choose(on_roster, "_dr_end", "_nr_end"),
            choose(on_shift, "_today", "_tomorrow"),
            unknown,
        ).alias("ShiftEndDateKey"),
        F.coalesce(choose(on_shift, "_ds_key", "_ns_key"), unknown).alias("ShiftTimeKey"),
        F.coalesce(choose(on_roster, "_dr_crew", "_nr_crew"), unknown).alias("CrewKey"),
    )
