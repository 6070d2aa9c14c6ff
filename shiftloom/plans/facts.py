"""Generic fact loads."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..operators.lookups import (
    Lookup, column_pairs, common_lookups, distinct_rows, fact_lookups, look_up, resolve, with_location, with_next_day,
)
from ..operators.merge import KeyRules, MergeResult, VersionRules, insert_only, versioned
from ..operators.partitioned import Partitions, insert_partitions, versioned_partitions
from ..operators.shifts import attribute_shift
from ..sources.tables import settle


@dataclass(frozen=True)
class LocationRule:
    """Stage ``column`` meets location ``lookup_column``; ``level`` is Plant or Element."""

    column: str
    lookup_column: str
    level: str
    into: str = "LocationKey"
    effective_at: str | None = None


@dataclass(frozen=True)
class ShiftRule:
    """Stage columns of the production day and the HH:mm:ss clock, and of the mine if the stage has it."""

    day: str
    clock: str
    mine: str | None = None


def location_rule(rows: Iterable[Mapping[str, str]], table: str) -> LocationRule | None:
    """From the fact's metadata row for the location table, if it has one."""
    for r in rows:
        if r["FactTableName"] == table and r["LookupTableName"] == "Location":
            at = r["SCDDateField"] if r["LookupIsSCD"] == "Yes" else None
            return LocationRule(r["StgColumnName"], r["LookupColumnName"], r["LocationLevel"], r["FactColumnName"], at)
    return None


def shift_rule(rows: Iterable[Mapping[str, str]], table: str) -> ShiftRule | None:
    """From the fact's metadata rows for the roster table: one names the clock column, the others the
    columns of the production day and the mine. At element grain the plant gives the mine."""
    mine = [r for r in rows if r["FactTableName"] == table and r["LookupTableName"] == "CrewShiftMapping"]
    if not mine:
        return None
    clock = next((r["StgColumnName"] for r in mine if "time" in r["StgColumnName"].lower()), None)
    if clock is None:
        raise ValueError(f"no roster row of {table} names its clock column")
    pairs = {
        theirs: ours for r in mine if "time" not in r["StgColumnName"].lower()
        for ours, theirs in column_pairs(r["StgColumnName"], r["LookupColumnName"])
    }
    place = location_rule(rows, table)
    at_element = place is not None and place.level == "Element"
    if "ProductionDate" not in pairs:
        raise ValueError(f"no roster row of {table} names its production day")
    return ShiftRule(pairs["ProductionDate"], clock, None if at_element else pairs.get("MineID"))


def fact_source(stage: DataFrame, lookups: Iterable[Lookup], tables: Mapping[str, DataFrame | None],
                location: LocationRule | None = None, shift: ShiftRule | None = None) -> DataFrame:
    """Stage rows with all keys resolved, distinct.

    ``tables`` holds the lookup tables by name, ``Date`` included; a shift rule also
    needs ``Location``, ``CrewShiftMapping``, ``Crew`` and ``Shift``.
    """
    tables = dict(tables)
    if tables.get("Date") is not None:
        tables["Date"] = with_next_day(tables["Date"])
    rows = resolve(stage, lookups, tables)
    if location is not None:
        rows = with_location(rows, tables["Location"], location.column, location.lookup_column,
                             location.level, location.into, location.effective_at)
    if shift is not None:
        today = Lookup("Date", "DateKey", "_today_key", ((shift.day, "Date"),), unknown=None,
                       also=(("NextDateKey", "_next_key"),))
        rows = attribute_shift(
            look_up(rows, tables["Date"], today), tables["CrewShiftMapping"], tables["Crew"],
            tables["Shift"], day=F.col(shift.day), time_of_day=F.col(shift.clock),
            mine=F.col(shift.mine or "_mine"), plant_key=F.col("_plant_key"),
            date_key=F.col("_today_key"), next_date_key=F.col("_next_key"),
        )
    helpers = ("_mine", "_plant_key", "_today_key", "_next_key")
    return distinct_rows(rows.drop(*helpers))


def load_fact(target: DataFrame, stage: DataFrame, lookups: Iterable[Lookup],
              tables: Mapping[str, DataFrame | None], key: tuple[str, ...], as_of: datetime,
              location: LocationRule | None = None, shift: ShiftRule | None = None,
              version: VersionRules | None = None) -> MergeResult:
    """Any fact, inserted only or, with ``version``, versioned. ``key`` leaves out the version start."""
    source = settle(fact_source(stage, lookups, tables, location, shift))
    if version is None:
        return insert_only(target, source, KeyRules(key), as_of)
    return versioned(target, source, KeyRules(key), version, as_of)


def load_fact_into(path: str, stage: DataFrame, lookups: Iterable[Lookup], tables: Mapping[str, DataFrame | None],
                   key: tuple[str, ...], as_of: datetime, parts: Partitions, location: LocationRule | None = None,
                   shift: ShiftRule | None = None, version: VersionRules | None = None) -> DataFrame:
    """``load_fact`` into a partitioned table at ``path``; the change feed is returned.

    New rows of an insert-only fact are appended. A versioned fact rewrites the partitions of its source, in
    which alone keys count as gone.
    """
    source = settle(fact_source(stage, lookups, tables, location, shift))
    if version is None:
        return insert_partitions(path, source, KeyRules(key), parts, as_of)
    return versioned_partitions(path, source, KeyRules(key), parts, version, as_of)


def load_fact_by_metadata(target: DataFrame, stage: DataFrame, metadata: Iterable[Mapping[str, str]], table: str,
                          keys: Mapping[str, str], tables: Mapping[str, DataFrame | None], key: tuple[str, ...],
                          as_of: datetime, version: VersionRules | None = None) -> MergeResult:
    """Any fact whose lookups, location, shift and crew are described by metadata rows alone."""
    rows = list(metadata)
    return load_fact(
        target, stage, fact_lookups(rows, table, keys), tables, key, as_of,
        location_rule(rows, table), shift_rule(rows, table), version,
    )


def load_simple_fact(target: DataFrame, stage: DataFrame, metadata: Iterable[Mapping[str, str]],
                     stage_table: str, keys: Mapping[str, str], tables: Mapping[str, DataFrame],
                     key: tuple[str, ...], as_of: datetime,
                     version: VersionRules | None = None) -> MergeResult:
    """The common variant: simple metadata, misses stay NULL, rows not made distinct, new rows
    without a modification date. Clear the stage table once the result is written."""
    source = settle(resolve(stage, common_lookups(metadata, stage_table, keys), tables))
    if version is None:
        return insert_only(target, source, KeyRules(key), as_of, stamp_modified=False)
    return versioned(target, source, KeyRules(key), replace(version, stamp_new=False), as_of)
