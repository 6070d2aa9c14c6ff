"""Surrogate-key lookups, alone and as a chain driven by a list of specs.

No join here carries a broadcast hint: Spark sends a dimension to every task when
it measures small and shuffles it otherwise, splitting a hot source key, which a
left join from the source allows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from ..functions import clock, text
from .intervals import join_versions

UNKNOWN = -1


@dataclass(frozen=True)
class Lookup:
    """Fetch ``key`` of ``table`` as column ``into``.

    ``on`` pairs source columns with lookup columns. ``effective_at`` names the source
    column that must lie in the lookup row's effective range; ``current_only`` keeps
    current lookup rows. ``also`` lists further lookup columns to bring along, by new
    name; ``copies`` are further columns that get the key. With ``unknown=None`` a miss stays NULL; with ``required`` it drops the row.
    """

    table: str
    key: str
    into: str
    on: tuple[tuple[str, str], ...]
    effective_at: str | None = None
    current_only: bool = False
    unknown: int | None = UNKNOWN
    required: bool = False
    fold_case: bool = True
    also: tuple[tuple[str, str], ...] = ()
    copies: tuple[str, ...] = ()


def known_or_default(key: Column, default: int | None = UNKNOWN) -> Column:
    return key if default is None else F.coalesce(key, F.lit(default))


def current_rows(dimension: DataFrame) -> DataFrame:
    return dimension.where(F.col("IsCurrent") == 1)


def _equal(source: DataFrame, column: str, dimension: DataFrame, other: str, name: str,
           fold_case: bool) -> Column:
    left, right = F.col(column), F.col(name)
    kinds = (source.schema[column].dataType, dimension.schema[other].dataType)
    if fold_case and all(isinstance(kind, StringType) for kind in kinds):
        return text.fold(left) == text.fold(right)
    return left == right


def _in_range(source: DataFrame, dimension: DataFrame, side: DataFrame, spec: Lookup) -> DataFrame:
    """``source`` joined to the versions of its key that hold the moment."""
    mine, theirs = {}, {}
    for i, (ours, other) in enumerate(spec.on):
        kinds = (source.schema[ours].dataType, dimension.schema[other].dataType)
        folds = spec.fold_case and all(isinstance(kind, StringType) for kind in kinds)
        mine[f"_mine{i}"] = text.fold(F.col(ours)) if folds else F.col(ours)
        theirs[f"_mine{i}"] = text.fold(F.col(f"_on{i}")) if folds else F.col(f"_on{i}")
    joined = join_versions(source, side, mine, theirs, spec.effective_at, "_from", "_to")
    return joined.where(F.col("_from").isNotNull()) if spec.required else joined


def look_up(source: DataFrame, dimension: DataFrame | None, spec: Lookup) -> DataFrame:
    """``source`` with the looked-up key added; a missing dimension gives the unknown member."""
    if dimension is None:
        extra = {new: F.lit(None) for _, new in spec.also}
        blank = F.lit(spec.unknown).cast("long")
        return source.withColumns({**{name: blank for name in (spec.into, *spec.copies)}, **extra})
    rows = current_rows(dimension) if spec.current_only else dimension
    picked = {"_key": spec.key, **{f"_on{i}": pair[1] for i, pair in enumerate(spec.on)}}
    picked |= {f"_also{i}": column for i, (column, _) in enumerate(spec.also)}
    if spec.effective_at is not None:
        picked |= {"_from": "EffectiveStartTime", "_to": "EffectiveEndTime"}
    side = rows.select(*[F.col(column).alias(name) for name, column in picked.items()])
    if spec.effective_at is not None:
        joined = _in_range(source, dimension, side, spec)
    else:
        tests = [
            _equal(source, mine, dimension, theirs, f"_on{i}", spec.fold_case)
            for i, (mine, theirs) in enumerate(spec.on)
        ]
        joined = source.join(side, reduce(and_, tests), "inner" if spec.required else "left")
    return joined.select(
        *source.columns,
        *[known_or_default(F.col("_key"), spec.unknown).alias(name) for name in (spec.into, *spec.copies)],
        *[F.col(f"_also{i}").alias(new) for i, (_, new) in enumerate(spec.also)],
    )


def resolve(source: DataFrame, specs: Iterable[Lookup],
            tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Apply a chain of lookups; a table that is not supplied resolves to the unknown member."""
    specs = list(specs)
    if not specs:
        raise ValueError("no lookups given; pass the source on unchanged instead")
    return reduce(lambda df, spec: look_up(df, tables.get(spec.table), spec), specs, source)


def with_next_day(calendar: DataFrame) -> DataFrame:
    """Calendar with the following row's date and key.

    The one window without a partition: a calendar holds one row per day, so the
    range of the date type bounds it.
    """
    order = Window.orderBy("Date")
    return calendar.withColumns({
        "NextDate": F.lead("Date", 1).over(order),
        "NextDateKey": F.lead("DateKey", 1).over(order),
    })


def with_date_and_time_keys(source: DataFrame, calendar: DataFrame, time_of_day: DataFrame,
                            ts: str, date_into: str, time_into: str,
                            unknown: int | None = None) -> DataFrame:
    """Date key from the date part of ``ts``, time key from its clock part, fraction included."""
    parts = source.withColumns({
        "_day": F.to_date(F.col(ts)), "_clock": clock.exact_clock_text(F.col(ts)),
    })
    specs = [
        Lookup("Date", "DateKey", date_into, (("_day", "Date"),), unknown=unknown),
        Lookup("Time", "TimeKey", time_into, (("_clock", "Time24Hr"),), unknown=unknown),
    ]
    return resolve(parts, specs, {"Date": calendar, "Time": time_of_day}).drop("_day", "_clock")


def with_location(source: DataFrame, location: DataFrame, column: str, lookup_column: str,
                  level: str, into: str = "LocationKey", effective_at: str | None = None) -> DataFrame:
    """Location key at plant or element grain, with the plant's key and mine as helper columns.

    At element grain the element's row gives ``into`` and its ``Plant`` name leads to
    the plant row; at plant grain one row gives both.
    """
    plant_columns = (("LocationKey", "_plant_key"), ("MineID", "_mine"))
    if level == "Plant":
        spec = Lookup("Location", "LocationKey", into, ((column, lookup_column),),
                      effective_at=effective_at, also=plant_columns)
        return look_up(source, location, spec)
    if level != "Element":
        raise ValueError(f"location level must be Plant or Element, not {level!r}")
    element = Lookup("Location", "LocationKey", into, ((column, lookup_column),),
                     effective_at=effective_at, also=(("Plant", "_plant"),))
    plant = Lookup("Location", "LocationKey", "_plant_key", (("_plant", "Name"),), unknown=None,
                   also=(("MineID", "_mine"),))
    return resolve(source, [element, plant], {"Location": location}).drop("_plant")


def common_lookups(rows: Iterable[Mapping[str, str]], stage_table: str,
                   keys: Mapping[str, str]) -> list[Lookup]:
    """Specs from rows of the simple lookup-metadata table, one join per lookup table.

    ``keys`` names each dimension's surrogate key; a dimension it lacks is left out.
    Misses stay NULL.
    """
    pairs: dict[str, list[tuple[str, str]]] = {}
    for row in rows:
        if row["StgTableName"] == stage_table and row["LookupTableName"] in keys:
            pair = (row["StgColumnName"], row["LookupColumnName"])
            pairs.setdefault(row["LookupTableName"], []).append(pair)
    return [
        Lookup(table, keys[table], keys[table], tuple(on), unknown=None)
        for table, on in pairs.items()
    ]


def _grouped(rows: Iterable[Mapping[str, str]], into: str) -> list[tuple[Mapping[str, str], list, list]]:
    """Rows of one lookup table under one alias are one join: all their column pairs must agree, and
    each of their target columns gets the key."""
    groups: dict[tuple, tuple[Mapping[str, str], list, list]] = {}
    for row in rows:
        name = (row.get("LookupSchemaName"), row["LookupTableName"], row["LookupTableAliasName"])
        _, pairs, targets = groups.setdefault(name, (row, [], []))
        pairs.extend(p for p in column_pairs(row["StgColumnName"], row["LookupColumnName"]) if p not in pairs)
        if row[into] and row[into] not in targets:
            targets.append(row[into])
    return list(groups.values())


def column_pairs(stage_columns: str, lookup_columns: str) -> list[tuple[str, str]]:
    """Pair two comma-separated column lists by position."""
    left = [c.strip() for c in stage_columns.split(",")]
    right = [c.strip() for c in lookup_columns.split(",")]
    return list(zip(left, right, strict=True))


def dimension_rows(rows: Iterable[Mapping[str, str]], table: str, schema: str | None = None) -> list[Mapping[str, str]]:
    """The metadata rows of one dimension; without a schema, of that name in any."""
    return [r for r in rows if r["DimTableName"] == table and (schema is None or r["DimSchemaName"] == schema)]


def dimension_lookups(rows: Iterable[Mapping[str, str]], table: str, keys: Mapping[str, str],
                      schema: str | None = None) -> list[Lookup]:
    """Specs from dimension lookup metadata; ``LookupIsSCD`` means current rows only."""
    mine = [r for r in dimension_rows(rows, table, schema) if r["LookupTableName"]]
    return [
        Lookup(r["LookupTableName"], keys.get(r["LookupTableName"], ""), into[0], tuple(pairs),
               current_only=r["LookupIsSCD"] == "Yes", copies=tuple(into[1:]))
        for r, pairs, into in _grouped(mine, "DimColumnName")
    ]


# Lookup tables that the fact loader resolves by rules of their own.
SHIFT_TABLES = ("Location", "CrewShiftMapping", "Shift", "Crew")


def fact_lookups(rows: Iterable[Mapping[str, str]], table: str,
                 keys: Mapping[str, str]) -> list[Lookup]:
    """Specs from fact lookup metadata; ``LookupIsSCD`` means effective-dated by ``SCDDateField``."""
    mine = [
        r for r in rows if r["FactTableName"] == table and r["LookupTableName"] not in SHIFT_TABLES
    ]
    specs = []
    for r, pairs, into in _grouped(mine, "FactColumnName"):
        at = r["SCDDateField"] if r["LookupIsSCD"] == "Yes" else None
        spec = Lookup(r["LookupTableName"], keys.get(r["LookupTableName"], ""), into[0],
                      tuple(pairs), effective_at=at, copies=tuple(into[1:]))
        specs.append(spec)
    return specs


def without_default(specs: Iterable[Lookup]) -> list[Lookup]:
    return [replace(spec, unknown=None) for spec in specs]


def describe(specs: DataFrame, group: list[str], column: str, into: str) -> DataFrame:
    """One comma-separated text per group, items distinct and in order."""
    listed = F.array_join(F.array_sort(F.collect_set(column)), ",")
    return specs.groupBy(*group).agg(listed.alias(into))


def distinct_rows(df: DataFrame) -> DataFrame:
    """One row of each set that differs in the case of texts alone, in the smallest spelling."""
    texts = {c for c, kind in df.dtypes if kind == "string"}
    keys = [(text.fold(F.col(c)) if c in texts else F.col(c)).alias(f"_d{i}") for i, c in enumerate(df.columns)]
    if not texts:
        return df.distinct()
    shown = df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in df.columns if c in texts])
    return shown.select(*[F.col(c if c in texts else f"_d{i}").alias(c) for i, c in enumerate(df.columns)])


def first_rows(df: DataFrame, order: list[Column], count: int) -> DataFrame:
    """The first ``count`` rows in order; each task keeps only its own first rows."""
    return df.orderBy(*order).limit(count)
