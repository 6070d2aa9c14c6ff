"""Unit-of-measure dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text
from ..operators.merge import KeyRules, MergeResult, upsert
from ..sources.tables import settle

UNIT_KEY = KeyRules(
    ("UnitOfMeasureName",), surrogate="UnitOfMeasureKey",
    digest=("UnitOfMeasureID", "UnitOfMeasureName"),
)


def _distinct_names(rows: DataFrame, name: Column, into: str) -> DataFrame:
    """One spelling of each name, case aside."""
    named = rows.select(name.alias(into)).groupBy(text.fold(F.col(into)).alias("_name"))
    return named.agg(F.min(into).alias(into)).drop("_name")


def mapped_names(attributes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Unit names of the attributes, translated where the mapping knows them."""
    sides = mapping.select(F.col("UomName").alias("_mapped"), F.col("PIUOMName").alias("_from"))
    same = text.fold(F.col("UomName")) == text.fold(F.col("_from"))
    joined = attributes.select("UomName").join(sides, same, "left")
    return _distinct_names(joined, F.coalesce("_mapped", "UomName"), "_pi")


def unit_names(units: DataFrame, attributes: DataFrame, mapping: DataFrame, forecast: DataFrame,
               either_name: bool = False) -> DataFrame:
    """Units of three sources joined by name.

    The third source meets the first one's name only, so a name that the first lacks
    appears twice if both others have it; ``either_name`` lets it meet both.
    """
    listed = forecast.where(
        F.col("UnitOfMeasure").isNotNull()
        & ~text.contains_text(F.col("UnitOfMeasure"), text.PLACEHOLDER)
    )
    third = _distinct_names(listed, F.col("UnitOfMeasure"), "_forecast")
    first = units.select("UOMID", F.col("UomName").alias("_unit"))
    second = mapped_names(attributes, mapping)
    both = first.join(second, text.fold(F.col("_unit")) == text.fold(F.col("_pi")), "full_outer")
    anchor = F.coalesce("_unit", "_pi") if either_name else F.col("_unit")
    joined = both.join(third, text.fold(anchor) == text.fold(F.col("_forecast")), "full_outer")
    return joined.select(
        F.col("UOMID").alias("UnitOfMeasureID"),
        F.coalesce("_unit", "_pi", "_forecast").alias("UnitOfMeasureName"),
    )


def load_units(target: DataFrame, units: DataFrame, attributes: DataFrame, mapping: DataFrame,
               forecast: DataFrame, as_of: datetime, either_name: bool = False) -> MergeResult:
    source = settle(unit_names(units, attributes, mapping, forecast, either_name))
    return upsert(target, source, UNIT_KEY, as_of, update=("UnitOfMeasureID",))


def units_by_source_name(units: DataFrame, mapping: DataFrame) -> DataFrame:
    """Unit keys under the names that the attribute source uses."""
    sides = mapping.select(F.col("UomName").alias("_unit"), "PIUOMName")
    same = text.fold(F.col("UnitOfMeasureName")) == text.fold(F.col("_unit"))
    return units.join(sides, same, "left").select(
        "UnitOfMeasureKey", F.coalesce("PIUOMName", "UnitOfMeasureName").alias("UomName")
    )
