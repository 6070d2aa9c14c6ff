"""Lookup metadata that comes with the toolkit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..functions import clock
from ..sources.tables import inline_rows

# Forecast columns and the lookup tables that hold them.
FORECAST_LOOKUPS = [
    ("Channel", "ForecastDetail"),
    ("FileName", "ForecastDetail"),
    ("Version", "ForecastDetail"),
    ("Segment", "ForecastDetail"),
    ("BusinessUnit", "ForecastDetail"),
    ("ForecastMonth", "ForecastDetail"),
    ("ForecastYear", "ForecastDetail"),
    ("Type", "ForecastDetail"),
    ("ChangedBy", "ForecastDetail"),
    ("BusinessMetric", "BusinessMetric"),
    ("UnitOfMeasure", "UnitOfMeasure"),
]


def forecast_lookups(database: str = "") -> list[dict[str, str]]:
    """The forecast fact's lookup rows; every column looks up one of the same name."""
    return [
        {
            "StgTableName": "Forecast", "StgDatabaseName": database, "StgSchemaName": "stage",
            "StgColumnName": column, "LookupTableName": table, "LookupDatabaseName": database,
            "LookupSchemaName": "dim", "LookupColumnName": column,
        }
        for column, table in FORECAST_LOOKUPS
    ]


def forecast_lookup_table(spark: SparkSession, as_of: datetime, database: str = "") -> DataFrame:
    rows = forecast_lookups(database)
    names = list(rows[0])
    table = inline_rows(spark, [tuple(r[n] for n in names) for r in rows],
                        ", ".join(f"{n} string" for n in names))
    now = clock.moment(as_of)
    return table.withColumns({"CreatedDate": now, "ModifiedDate": now})
