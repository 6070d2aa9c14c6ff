"""The registry: a query, the SQL it is checked against, and how results are shown."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from .inputs import Inputs, oracle

AS_OF = datetime(2024, 2, 1)
NOW = "TIMESTAMP '2024-02-01 00:00:00'"
OPEN = "TIMESTAMP '9999-12-31 00:00:00'"


@dataclass(frozen=True)
class Query:
    build: Callable[[Inputs], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None) -> Callable:
    """Register the decorated function under its name with its oracle."""

    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        REGISTRY[build.__name__] = Query(build, None if sql is None else oracle(sql))
        return build

    return register


def run(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: REGISTRY[name].build(Inputs(spark, folder))


def shown(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Chosen columns with timestamps as text and doubles rounded, to compare across engines.

    Engines add in different orders, so an exact tie may round either way; the bit
    added on top of one half keeps values of up to nine digits off the tie.
    """
    kinds = dict(df.dtypes)
    picked = []
    for name in columns or df.columns:
        col = F.col(name)
        if kinds[name].startswith("timestamp"):
            col = col.cast("string")
        elif kinds[name] == "double":
            col = F.floor(col * 10**digits + 0.5003) / 10**digits
        picked.append(col.alias(name))
    return df.select(*picked)


def rounded(column: str, digits: int = 6) -> str:
    """The oracle's side of the rounding in ``shown``."""
    return f"floor({column} * {10**digits} + 0.5003) / {10**digits}"
