"""Operator dimension."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import text
from ..operators.lookups import distinct_rows
from ..operators.merge import KeyRules, MergeResult, upsert
from ..sources.tables import settle

COLUMNS = [
    "PersonUID", "PersonID", "OperatorID", "OISOperatorAlias", "FirstName", "LastName",
    "DisplayName", "Department", "Title", "Supervisor", "Status",
]
NAME_KEY = KeyRules(("FirstName", "LastName"))
UPDATED = tuple(c for c in COLUMNS if c not in NAME_KEY.columns)


def best_records(operators: DataFrame, persons: DataFrame) -> DataFrame:
    """Each operator's best record, ties kept: active first, then oldest, then highest person UID.

    The filter on rank 1 lets Spark drop beaten rows before the shuffle, so a hot
    operator sends one row per task.
    """
    person = persons.select(
        "PersonUID", "PersonID", "DisplayName", "Department", "Title", "Supervisor",
        F.col("FirstName").alias("_first"), F.col("LastName").alias("_last"),
    )
    same = (text.fold(F.col("FirstName")) == text.fold(F.col("_first"))) & (
        text.fold(F.col("LastName")) == text.fold(F.col("_last"))
    )
    rows = operators.join(person, same, "left").withColumn(
        "Status", text.activity_label(F.col("IsActive"))
    )
    order = Window.partitionBy(text.fold(F.col("OperatorID"))).orderBy(
        "Status", "DateAdded", F.col("PersonUID").desc()
    )
    ranked = rows.withColumn("_rank", F.rank().over(order)).where(F.col("_rank") == 1)
    return ranked.withColumn("OISOperatorAlias", F.lit(None).cast("string")).select(*COLUMNS)


def aliased_persons(aliases: DataFrame, persons: DataFrame) -> DataFrame:
    """Persons behind DOMAIN\\id aliases."""
    alias = aliases.select(
        text.after_first(F.col("Operator"), "\\").alias("_id"),
        F.col("Operator").alias("OISOperatorAlias"),
    )
    joined = alias.join(persons, text.fold(F.col("_id")) == text.fold(F.col("PersonID")), "left")
    joined = joined.withColumns({
        "PersonID": F.col("_id"),
        "OperatorID": F.lit(None).cast("string"),
        "Status": F.coalesce("Status", F.lit("ACTIVE")),
    })
    return joined.select(*COLUMNS)


def operator_source(operators: DataFrame, persons: DataFrame, aliases: DataFrame) -> DataFrame:
    ranked = best_records(operators, persons)
    return distinct_rows(ranked.unionByName(aliased_persons(aliases, persons)))


def load_operators(target: DataFrame, operators: DataFrame, persons: DataFrame,
                   aliases: DataFrame, as_of: datetime, null_safe_keys: bool = False,
                   duplicates: str = "raise") -> MergeResult:
    """People matched by name; one without a name matches nobody unless ``null_safe_keys``."""
    rules = replace(NAME_KEY, null_safe=null_safe_keys, duplicates=duplicates)
    source = settle(operator_source(operators, persons, aliases))
    return upsert(target, source, rules, as_of, update=UPDATED)
