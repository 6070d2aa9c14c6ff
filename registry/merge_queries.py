"""Merge operators on customers that change from year to year."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from shiftloom.operators.keys import assign_keys, highest_key
from shiftloom.operators.merge import (
    HistoryRules, KeyRules, MergeResult, VersionRules, history, insert_only, one_row_per_key, upsert,
    versioned,
)
from shiftloom.sources import tables, versions

from . import merge_sql as sql
from .base import AS_OF, query, shown
from .inputs import INPUTS, Inputs

KEY = KeyRules(("CustomerID",), duplicates="unique", surrogate="CustomerKey")
TRACKED = ("Priority", "Status", "Band")
COLUMNS = ["CustomerID", *TRACKED]
STAGE = "SELECT * FROM {customer_stage}"


def _state(result: MergeResult) -> DataFrame:
    return shown(result.state)


@query("""
WITH fresh AS (SELECT * FROM {customer_stage} s WHERE NOT EXISTS
               (SELECT 1 FROM {customer_current} t WHERE t.CustomerID = s.CustomerID))
SELECT CustomerKey, CustomerID, Priority, Status, Band, CAST(CreatedDate AS VARCHAR) AS CreatedDate,
       CAST(ModifiedDate AS VARCHAR) AS ModifiedDate FROM {customer_current}
UNION ALL
SELECT (SELECT max(CustomerKey) FROM {customer_current}) + row_number() OVER (
         ORDER BY """ + sql.digest(["CustomerID"]) + """), CustomerID, Priority, Status, Band,
       '2024-02-01 00:00:00', '2024-02-01 00:00:00' FROM fresh""")
def customer_insert_only(i: Inputs) -> DataFrame:
    """New customers added, known ones untouched."""
    return _state(insert_only(i["customer_current"], i["customer_stage"], KEY, AS_OF))


@query(sql.upsert("{customer_current}", STAGE, ["CustomerID"], COLUMNS, list(TRACKED),
                  surrogate="CustomerKey"))
def customer_upsert(i: Inputs) -> DataFrame:
    """Customers overwritten where any column changed."""
    return _state(upsert(i["customer_current"], i["customer_stage"], KEY, AS_OF, TRACKED))


@query(sql.upsert("{customer_current}", STAGE, ["CustomerID"], COLUMNS, list(TRACKED), mode="always",
                  surrogate="CustomerKey"))
def customer_overwrite(i: Inputs) -> DataFrame:
    """Customers overwritten whether changed or not."""
    return _state(upsert(i["customer_current"], i["customer_stage"], KEY, AS_OF, TRACKED, mode="always"))


def _history(i: Inputs, **how: object) -> MergeResult:
    rules = HistoryRules(tracked=TRACKED, **how)
    return history(i["customer_history"], i["customer_stage"], KEY, rules, AS_OF)


def _history_sql(**how: object) -> str:
    return sql.history("{customer_history}", STAGE, "CustomerID", list(TRACKED), list(TRACKED),
                       "CustomerKey", **how)


@query(_history_sql())
def customer_history_all(i: Inputs) -> DataFrame:
    """New versions where every tracked column changed."""
    return _state(_history(i))


@query(_history_sql(mode="any", null_safe=True, undelete=True, first_start="TIMESTAMP '1963-01-01'"))
def customer_history_any(i: Inputs) -> DataFrame:
    """New versions where any tracked column changed, NULL included."""
    start = date(1963, 1, 1)
    return _state(_history(i, change="any", null_safe=True, undelete=True, first_start=start))


@query(_history_sql(mode="always", only_current=False, stamp_new=True, stamp_deleted=True))
def customer_history_always(i: Inputs) -> DataFrame:
    """Every matched row expires, history included, and yields a new version."""
    how = {"change": "always", "only_current": False, "stamp_new": True, "stamp_deleted": True}
    return _state(_history(i, **how))


FIRES = sql.changed(list(TRACKED), "any")


@query(f"""
SELECT 'UPDATE' AS action, s.CustomerID, s.Priority, s.Status, s.Band
FROM {{customer_history}} t LEFT JOIN {{customer_stage}} s ON t.CustomerID = s.CustomerID
WHERE s.CustomerID IS NULL OR (t.IsCurrent = 1 AND {FIRES})
UNION ALL
SELECT 'INSERT', * FROM {{customer_stage}} s WHERE NOT EXISTS
  (SELECT 1 FROM {{customer_history}} t WHERE t.CustomerID = s.CustomerID)""")
def customer_changes(i: Inputs) -> DataFrame:
    """The change feed of a type-2 merge; rows gone from source come with NULL columns."""
    return _history(i, change="any").changes


VERSION = VersionRules("StartDate", "EndDate", "StatusCode")
VERSION_KEY = KeyRules(("CustomerID",), duplicates="unique")
STATUS_STAGE = "SELECT * FROM {status_stage}"


@query(sql.versions("{status_versions}", STATUS_STAGE, "CustomerID", "StatusCode", ["Band"]))
def status_versions_merge(i: Inputs) -> DataFrame:
    """Status versions closed and opened; vanished customers closed again."""
    return _state(versioned(i["status_versions"], i["status_stage"], VERSION_KEY, VERSION, AS_OF))


@query(sql.versions("{status_versions}", STATUS_STAGE, "CustomerID", "StatusCode", ["Band"],
                    stamp_new=False, only_open=True, reopen=True))
def status_versions_reopened(i: Inputs) -> DataFrame:
    """The same, closed rows left alone and returning customers opened again."""
    how = VersionRules("StartDate", "EndDate", "StatusCode", stamp_new=False, only_open=True, reopen=True)
    return _state(versioned(i["status_versions"], i["status_stage"], VERSION_KEY, how, AS_OF))


@query("""
SELECT (SELECT max(CustomerKey) FROM {customer_current}) + row_number() OVER (
         ORDER BY """ + sql.digest(["CustomerID", "Yr"]) + """) AS ProfileKey, CustomerID, Yr
FROM {order_profile}""")
def surrogate_keys(i: Inputs) -> DataFrame:
    """Dense keys for all orders by customer and year, exact copies included, above the highest key in use."""
    rows = i["order_profile"].select(F.lit(None).cast("bigint").alias("ProfileKey"), "CustomerID", "Yr")
    return assign_keys(rows, "ProfileKey", ["CustomerID", "Yr"], highest_key(i["customer_current"], "CustomerKey"))


@query("""
SELECT CustomerID, Priority, Status, Yr, Copies FROM (
  SELECT *, row_number() OVER (PARTITION BY CustomerID ORDER BY Priority, Status NULLS FIRST, Yr) AS rn,
         count(*) OVER (PARTITION BY CustomerID) AS Copies FROM {order_profile}) p WHERE rn = 1""")
def one_row_per_customer(i: Inputs) -> DataFrame:
    """The guard against several source rows per key, keeping the first and the number of rows."""
    rows = i["order_profile"].select("CustomerID", "Priority", "Status", "Yr")
    guarded = one_row_per_key(rows, KeyRules(("CustomerID",), duplicates="first"))
    return guarded.select("src.*", F.col("_copies").alias("Copies"))


# The value of a version as a text, in spellings that differ by row.
INPUTS["status_text_versions"] = """
SELECT CustomerID, StartDate, EndDate, CASE StatusCode WHEN 1 THEN 'Final' WHEN 2 THEN 'open' END AS Status, Band,
       CreatedDate, ModifiedDate FROM {status_versions}"""
INPUTS["status_text_stage"] = """
SELECT CustomerID, CASE StatusCode WHEN 1 THEN CASE WHEN CustomerID % 2 = 0 THEN 'FINAL' ELSE 'final' END
       WHEN 2 THEN 'OPEN' END AS Status, Band FROM {status_stage}"""


@query(sql.versions("{status_text_versions}", "SELECT * FROM {status_text_stage}", "CustomerID", "Status", ["Band"], text=True))
def status_versions_text(i: Inputs) -> DataFrame:
    """Versions of a text, compared without regard to case."""
    how = VersionRules("StartDate", "EndDate", "Status")
    return _state(versioned(i["status_text_versions"], i["status_text_stage"], VERSION_KEY, how, AS_OF))


INPUTS["customer_partition_target"] = """
SELECT CustomerID, nullif(Yr, 1996) AS Yr, Priority, Status, Band, FromTime AS CreatedDate,
       FromTime AS ModifiedDate
FROM {customer_spans}"""
INPUTS["customer_partition_stage"] = """
SELECT CustomerID, CASE WHEN Band > 2 THEN NULL ELSE Yr END AS Yr, 'corrected' AS Priority, Status, Band
FROM {profile} WHERE Yr >= 1999"""


@query(sql.upsert("{customer_partition_target}", "SELECT * FROM {customer_partition_stage}",
                  ["CustomerID", "Yr"], ["CustomerID", "Yr", *TRACKED], ["Priority"]))
def sink_cycle(i: Inputs) -> DataFrame:
    """A partitioned table written, its touched partitions merged and replaced, the stage cleared, the state
    published over a version with fewer columns and brought back after an empty one."""
    base = f"{tables.shared_folder(i.spark)}/sink-cycle/{tables.new_name()}"
    fact, stage = f"{base}/fact", f"{base}/stage"
    tables.append(i["customer_partition_target"], fact, ("Yr",))
    tables.reload(i["customer_partition_stage"], stage)
    source = tables.read_table(i.spark, stage)
    keys = KeyRules(("CustomerID", "Yr"), duplicates="unique")
    tables.merge_partitions(
        fact, source, ["Yr"], lambda touched: upsert(touched, source, keys, AS_OF, update=("Priority",)).state
    )
    tables.clear(i.spark, stage)
    state = i.spark.read.parquet(fact).unionByName(
        i.spark.read.parquet(stage).select("*", *[F.lit(None).cast("timestamp_ntz").alias(c)
                                                  for c in ("CreatedDate", "ModifiedDate")]))
    table, place = f"published_{tables.new_name()}", f"{base}/published"
    versions.publish_version(state.drop("ModifiedDate", "Priority").limit(1), place, "narrow", None, table)
    versions.publish_version(state, place, "whole", "narrow", table)
    versions.publish_version(state.limit(0), place, "empty", "whole", table)
    versions.roll_back(i.spark, place, "whole", "empty", table)
    return shown(i.spark.table(table))
