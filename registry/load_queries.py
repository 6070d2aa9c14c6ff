"""Complete loads of dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shiftloom.operators import hierarchy
from shiftloom.operators.lookups import fact_lookups
from shiftloom.operators.merge import MergeResult, VersionRules
from shiftloom.operators.partitioned import Partitions
from shiftloom.plans import dimensions, facts, metadata, people, units
from shiftloom.plans.dimensions import ENVIRONMENT, OPS_MEASURE, Options
from shiftloom.sources import tables

from . import merge_sql as sql
from .base import AS_OF, NOW, query, shown
from .inputs import INPUTS, ORACLE_ONLY, Inputs
from .lookup_queries import (
    SALES_LOOKUPS, sales_tables, shift_case, shift_joins, shift_tables,
)

ANY = Options(change="any", null_safe=True, undelete=True)
FIRST = "TIMESTAMP '1963-01-01 00:00:00'"


def _state(result: MergeResult) -> DataFrame:
    return shown(result.state)


# --- units ------------------------------------------------------------------------------------
ORACLE_ONLY["mapped_units"] = """
SELECT min(name) AS UomName FROM (
  SELECT coalesce(m.UomName, a.UomName) AS name FROM {attribute_stage} a
  LEFT JOIN {unit_mapping} m ON lower(a.UomName) = lower(m.PIUOMName)) x GROUP BY lower(name)"""


def unit_names_sql(third_on: str) -> str:
    return f"""
SELECT u.UOMID AS UnitOfMeasureID, coalesce(u.UomName, p.UomName, f.UomName) AS UnitOfMeasureName
FROM {{unit_stage}} u FULL OUTER JOIN {{mapped_units}} p ON lower(u.UomName) = lower(p.UomName)
FULL OUTER JOIN (SELECT min(UnitOfMeasure) AS UomName FROM {{forecast_unit_stage}}
                 WHERE UnitOfMeasure IS NOT NULL AND UnitOfMeasure NOT ILIKE '%blank%'
                 GROUP BY lower(UnitOfMeasure)) f ON lower({third_on}) = lower(f.UomName)"""


def _unit_inputs(i: Inputs) -> list[DataFrame]:
    return [i["unit_stage"], i["attribute_stage"], i["unit_mapping"], i["forecast_unit_stage"]]


@query(unit_names_sql("u.UomName"))
def unit_names(i: Inputs) -> DataFrame:
    """Unit names of three sources, outer-joined."""
    return units.unit_names(*_unit_inputs(i))


@query(unit_names_sql("coalesce(u.UomName, p.UomName)"))
def unit_names_either(i: Inputs) -> DataFrame:
    """The same with the third source meeting both others."""
    return units.unit_names(*_unit_inputs(i), either_name=True)


@query(sql.upsert("{unit_target}", unit_names_sql("u.UomName"), ["UnitOfMeasureName"],
                  ["UnitOfMeasureID", "UnitOfMeasureName"], ["UnitOfMeasureID"],
                  surrogate="UnitOfMeasureKey", digest_columns=["UnitOfMeasureID", "UnitOfMeasureName"],
                  text_key=True, one_row="one"))
def load_units(i: Inputs) -> DataFrame:
    """Unit-of-measure dimension."""
    return _state(units.load_units(i["unit_target"], *_unit_inputs(i), AS_OF))


UNIT_KEYS = """(SELECT u.UnitOfMeasureKey, coalesce(m.PIUOMName, u.UnitOfMeasureName) AS UomName
   FROM {unit_target} u LEFT JOIN {unit_mapping} m ON lower(u.UnitOfMeasureName) = lower(m.UomName))"""
ATTRIBUTE_SOURCE = f"""
SELECT a.ID AS AttributeID, coalesce(u.UnitOfMeasureKey, -1) AS UnitOfMeasureKey, a.EnumerationSetName,
       a.IsConfigurationItem, a.IsHidden, a.IsManualDataEntry, a.Level, a.Name, a.Path, a.TraitType
FROM {{attribute_stage}} a LEFT JOIN {UNIT_KEYS} u ON lower(a.UomName) = lower(u.UomName)"""


@query(ATTRIBUTE_SOURCE)
def attribute_units(i: Inputs) -> DataFrame:
    """Attributes with the key of their unit, found through the name mapping."""
    return dimensions.attribute_source(i["attribute_stage"], i["unit_target"], i["unit_mapping"])


# --- attributes -------------------------------------------------------------------------------
ATTRIBUTE_TEXTS = ("EnumerationSetName", "Name", "Path", "TraitType")


def attribute_sql(**how: object) -> str:
    tracked = list(dimensions.ATTRIBUTE_HISTORY.tracked)
    return sql.history("{attribute_target}", ATTRIBUTE_SOURCE, "AttributeID", [*tracked, "ElementKey"],
                       tracked, "AttributeKey", first_start=FIRST, constants={"ElementKey": "-1"},
                       texts=ATTRIBUTE_TEXTS, text_key=True, **how)


def _attributes(i: Inputs, options: Options) -> DataFrame:
    return _state(dimensions.load_attributes(
        i["attribute_target"], i["attribute_stage"], i["unit_target"], i["unit_mapping"], AS_OF, options
    ))


@query(attribute_sql())
def load_attributes(i: Inputs) -> DataFrame:
    """Attribute dimension."""
    return _attributes(i, dimensions.STRICT)


@query(attribute_sql(mode="any", null_safe=True, undelete=True))
def load_attributes_any(i: Inputs) -> DataFrame:
    """Attribute dimension, versions on any change."""
    return _attributes(i, ANY)


# --- hierarchies ------------------------------------------------------------------------------
REASON_PARENTS = """
SELECT c.ReasonID, c.ReasonCode, c.ReasonHierarchy, c.ReasonName, c.OeeCategory,
       p.ReasonID AS ReasonParentID,
       CAST(length(c.ReasonPath) - length(replace(c.ReasonPath, chr(92), '')) + 1 AS INT) AS Level
FROM {reason_stage} c LEFT JOIN {reason_stage} p ON lower(c.ReasonCodeParent) = lower(p.ReasonCode)
  AND lower(c.ReasonHierarchy) = lower(p.ReasonHierarchy)"""
ORACLE_ONLY["reason_parent_rows"] = REASON_PARENTS
INPUTS["reason_stage_one_tree"] = """
SELECT ReasonID, ReasonCode, ReasonCodeParent, lower(ReasonHierarchy) AS ReasonHierarchy, ReasonName,
       OeeCategory, ReasonPath
FROM {reason_stage}"""


@query(REASON_PARENTS)
def reason_parents(i: Inputs) -> DataFrame:
    """Reasons with path depth and parent."""
    return hierarchy.with_parent_id(i["reason_stage"])


SLOTS = [f"Level{n}Name" for n in range(1, 11)]
# Every row walks up to its root; what it meets on the way is then placed by level.
ORACLE_ONLY["flat_reasons"] = f"""
SELECT r.ReasonID, r.ReasonHierarchy, r.ReasonName, r.ReasonParentID, r.OeeCategory,
       {", ".join(f"w.L[{n}] AS Level{n}Name" for n in range(1, 11))}, r.Level
FROM {{reason_parent_rows}} r JOIN (
  WITH RECURSIVE walk AS (
    SELECT ReasonID AS Leaf, ReasonParentID AS Up, Level, ReasonName AS Name, [ReasonID] AS Met
    FROM {{reason_parent_rows}}
    UNION ALL
    SELECT k.Leaf, a.ReasonParentID, a.Level, a.ReasonName, list_append(k.Met, a.ReasonID)
    FROM walk k, {{reason_parent_rows}} a
    WHERE k.Level <> 1 AND a.ReasonID = k.Up AND NOT list_contains(k.Met, a.ReasonID))
  SELECT Leaf, [{", ".join(f"arg_min(Name, len(Met)) FILTER (Level = {n})" for n in range(1, 11))}] AS L
  FROM walk GROUP BY Leaf HAVING bool_or(Level = 1)) w ON w.Leaf = r.ReasonID"""


@query("SELECT * FROM {flat_reasons}")
def reasons_flattened(i: Inputs) -> DataFrame:
    """Reasons with the names of all their levels."""
    return dimensions.flat_reasons(i["reason_stage"])


REASON_COLUMNS = ["ReasonHierarchy", "ReasonName", "ReasonParentKey", "OeeCategory", *SLOTS, "Level"]
REASON_SOURCE = """
SELECT f.* EXCLUDE (ReasonParentID),
       (SELECT any_value(d.ReasonKey) FROM {reason_target} d
        WHERE d.ReasonID = f.ReasonParentID AND d.IsCurrent = 1) AS ReasonParentKey
FROM {flat_reasons} f"""


def reason_sql(**how: object) -> str:
    texts = ("ReasonHierarchy", "ReasonName", "OeeCategory", *SLOTS)
    return sql.history("{reason_target}", REASON_SOURCE, "ReasonID", REASON_COLUMNS, REASON_COLUMNS,
                       "ReasonKey", first_start=FIRST, texts=texts, parent="ReasonParentKey",
                       links="{flat_reasons}", parent_id="ReasonParentID", **how)


@query(reason_sql())
def load_reasons(i: Inputs) -> DataFrame:
    """Reason dimension."""
    return _state(dimensions.load_reasons(i["reason_target"], i["reason_stage"], AS_OF))


@query(reason_sql(mode="any", null_safe=True, undelete=True))
def load_reasons_any(i: Inputs) -> DataFrame:
    """Reason dimension, versions on any change."""
    return _state(dimensions.load_reasons(i["reason_target"], i["reason_stage"], AS_OF, ANY))


def measure_sql(name: str, stage: str, target: str, levels: dict[str, tuple[int, tuple[str, ...]]]) -> str:
    picks = [
        f"CASE WHEN lower(Level{n}Type) IN ({', '.join(repr(t.lower()) for t in types)}) THEN Level{n}Name END AS {into}"
        for into, (n, types) in levels.items()
    ]
    return f"""
SELECT {name}ID, {name}Type, {name}Name,
       (SELECT any_value(d.{name}Key) FROM {target} d
        WHERE d.{name}ID = s.{name}ParentID AND d.IsCurrent = 1) AS {name}ParentKey,
       Level, {', '.join(picks)}, CASE WHEN lower({name}Type) = 'measure' THEN {name}Name END AS Measure
FROM {stage} s"""


ENVIRONMENT_SQL = measure_sql("Environment", "{environment_stage}", "{environment_target}", ENVIRONMENT.levels)
OPS_SQL = measure_sql("OpsMeasure", "{ops_stage}", "{ops_target}", OPS_MEASURE.levels)


@query(ENVIRONMENT_SQL)
def environment_levels(i: Inputs) -> DataFrame:
    """Environment measures with level columns and parent keys."""
    return dimensions.measure_source(i["environment_stage"], i["environment_target"], ENVIRONMENT)


@query(OPS_SQL)
def ops_measure_levels(i: Inputs) -> DataFrame:
    """Operations measures with level columns and parent keys."""
    return dimensions.measure_source(i["ops_stage"], i["ops_target"], OPS_MEASURE)


def tree_sql(name: str, stage: str, target: str, source: str, levels: list[str], **how: object) -> str:
    columns = [f"{name}Type", f"{name}Name", f"{name}ParentKey", "Level", *levels, "Measure"]
    texts = (f"{name}Type", f"{name}Name", *levels, "Measure")
    return sql.history(target, source, f"{name}ID", columns, columns, f"{name}Key", texts=texts,
                       parent=f"{name}ParentKey", links=stage, parent_id=f"{name}ParentID", **how)


@query(tree_sql("Environment", "{environment_stage}", "{environment_target}", ENVIRONMENT_SQL,
                list(ENVIRONMENT.levels)))
def load_environment(i: Inputs) -> DataFrame:
    """Environment dimension."""
    return _state(dimensions.load_measures(
        i["environment_target"], i["environment_stage"], ENVIRONMENT, AS_OF))


@query(tree_sql("OpsMeasure", "{ops_stage}", "{ops_target}", OPS_SQL, list(OPS_MEASURE.levels)))
def load_ops_measures(i: Inputs) -> DataFrame:
    """Operations-measure dimension."""
    return _state(dimensions.load_measures(i["ops_target"], i["ops_stage"], OPS_MEASURE, AS_OF))


# --- people -----------------------------------------------------------------------------------
PERSON_COLUMNS = people.COLUMNS
# An operator's records are compared as one sort key; all with the best key are taken.
BEST = """
WITH records AS (
  SELECT d.OperatorID, d.FirstName, d.LastName, if(d.IsActive = 1, 'ACTIVE', 'INACTIVE') AS Status,
         d.DateAdded, h.* EXCLUDE (FirstName, LastName, Status)
  FROM {operator_stage} d LEFT JOIN {person_stage} h
    ON lower(concat_ws(chr(9), d.FirstName, d.LastName)) = lower(concat_ws(chr(9), h.FirstName, h.LastName))
), best AS (
  SELECT lower(OperatorID) AS id, first({'s': Status, 'd': DateAdded, 'u': PersonUID}
         ORDER BY Status, DateAdded NULLS FIRST, PersonUID DESC NULLS LAST) AS top
  FROM records GROUP BY 1
)
SELECT PersonUID, PersonID, OperatorID, CAST(NULL AS VARCHAR) AS OISOperatorAlias, FirstName, LastName,
       DisplayName, Department, Title, Supervisor, Status
FROM records JOIN best ON lower(OperatorID) = id
WHERE {'s': Status, 'd': DateAdded, 'u': PersonUID} IS NOT DISTINCT FROM top"""
# Aliases with a person, then those without.
ALIASED = """
SELECT * FROM (
  WITH named AS (
    SELECT Operator AS OISOperatorAlias, regexp_replace(Operator, '^[^\\\\]*\\\\', '') AS id FROM {alias_stage}
  )
  SELECT h.PersonUID, n.id AS PersonID, CAST(NULL AS VARCHAR) AS OperatorID, n.OISOperatorAlias, h.FirstName,
         h.LastName, h.DisplayName, h.Department, h.Title, h.Supervisor, ifnull(h.Status, 'ACTIVE') AS Status
  FROM named n, {person_stage} h WHERE lower(h.PersonID) = lower(n.id)
  UNION ALL
  SELECT NULL, id, NULL, OISOperatorAlias, NULL, NULL, NULL, NULL, NULL, NULL, 'ACTIVE'
  FROM named n ANTI JOIN {person_stage} h ON lower(h.PersonID) = lower(n.id)) a"""


@query(BEST)
def operator_best_records(i: Inputs) -> DataFrame:
    """Each operator's best record."""
    return people.best_records(i["operator_stage"], i["person_stage"])


@query(ALIASED)
def operator_aliases(i: Inputs) -> DataFrame:
    """Persons behind aliases."""
    return people.aliased_persons(i["alias_stage"], i["person_stage"])


BOTH = (f"SELECT {', '.join(f'min({c}) AS {c}' for c in PERSON_COLUMNS)} "
        f"FROM (SELECT * FROM ({BEST}) b UNION ALL SELECT * FROM ({ALIASED}) a) u "
        f"GROUP BY {', '.join(f'lower({c})' for c in PERSON_COLUMNS)}")


@query(BOTH)
def operator_union(i: Inputs) -> DataFrame:
    """Both sources, copies merged."""
    return people.operator_source(i["operator_stage"], i["person_stage"], i["alias_stage"])


def operator_sql(null_safe: bool) -> str:
    return sql.upsert("{operator_target}", f"SELECT {', '.join(PERSON_COLUMNS)} FROM ({BOTH}) u",
                      ["FirstName", "LastName"], PERSON_COLUMNS, list(people.UPDATED), one_row="one",
                      null_safe_keys=null_safe, text_key=True, texts=people.UPDATED)


def _operators(i: Inputs, null_safe: bool) -> DataFrame:
    return _state(people.load_operators(
        i["operator_target"], i["operator_stage"], i["person_stage"], i["alias_stage"], AS_OF,
        null_safe_keys=null_safe, duplicates="first"))


@query(operator_sql(False))
def load_operators(i: Inputs) -> DataFrame:
    """Operator dimension; of several rows for one person the first counts."""
    return _operators(i, False)


@query(operator_sql(True))
def load_operators_null_safe(i: Inputs) -> DataFrame:
    """The same with nameless people matching each other."""
    return _operators(i, True)


# --- generic dimension ------------------------------------------------------------------------
def _detail_row(schema: str, history: str) -> dict[str, str]:
    return {
        "DimSchemaName": schema, "DimTableName": "Customer", "DimColumnName": "NationKey",
        "DimNaturalKeys": "CustomerID", "DimIsSCD": history, "StgColumnName": "NationID", "LookupSchemaName": "dim",
        "LookupTableName": "Nation", "LookupTableAliasName": "n", "LookupColumnName": "NationID", "LookupIsSCD": "Yes",
    }


# Two dimensions of one name in two schemas.
DETAIL_ROWS = [_detail_row("dim", "No"), _detail_row("hist", "Yes")]
DETAIL_KEYS = {"Nation": "NationKey", "Customer": "CustomerKey"}
DETAIL_SOURCE = """
SELECT s.CustomerID, s.Name, coalesce(n.NationKey, -1) AS NationKey, s.Segment
FROM {customer_detail} s LEFT JOIN {nation_dim} n ON s.NationID = n.NationID AND n.IsCurrent = 1"""


@query(sql.upsert("{customer_detail_target}", DETAIL_SOURCE, ["CustomerID"],
                  ["CustomerID", "Name", "NationKey", "Segment"], ["Name", "NationKey", "Segment"],
                  mode="always", surrogate="CustomerKey"))
def load_dimension_type1(i: Inputs) -> DataFrame:
    """Any type-1 dimension, lookups driven by metadata rows."""
    return _state(dimensions.load_dimension_by_metadata(
        i["customer_detail_target"], i["customer_detail"], DETAIL_ROWS, "dim", "Customer", DETAIL_KEYS,
        {"Nation": i["nation_dim"]}, AS_OF))


INPUTS["detail_history"] = """
SELECT CustomerKey, CustomerID, Priority AS Name, -1 AS NationKey, Status AS Segment, IsCurrent,
       EffectiveStartTime, EffectiveEndTime, IsDeleted, CreatedDate, ModifiedDate
FROM {customer_history} WHERE Band > 0
UNION ALL
SELECT s_suppkey + 80000000, s_suppkey + 70000000, s_name, -1, 'none', 1,
       CAST('1990-01-01 00:00:00' AS NTZ), CAST('9999-12-31 00:00:00' AS NTZ), 0,
       CAST('1990-01-01 00:00:00' AS NTZ), CAST(NULL AS NTZ) FROM {supplier}"""


@query(sql.history("{detail_history}", DETAIL_SOURCE, "CustomerID", ["Name", "NationKey", "Segment"], [],
                   "CustomerKey", mode="always", only_current=False, stamp_new=True, stamp_deleted=True))
def load_dimension_type2(i: Inputs) -> DataFrame:
    """Any type-2 dimension, described by metadata rows."""
    return _state(dimensions.load_dimension_by_metadata(
        i["detail_history"], i["customer_detail"], DETAIL_ROWS, "hist", "Customer", DETAIL_KEYS,
        {"Nation": i["nation_dim"]}, AS_OF))


# --- facts ------------------------------------------------------------------------------------
SALES_KEY = ("OrderID", "LineNumber")
SALES_COLUMNS = ["PartKey", "SupplierKey", "ShipDateKey", "OrderID", "LineNumber", "Quantity"]
SALES_SOURCE = """
SELECT DISTINCT s.*, coalesce(p.PartKey, -1) AS PartKey, coalesce(u.SupplierKey, -1) AS SupplierKey,
       coalesce(c.DateKey, -1) AS ShipDateKey
FROM {sales_stage} s LEFT JOIN {part_dim} p ON s.PartID = p.PartID
  AND s.ShipTime BETWEEN p.EffectiveStartTime AND p.EffectiveEndTime
LEFT JOIN {supplier_dim} u ON s.SupplierID = u.SupplierID
LEFT JOIN {ship_calendar} c ON s.ShipDay = c.Date"""


@query(f"""
SELECT * REPLACE (CAST(CreatedDate AS VARCHAR) AS CreatedDate, CAST(ModifiedDate AS VARCHAR) AS ModifiedDate)
FROM (SELECT * FROM {{sales_target}}
      UNION ALL
      SELECT {', '.join(SALES_COLUMNS)}, {NOW}, {NOW} FROM ({SALES_SOURCE}) s
      WHERE NOT EXISTS (SELECT 1 FROM {{sales_target}} t
                        WHERE t.OrderID = s.OrderID AND t.LineNumber = s.LineNumber)) f""")
def load_fact_insert(i: Inputs) -> DataFrame:
    """Any insert-only fact."""
    return _state(facts.load_fact(
        i["sales_target"], i["sales_stage"], SALES_LOOKUPS[:3], sales_tables(i), SALES_KEY, AS_OF))


def _stop_row(table: str, column: str | None, stage: str, theirs: str, alias: str | None = None,
              level: str | None = None) -> dict[str, str | None]:
    return {
        "FactTableName": "Stops", "FactColumnName": column, "StgColumnName": stage, "LookupSchemaName": "dim",
        "LookupTableName": table, "LookupTableAliasName": alias or table, "LookupColumnName": theirs,
        "LookupIsSCD": "No", "SCDDateField": None, "LocationLevel": level,
    }


STOP_ROWS = [
    _stop_row("Date", "StopDateKey", "StopDay", "Date"),
    _stop_row("Location", "LocationKey", "ElementID", "ElementID", level="Element"),
    _stop_row("CrewShiftMapping", None, "StopTime", "ShiftStartTime", "Date"),
    _stop_row("CrewShiftMapping", None, "StopDay,MineID", "ProductionDate,MineID", "dayroster"),
    _stop_row("CrewShiftMapping", None, "StopDay,MineID", "ProductionDate,MineID", "nightroster"),
]
STOP_COLUMNS = ["StopID", "LocationKey", "StopDateKey", "ShiftEndDateKey", "ShiftTimeKey", "CrewKey", "Minutes"]


@query(f"""
SELECT * REPLACE (CAST(CreatedDate AS VARCHAR) AS CreatedDate, CAST(ModifiedDate AS VARCHAR) AS ModifiedDate)
FROM (SELECT * FROM {{stops_target}}
      UNION ALL
      SELECT s.StopID, coalesce(l.LocationKey, -1) AS LocationKey, coalesce(c.DateKey, -1) AS StopDateKey,
             {shift_case('s.StopTime')}, s.Minutes, {NOW}, {NOW}
      FROM (SELECT DISTINCT * FROM {{stops_stage}}) s LEFT JOIN {{location}} l ON s.ElementID = l.ElementID
      LEFT JOIN {{location}} p ON lower(l.Plant) = lower(p.Name)
      LEFT JOIN {{event_calendar}} c ON s.StopDay = c.Date
      {shift_joins('s.StopDay', 'p.MineID', 'p.LocationKey')}
      WHERE s.StopID NOT IN (SELECT StopID FROM {{stops_target}})) f""")
def load_fact_shifts(i: Inputs) -> DataFrame:
    """An insert-only fact with location, shift and crew, described by metadata rows."""
    return _state(facts.load_fact_by_metadata(
        i["stops_target"], i["stops_stage"], STOP_ROWS, "Stops", {"Date": "DateKey"}, shift_tables(i), ("StopID",), AS_OF))


@query(f"""
SELECT * REPLACE (CAST(CreatedDate AS VARCHAR) AS CreatedDate, CAST(ModifiedDate AS VARCHAR) AS ModifiedDate)
FROM (SELECT * FROM {{stops_by_day}}
      UNION ALL
      SELECT s.StopID, coalesce(l.LocationKey, -1) AS LocationKey, coalesce(c.DateKey, -1) AS StopDateKey,
             {shift_case('s.StopTime')}, s.Minutes, {NOW}, {NOW}
      FROM (SELECT DISTINCT * FROM {{stops_stage}}) s LEFT JOIN {{location}} l ON s.ElementID = l.ElementID
      LEFT JOIN {{location}} p ON lower(l.Plant) = lower(p.Name)
      LEFT JOIN {{event_calendar}} c ON s.StopDay = c.Date
      {shift_joins('s.StopDay', 'p.MineID', 'p.LocationKey')}
      WHERE NOT EXISTS (SELECT 1 FROM {{stops_by_day}} t
                        WHERE t.StopID = s.StopID AND t.StopDateKey = coalesce(c.DateKey, -1))) f""")
def load_fact_by_day(i: Inputs) -> DataFrame:
    """The same into a stored table partitioned by day, whose key has the day; new rows are appended."""
    path = f"{tables.shared_folder(i.spark)}/facts/{tables.new_name()}"
    tables.append(i["stops_by_day"], path, ("StopDateKey",))
    facts.load_fact_into(
        path, i["stops_stage"], fact_lookups(STOP_ROWS, "Stops", {"Date": "DateKey"}), shift_tables(i), ("StopID", "StopDateKey"),
        AS_OF, Partitions(("StopDateKey",)), facts.location_rule(STOP_ROWS, "Stops"), facts.shift_rule(STOP_ROWS, "Stops"))
    return shown(i.spark.read.parquet(path))


def _place_row(column: str, stage: str, theirs: str) -> dict[str, str | None]:
    return _stop_row("Location", column, stage, theirs) | {"LookupTableAliasName": "both", "FactTableName": "Places", "LookupTableName": "Site"}


@query("""
SELECT s.StopID, coalesce(l.LocationKey, -1) AS PlantKey, coalesce(l.LocationKey, -1) AS MineKey
FROM {stops_stage} s LEFT JOIN {location} l ON lower(s.PlantName) = lower(l.Name) AND lower(s.MineID) = lower(l.MineID)""")
def lookup_two_targets(i: Inputs) -> DataFrame:
    """Two metadata rows under one alias: both conditions hold, and both columns get the key."""
    rows = [_place_row("PlantKey", "PlantName", "Name"), _place_row("MineKey", "MineID", "MineID")]
    specs = fact_lookups(rows, "Places", {"Site": "LocationKey"})
    found = facts.fact_source(i["stops_stage"], specs, {"Site": i["location"]})
    return found.select("StopID", "PlantKey", "MineKey")


INPUTS["status_fact_target"] = """
SELECT CAST(-1 AS BIGINT) AS CustomerKey, CustomerID, StatusCode, Band, StartDate, EndDate, CreatedDate,
       ModifiedDate
FROM {status_versions}"""
STATUS_KEYED = """SELECT DISTINCT s.*, {default} AS CustomerKey FROM {{status_stage}} s
LEFT JOIN {{customer_current}} c ON s.CustomerID = c.CustomerID"""
VERSION = VersionRules("StartDate", "EndDate", "StatusCode")


@query(sql.versions("{status_fact_target}", STATUS_KEYED.format(default="coalesce(c.CustomerKey, -1)")
                    .replace("{{", "{").replace("}}", "}"), "CustomerID", "StatusCode", ["Band", "CustomerKey"]))
def load_fact_versioned(i: Inputs) -> DataFrame:
    """Any versioned fact, lookups driven by metadata rows."""
    rows = [{
        "FactTableName": "Status", "FactColumnName": "CustomerKey", "StgColumnName": "CustomerID",
        "LookupTableName": "Customer", "LookupTableAliasName": "c", "LookupColumnName": "CustomerID",
        "LookupIsSCD": "No", "SCDDateField": None,
    }]
    specs = fact_lookups(rows, "Status", {"Customer": "CustomerKey"})
    return _state(facts.load_fact(
        i["status_fact_target"], i["status_stage"], specs, {"Customer": i["customer_current"]},
        ("CustomerID",), AS_OF, version=VERSION))


@query(sql.versions("{status_fact_target}", STATUS_KEYED.format(default="c.CustomerKey")
                    .replace("{{", "{").replace("}}", "}"), "CustomerID", "StatusCode", ["Band", "CustomerKey"],
                    stamp_new=False))
def load_simple_fact_versioned(i: Inputs) -> DataFrame:
    """The common versioned fact: misses stay NULL."""
    rows = [{"StgTableName": "Status", "StgColumnName": "CustomerID", "LookupTableName": "Customer",
             "LookupColumnName": "CustomerID"}]
    return _state(facts.load_simple_fact(
        i["status_fact_target"], i["status_stage"], rows, "Status", {"Customer": "CustomerKey"},
        {"Customer": i["customer_current"]}, ("CustomerID",), AS_OF, version=VERSION))


# --- forecast, keyed by the metadata that comes with the toolkit ----------------------------------
INPUTS["forecast_stage"] = """
SELECT l_orderkey AS ForecastID, l_linenumber AS LineNumber, l_returnflag AS Channel,
       concat('file ', l_linestatus) AS FileName, l_linestatus AS Version, c_mktsegment AS Segment,
       n_name AS BusinessUnit, CAST(extract(MONTH FROM o_orderdate) AS INT) AS ForecastMonth,
       CAST(extract(YEAR FROM o_orderdate) AS INT) AS ForecastYear, o_orderpriority AS Type,
       o_orderstatus AS ChangedBy, p_brand AS BusinessMetric, p_type AS UnitOfMeasure, l_quantity AS Amount
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
JOIN {nation} ON c_nationkey = n_nationkey JOIN {part} ON l_partkey = p_partkey"""
INPUTS["forecast_detail"] = """
SELECT dense_rank() OVER (PARTITION BY ForecastYear ORDER BY ForecastMonth, Channel, FileName, Version,
                          Segment, BusinessUnit, Type, ChangedBy) + CAST(ForecastYear AS BIGINT) * 10000000
         AS ForecastDetailKey,
       upper(Channel) AS Channel, FileName, Version, lower(Segment) AS Segment, BusinessUnit,
       ForecastMonth, ForecastYear, Type, ChangedBy
FROM (SELECT DISTINCT Channel, FileName, Version, Segment, BusinessUnit, ForecastMonth, ForecastYear, Type,
             ChangedBy FROM {forecast_stage} WHERE ChangedBy <> 'P') d"""
INPUTS["forecast_metric"] = """
SELECT CAST(min(p_partkey) + 7 AS BIGINT) AS BusinessMetricKey, p_brand AS BusinessMetric FROM {part}
WHERE p_brand <> 'Brand#3' GROUP BY p_brand"""
INPUTS["forecast_unit"] = """
SELECT CAST(min(p_partkey) + 9 AS BIGINT) AS UnitOfMeasureKey, p_type AS UnitOfMeasure FROM {part}
GROUP BY p_type"""
INPUTS["forecast_target"] = """
SELECT CAST(NULL AS BIGINT) AS ForecastDetailKey, CAST(NULL AS BIGINT) AS BusinessMetricKey,
       CAST(NULL AS BIGINT) AS UnitOfMeasureKey, l_orderkey AS ForecastID, l_linenumber AS LineNumber,
       l_quantity AS Amount, l_shipdate AS CreatedDate, CAST(NULL AS NTZ) AS ModifiedDate
FROM {lineitem} WHERE l_shipdate < CAST('1998-01-01 00:00:00' AS NTZ)"""
FORECAST_KEYS = {
    "ForecastDetail": "ForecastDetailKey", "BusinessMetric": "BusinessMetricKey",
    "UnitOfMeasure": "UnitOfMeasureKey",
}
DETAIL_ON = " AND ".join(
    f"lower(CAST(s.{c} AS VARCHAR)) = lower(CAST(d.{c} AS VARCHAR))"
    for c in ("Channel", "FileName", "Version", "Segment", "BusinessUnit", "ForecastMonth", "ForecastYear",
              "Type", "ChangedBy")
)


@query(f"""
SELECT * REPLACE (CAST(CreatedDate AS VARCHAR) AS CreatedDate, CAST(ModifiedDate AS VARCHAR) AS ModifiedDate)
FROM (SELECT * FROM {{forecast_target}}
      UNION ALL
      SELECT d.ForecastDetailKey, m.BusinessMetricKey, u.UnitOfMeasureKey, s.ForecastID, s.LineNumber,
             s.Amount, {NOW}, NULL
      FROM {{forecast_stage}} s LEFT JOIN {{forecast_detail}} d ON {DETAIL_ON}
      LEFT JOIN {{forecast_metric}} m ON lower(s.BusinessMetric) = lower(m.BusinessMetric)
      LEFT JOIN {{forecast_unit}} u ON lower(s.UnitOfMeasure) = lower(u.UnitOfMeasure)
      WHERE NOT EXISTS (SELECT 1 FROM {{forecast_target}} t
                        WHERE t.ForecastID = s.ForecastID AND t.LineNumber = s.LineNumber)) f""")
def load_simple_fact(i: Inputs) -> DataFrame:
    """The common insert-only fact, driven by the forecast lookup rows."""
    tables = {"ForecastDetail": i["forecast_detail"], "BusinessMetric": i["forecast_metric"],
              "UnitOfMeasure": i["forecast_unit"]}
    return _state(facts.load_simple_fact(
        i["forecast_target"], i["forecast_stage"], metadata.forecast_lookups(), "Forecast", FORECAST_KEYS,
        tables, ("ForecastID", "LineNumber"), AS_OF))
