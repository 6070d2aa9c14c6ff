"""Stage tables, targets and dimensions derived from the test tables.

Each is one SQL text that both engines understand, so a query and its oracle start
from the same rows. ``{name}`` stands for a test table or another input, ``NTZ`` for
the engine's zone-free timestamp type. All are derived from whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from shiftloom.sources.tables import new_name, shared_folder

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

INPUTS: dict[str, str] = {}

# --- versions of each kind of event: thousands a key, some of them overlapping ----------------
INPUTS["kind_versions"] = """
SELECT event_id AS VersionKey, event_type AS Kind, CAST(ts AS NTZ) AS EffectiveStartTime,
       coalesce(CAST(CASE WHEN event_id % 10 = 0 THEN lead(ts, 3) OVER (PARTITION BY event_type ORDER BY ts, event_id)
                ELSE lead(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) END AS NTZ),
                CAST('9999-12-31 00:00:00' AS NTZ)) AS EffectiveEndTime
FROM {events}"""
INPUTS["kind_readings"] = """
SELECT event_id AS EventID, upper(event_type) AS Kind, value AS Value,
       CASE WHEN event_id % 13 <> 0 THEN CAST(ts AS NTZ) END AS ReadTime
FROM {events}"""

# --- customers by year of order: a slowly changing dimension --------------------------------
INPUTS["profile"] = """
SELECT CustomerID, Yr, Priority, Status, Band FROM (
  SELECT o_custkey AS CustomerID, CAST(extract(YEAR FROM o_orderdate) AS INT) AS Yr,
         o_orderpriority AS Priority, nullif(o_orderstatus, 'P') AS Status,
         CAST(floor(o_totalprice / 100000) AS INT) AS Band,
         row_number() OVER (PARTITION BY o_custkey, extract(YEAR FROM o_orderdate)
                            ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM {orders}) t
WHERE rn = 1"""
INPUTS["order_profile"] = """
SELECT o_custkey AS CustomerID, CAST(extract(YEAR FROM o_orderdate) AS INT) AS Yr,
       o_orderpriority AS Priority, nullif(o_orderstatus, 'P') AS Status
FROM {orders}"""
INPUTS["customer_stage"] = """
SELECT CustomerID, Priority, Status, Band FROM (
  SELECT *, row_number() OVER (PARTITION BY CustomerID ORDER BY Yr DESC) AS rn
  FROM {profile} WHERE Yr >= 2000) t
WHERE rn = 1"""
INPUTS["customer_spans"] = """
SELECT CustomerID, Yr, Priority, Status, Band,
       CAST(make_date(Yr, 1, 1) AS NTZ) AS FromTime,
       CAST(make_date(lead(Yr) OVER (PARTITION BY CustomerID ORDER BY Yr), 1, 1) AS NTZ) AS ToTime
FROM {profile} WHERE Yr < 2000"""
INPUTS["customer_history"] = """
SELECT CustomerID * 10 + Yr - 1994 AS CustomerKey, CustomerID, Priority, Status, Band,
       CASE WHEN ToTime IS NULL THEN 1 ELSE 0 END AS IsCurrent,
       FromTime AS EffectiveStartTime,
       coalesce(ToTime, CAST('9999-12-31 00:00:00' AS NTZ)) AS EffectiveEndTime,
       0 AS IsDeleted, FromTime AS CreatedDate, ToTime AS ModifiedDate
FROM {customer_spans}"""
INPUTS["customer_current"] = """
SELECT CustomerID * 10 + Yr - 1994 AS CustomerKey, CustomerID, Priority, Status, Band,
       FromTime AS CreatedDate, FromTime AS ModifiedDate
FROM {customer_spans} WHERE ToTime IS NULL"""
INPUTS["status_versions"] = """
SELECT CustomerID, FromTime AS StartDate,
       CASE WHEN ToTime IS NULL AND Band = 0 THEN CAST(make_date(Yr + 1, 1, 1) AS NTZ)
            ELSE ToTime END AS EndDate,
       CASE Status WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS StatusCode, Band,
       FromTime AS CreatedDate, CAST(NULL AS NTZ) AS ModifiedDate
FROM {customer_spans}"""
INPUTS["status_stage"] = """
SELECT CustomerID, CASE Status WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS StatusCode, Band
FROM {customer_stage}"""
INPUTS["customer_detail"] = """
SELECT c_custkey AS CustomerID, upper(c_name) AS Name, c_nationkey AS NationID,
       c_mktsegment AS Segment
FROM {customer}"""
INPUTS["customer_detail_target"] = """
SELECT CustomerID * 3 + 1 AS CustomerKey, CustomerID, Priority AS Name, -1 AS NationKey,
       Status AS Segment, FromTime AS CreatedDate, FromTime AS ModifiedDate
FROM {customer_spans} WHERE ToTime IS NULL AND Band > 0"""
INPUTS["nation_dim"] = """
SELECT n_nationkey + 100 AS NationKey, n_nationkey AS NationID, n_name AS NationName,
       CASE WHEN n_regionkey = 3 THEN 0 ELSE 1 END AS IsCurrent
FROM {nation}"""

# --- line items and the dimensions they look up ---------------------------------------------
INPUTS["part_dim"] = """
SELECT p_partkey * 2 + 1 AS PartKey, p_partkey AS PartID, upper(p_brand) AS Brand, p_size AS Size,
       CAST('1990-01-01 00:00:00' AS NTZ) AS EffectiveStartTime,
       CAST('1998-06-30 23:59:59' AS NTZ) AS EffectiveEndTime, 0 AS IsCurrent
FROM {part} WHERE p_size <= 45
UNION ALL
SELECT p_partkey * 2 + 2, p_partkey, upper(p_brand), p_size,
       CAST('1998-07-01 00:00:00' AS NTZ), CAST('9999-12-31 00:00:00' AS NTZ), 1
FROM {part} WHERE p_size <= 40"""
INPUTS["supplier_dim"] = """
SELECT s_suppkey + 1 AS SupplierKey, s_suppkey AS SupplierID, upper(s_name) AS SupplierName
FROM {supplier} WHERE s_acctbal > 0"""
INPUTS["ship_days"] = """
SELECT CAST(min(l_shipdate) AS DATE) AS FirstDay, CAST(max(l_shipdate) AS DATE) AS LastDay
FROM {lineitem}"""
INPUTS["sales_all"] = """
SELECT l_orderkey AS OrderID, l_linenumber AS LineNumber, l_partkey AS PartID,
       l_suppkey AS SupplierID, l_shipdate AS ShipTime, CAST(l_shipdate AS DATE) AS ShipDay,
       l_quantity AS Quantity, nullif(l_returnflag, 'N') AS ReturnFlag
FROM {lineitem}"""
INPUTS["sales_stage"] = "SELECT * FROM {sales_all} WHERE ShipTime >= CAST('1998-01-01 00:00:00' AS NTZ)"
INPUTS["sales_target"] = """
SELECT CAST(-1 AS BIGINT) AS PartKey, CAST(-1 AS BIGINT) AS SupplierKey, -1 AS ShipDateKey,
       l_orderkey AS OrderID, l_linenumber AS LineNumber, l_quantity AS Quantity,
       l_shipdate AS CreatedDate, l_shipdate AS ModifiedDate
FROM {lineitem} WHERE l_shipdate < CAST('1999-01-01 00:00:00' AS NTZ)"""

# --- sensor readings --------------------------------------------------------------------------
INPUTS["readings"] = """
SELECT concat(CASE WHEN event_id % 7 = 0 THEN 'ea-' ELSE 'EA-' END, CAST(user_id AS STRING)) AS ElementAttributeID,
       ts AS Time,
       concat(CASE WHEN event_id % 5 = 0 THEN 'el-' ELSE 'EL-' END, CAST(user_id AS STRING)) AS ElementID,
       CASE event_type WHEN 'view' THEN CASE WHEN event_id % 3 = 0 THEN 'FEED level' ELSE 'Feed Level' END WHEN 'click' THEN 'Flow Rate'
            WHEN 'purchase' THEN CASE WHEN value > 30 THEN 'Pump Mode' ELSE 'Conditioning pH' END
            ELSE 'Running' END AS Attribute,
       CASE WHEN event_type = 'error' THEN 'Off' WHEN event_type = 'signup' THEN 'ON'
            WHEN value < 0.5 THEN 'Calc Failed' WHEN value < 1 THEN concat(CAST(value AS STRING), 'd')
            WHEN value > 50 THEN NULL ELSE CAST(value AS STRING) END AS Value,
       CASE WHEN event_type IN ('error', 'signup') THEN 'Unit Run Status'
            WHEN event_type = 'click' AND value > 45 THEN NULL ELSE 'Process' END AS CategoryName,
       CAST('2024-01-01 06:00:00' AS NTZ) - INTERVAL 1 HOUR * CAST(event_id % 5 AS INT) AS ShiftStartTime,
       CAST('2024-01-30 18:00:00' AS NTZ) - INTERVAL 1 HOUR * CAST(event_id % 11 AS INT) AS ShiftEndTime
FROM {events}"""
INPUTS["elements"] = """
SELECT DISTINCT e.user_id AS Element, n.n_name AS Nation, r.r_name AS Region
FROM {events} e JOIN {nation} n ON n.n_nationkey = e.user_id % 25
JOIN {region} r ON r.r_regionkey = n.n_regionkey"""
INPUTS["location"] = """
SELECT Element + 1000 AS LocationKey, concat('L-', CAST(Element AS STRING)) AS LocationID,
       CAST(NULL AS STRING) AS MineID, concat('EL-', CAST(Element AS STRING)) AS ElementID,
       lower(Region) AS Plant, concat('Element ', CAST(Element AS STRING)) AS Name,
       CASE WHEN Region = 'ASIA' THEN CAST('2024-01-10 00:00:00' AS NTZ)
            ELSE CAST('2020-01-01 00:00:00' AS NTZ) END AS EffectiveStartTime,
       CAST('9999-12-31 00:00:00' AS NTZ) AS EffectiveEndTime
FROM {elements} WHERE Nation <> 'NATION_7'
UNION ALL
SELECT r_regionkey + 1, concat('P-', r_name), concat('M', CAST(r_regionkey AS STRING)),
       CAST(NULL AS STRING), CAST(NULL AS STRING), r_name,
       CAST('2020-01-01 00:00:00' AS NTZ), CAST('2024-01-20 00:00:00' AS NTZ)
FROM {region} WHERE r_name <> 'EUROPE'"""
INPUTS["attribute_dim"] = """
SELECT user_id * 100 + No * 10 + 1 AS AttributeKey,
       concat('EA-', CAST(user_id AS STRING)) AS AttributeID, upper(Name) AS Name, 0 AS IsCurrent,
       CAST('2024-01-01 00:00:00' AS NTZ) AS EffectiveStartTime,
       CAST('2024-01-15 23:59:59' AS NTZ) AS EffectiveEndTime
FROM {sensor_names}
UNION ALL
SELECT user_id * 100 + No * 10 + 2, concat('EA-', CAST(user_id AS STRING)), upper(Name), 1,
       CAST('2024-01-16 00:00:00' AS NTZ), CAST('9999-12-31 00:00:00' AS NTZ)
FROM {sensor_names}"""
INPUTS["sensor_names"] = """
SELECT DISTINCT user_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS No,
       CASE event_type WHEN 'view' THEN 'Feed Level' WHEN 'click' THEN 'Flow Rate'
            ELSE 'Conditioning pH' END AS Name
FROM {events} WHERE event_type IN ('view', 'click', 'purchase')"""
INPUTS["event_days"] = """
SELECT CAST(min(ts) AS DATE) AS FirstDay, CAST(max(ts) AS DATE) AS LastDay FROM {events}"""
INPUTS["shift_dim"] = """
SELECT CAST(r_regionkey * 2 + 1 AS BIGINT) AS ShiftKey,
       concat('S', CAST(r_regionkey AS STRING)) AS ScheduleID, 1 AS ShiftOrder,
       CAST(r_regionkey + 1 AS BIGINT) AS LocationKey, '06:00:00' AS ShiftStartTime,
       '17:59:59' AS ShiftEndTime, 1 AS IsCurrent
FROM {region}
UNION ALL
SELECT CAST(r_regionkey * 2 + 2 AS BIGINT), concat('S', CAST(r_regionkey AS STRING)), 2,
       CAST(r_regionkey + 1 AS BIGINT), '18:00:00', '05:59:59',
       CASE WHEN r_name = 'AFRICA' THEN 0 ELSE 1 END
FROM {region}"""
INPUTS["crew_dim"] = """
SELECT CAST(r_regionkey + 10 AS BIGINT) AS CrewKey, 'a' AS CrewCode,
       concat('C', CAST(r_regionkey AS STRING)) AS CrewID, 1 AS IsCurrent
FROM {region}
UNION ALL
SELECT CAST(r_regionkey + 20 AS BIGINT), 'B', concat('C', CAST(r_regionkey AS STRING)),
       CASE WHEN r_name = 'AMERICA' THEN 0 ELSE 1 END
FROM {region}"""
INPUTS["roster_days"] = """
SELECT DISTINCT CAST(e.ts AS DATE) AS Day, r.r_regionkey AS RegionKey
FROM {events} e JOIN {nation} n ON n.n_nationkey = e.user_id % 25
JOIN {region} r ON r.r_regionkey = n.n_regionkey
WHERE date_format_weekday(e.ts) <> 'Sunday'"""
INPUTS["roster_stage"] = """
SELECT concat('D', CAST(Day AS STRING)) AS ShiftID, 'Day shift' AS ShiftDescription, 1 AS ShiftOrder,
       concat('C', CAST(RegionKey AS STRING)) AS CrewID, 'A' AS CrewCode,
       concat('s', CAST(RegionKey AS STRING)) AS ScheduleID, Day AS ShiftStartDate,
       Day AS ShiftEndDate, '06:00:00' AS ShiftStartTime, '17:59:59' AS ShiftEndTime,
       Day AS ProductionDate
FROM {roster_days}
UNION ALL
SELECT concat('N', CAST(Day AS STRING)), 'Night shift', 2, concat('C', CAST(RegionKey AS STRING)),
       'B', concat('s', CAST(RegionKey AS STRING)), Day, CAST(Day + INTERVAL 1 DAY AS DATE),
       '18:00:00', '05:59:59', Day
FROM {roster_days}"""
INPUTS["stops_stage"] = """
SELECT event_id AS StopID, CAST(ts AS DATE) AS StopDay, substr(CAST(ts AS STRING), 12, 8) AS StopTime,
       ts AS StopMoment, concat('EL-', CAST(user_id AS STRING)) AS ElementID,
       r.r_name AS PlantName, concat('M', CAST(r.r_regionkey AS STRING)) AS MineID, value AS Minutes
FROM {events} e JOIN {nation} n ON n.n_nationkey = e.user_id % 25
JOIN {region} r ON r.r_regionkey = n.n_regionkey"""
INPUTS["stops_target"] = """
SELECT event_id AS StopID, CAST(-1 AS BIGINT) AS LocationKey, -1 AS StopDateKey,
       -1 AS ShiftEndDateKey, CAST(-1 AS BIGINT) AS ShiftTimeKey, CAST(-1 AS BIGINT) AS CrewKey,
       value AS Minutes, ts AS CreatedDate, ts AS ModifiedDate
FROM {events} WHERE event_type = 'signup'"""

INPUTS["stops_by_day"] = """
SELECT event_id AS StopID, CAST(-1 AS BIGINT) AS LocationKey,
       CAST(extract(YEAR FROM ts) * 10000 + extract(MONTH FROM ts) * 100 + extract(DAY FROM ts) AS INT)
         + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS StopDateKey,
       -1 AS ShiftEndDateKey, CAST(-1 AS BIGINT) AS ShiftTimeKey, CAST(-1 AS BIGINT) AS CrewKey,
       value AS Minutes, ts AS CreatedDate, ts AS ModifiedDate
FROM {events} WHERE event_type = 'signup'"""

# --- hierarchies ------------------------------------------------------------------------------
INPUTS["tree"] = """
SELECT 1000 + r_regionkey AS ID, concat('R', CAST(r_regionkey AS STRING)) AS Code,
       CAST(NULL AS STRING) AS ParentCode, CAST(NULL AS INT) AS ParentID, 1 AS Level, r_name AS Name,
       r_name AS Path, r_name AS L1, CAST(NULL AS STRING) AS L2, CAST(NULL AS STRING) AS L3,
       CAST(NULL AS STRING) AS Segment
FROM {region}
UNION ALL
SELECT 2000 + n_nationkey, concat('N', CAST(n_nationkey AS STRING)),
       concat('r', CAST(n_regionkey AS STRING)), 1000 + n_regionkey, 2, n_name,
       concat(r_name, chr(92), n_name), r_name, n_name, CAST(NULL AS STRING), CAST(NULL AS STRING)
FROM {nation} JOIN {region} ON r_regionkey = n_regionkey
UNION ALL
SELECT CAST(100000 + s_suppkey AS INT), concat('S', CAST(s_suppkey AS STRING)),
       CASE WHEN s_acctbal < 1000 THEN 'lost' ELSE concat('N', CAST(s_nationkey AS STRING)) END,
       CASE WHEN s_acctbal < 1000 THEN 77 ELSE 2000 + s_nationkey END, 3, s_name,
       concat(r_name, chr(92), n_name, chr(92), s_name), r_name, n_name, s_name,
       CAST(NULL AS STRING)
FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey JOIN {region} ON r_regionkey = n_regionkey
UNION ALL
SELECT CAST(10000000 + c_custkey AS INT), concat('C', CAST(c_custkey AS STRING)),
       concat('S', CAST(s_suppkey AS STRING)), CAST(100000 + s_suppkey AS INT), 4, c_name,
       concat(r_name, chr(92), n_name, chr(92), s_name, chr(92), c_name), r_name, n_name, s_name,
       c_mktsegment
FROM {customer} JOIN {first_supplier} ON s_nationkey = c_nationkey
JOIN {nation} ON n_nationkey = c_nationkey JOIN {region} ON r_regionkey = n_regionkey"""
INPUTS["first_supplier"] = """
SELECT f.s_nationkey, f.s_suppkey, s.s_name
FROM (SELECT s_nationkey, min(s_suppkey) AS s_suppkey FROM {supplier} GROUP BY s_nationkey) f
JOIN {supplier} s ON s.s_suppkey = f.s_suppkey"""
INPUTS["reason_stage"] = """
SELECT ID AS ReasonID, Code AS ReasonCode, ParentCode AS ReasonCodeParent,
       CASE WHEN Level = 4 THEN 'PLANT' ELSE 'Plant' END AS ReasonHierarchy, Name AS ReasonName,
       coalesce(Segment, 'Availability') AS OeeCategory, Path AS ReasonPath
FROM {tree}
UNION ALL
SELECT CAST(50000000 + s_suppkey AS INT), concat('D', CAST(s_suppkey AS STRING)),
       CASE WHEN s_suppkey % 50 = 20 THEN concat('d', CAST(s_suppkey + 1 AS STRING))
            WHEN s_suppkey % 13 = 1 THEN concat('N', CAST(s_nationkey AS STRING))
            ELSE concat('D', CAST(s_suppkey - 1 AS STRING)) END,
       'plant', concat('deep ', s_name), 'Availability',
       concat(repeat(concat('x', chr(92)), CAST(CASE WHEN s_nationkey < 12 THEN 2 + s_suppkey % 13
                                                ELSE 2 + s_suppkey % 4 END AS INT)), s_name)
FROM {supplier}"""
INPUTS["reason_target"] = """
SELECT CAST(ID AS BIGINT) * 2 AS ReasonKey, ID AS ReasonID, 'Plant' AS ReasonHierarchy,
       Name AS ReasonName, CAST(CASE WHEN Level = 2 THEN ParentID * 2 END AS BIGINT) AS ReasonParentKey,
       CASE WHEN Level = 3 THEN 'Planned' ELSE coalesce(Segment, 'availability') END AS OeeCategory,
       L1 AS Level1Name, L2 AS Level2Name, L3 AS Level3Name,
       CASE WHEN Level = 4 THEN Name END AS Level4Name, CAST(NULL AS STRING) AS Level5Name,
       CAST(NULL AS STRING) AS Level6Name, CAST(NULL AS STRING) AS Level7Name,
       CAST(NULL AS STRING) AS Level8Name, CAST(NULL AS STRING) AS Level9Name,
       CAST(NULL AS STRING) AS Level10Name, CAST(Level AS INT) AS Level, 1 AS IsCurrent,
       CAST('1963-01-01 00:00:00' AS NTZ) AS EffectiveStartTime,
       CAST('9999-12-31 00:00:00' AS NTZ) AS EffectiveEndTime, 0 AS IsDeleted,
       CAST('2023-01-01 00:00:00' AS NTZ) AS CreatedDate, CAST(NULL AS NTZ) AS ModifiedDate
FROM {tree} WHERE Segment IS NULL OR Segment <> 'MACHINERY'"""
INPUTS["environment_stage"] = """
SELECT ID AS EnvironmentID,
       CASE Level WHEN 1 THEN 'Enterprise' WHEN 2 THEN 'Class' WHEN 3 THEN 'Measure Group'
            ELSE CASE WHEN ID % 3 = 0 THEN 'MEASURE' ELSE 'Measure' END END AS EnvironmentType,
       Name AS EnvironmentName, ParentID AS EnvironmentParentID, CAST(Level AS INT) AS Level,
       'Enterprise' AS Level1Type, L1 AS Level1Name,
       CASE L2 WHEN 'NATION_3' THEN 'Other' WHEN 'NATION_4' THEN 'CLASS' ELSE 'Class' END AS Level2Type, L2 AS Level2Name,
       'Measure Group' AS Level3Type, L3 AS Level3Name
FROM {tree}"""
INPUTS["environment_target"] = """
SELECT CAST(ID AS BIGINT) * 2 AS EnvironmentKey, ID AS EnvironmentID, 'Old' AS EnvironmentType,
       concat('old ', Name) AS EnvironmentName, CAST(0 AS BIGINT) AS EnvironmentParentKey,
       CASE WHEN Segment = 'BUILDING' THEN 4 ELSE 9 END AS Level, 'old' AS Enterprise, 'old' AS Class,
       'old' AS MeasureGroup, 'old' AS Measure, 1 AS IsCurrent,
       CAST('2023-01-01 00:00:00' AS NTZ) AS EffectiveStartTime,
       CAST('9999-12-31 00:00:00' AS NTZ) AS EffectiveEndTime, 0 AS IsDeleted,
       CAST('2023-01-01 00:00:00' AS NTZ) AS CreatedDate, CAST(NULL AS NTZ) AS ModifiedDate
FROM {tree} WHERE Level < 4 OR Segment IN ('BUILDING', 'MACHINERY')
UNION ALL
SELECT p_partkey + 900000000, CAST(p_partkey + 400000000 AS INT), 'Measure', p_name,
       CAST(NULL AS BIGINT), 4, p_brand, p_type, p_type, p_name, 1,
       CAST('2023-01-01 00:00:00' AS NTZ), CAST('9999-12-31 00:00:00' AS NTZ), 0,
       CAST('2023-01-01 00:00:00' AS NTZ), CAST(NULL AS NTZ)
FROM {part}"""
INPUTS["ops_stage"] = """
SELECT ID AS OpsMeasureID,
       CASE Level WHEN 1 THEN 'Enterprise' WHEN 2 THEN 'Division' WHEN 3 THEN 'Plant'
            ELSE 'Measure' END AS OpsMeasureType,
       Name AS OpsMeasureName, ParentID AS OpsMeasureParentID, CAST(Level AS INT) AS Level,
       'Enterprise' AS Level1Type, L1 AS Level1Name, 'Division' AS Level2Type, L2 AS Level2Name,
       'Plant' AS Level3Type, L3 AS Level3Name, 'Department' AS Level4Type, Segment AS Level4Name,
       CASE Segment WHEN 'BUILDING' THEN 'Functional Area' WHEN 'MACHINERY' THEN 'Equipment'
            ELSE 'Unit' END AS Level5Type,
       Segment || ' area' AS Level5Name, 'Sub Process Area' AS Level6Type,
       Segment || ' sub' AS Level6Name
FROM {tree}"""
INPUTS["ops_target"] = """
SELECT CAST(ID AS BIGINT) * 2 AS OpsMeasureKey, ID AS OpsMeasureID, 'Old' AS OpsMeasureType,
       concat('old ', Name) AS OpsMeasureName, CAST(0 AS BIGINT) AS OpsMeasureParentKey, 9 AS Level,
       'old' AS Enterprise, 'old' AS Division, 'old' AS Plant, 'old' AS Department,
       'old' AS EquipmentAndFunctionalArea, 'old' AS SubProcessArea, 'old' AS Measure, 1 AS IsCurrent,
       CAST('2023-01-01 00:00:00' AS NTZ) AS EffectiveStartTime,
       CAST('9999-12-31 00:00:00' AS NTZ) AS EffectiveEndTime, 0 AS IsDeleted,
       CAST('2023-01-01 00:00:00' AS NTZ) AS CreatedDate, CAST(NULL AS NTZ) AS ModifiedDate
FROM {tree} WHERE Level < 4 OR Segment <> 'FURNITURE'"""

# --- people -----------------------------------------------------------------------------------
INPUTS["operator_stage"] = """
SELECT concat('OP', CAST(s_nationkey AS STRING)) AS OperatorID,
       concat('first ', CAST(s_suppkey AS STRING)) AS FirstName,
       concat('Last ', CAST(s_suppkey AS STRING)) AS LastName,
       CASE WHEN s_acctbal > 4000 THEN 1 ELSE 0 END AS IsActive,
       CASE WHEN s_acctbal > 9000 THEN NULL
            ELSE CAST(make_date(2020, CAST(1 + floor(abs(s_acctbal) / 1000) AS INT), 1) AS NTZ) END AS DateAdded
FROM {supplier}"""
INPUTS["person_stage"] = """
SELECT concat('U', CAST(c_custkey AS STRING)) AS PersonUID, CAST(c_custkey AS STRING) AS PersonID,
       concat('First ', CAST(c_custkey AS STRING)) AS FirstName,
       concat('Last ', CAST(c_custkey AS STRING)) AS LastName, c_name AS DisplayName,
       c_mktsegment AS Department, concat('Nation ', CAST(c_nationkey AS STRING)) AS Title,
       CASE WHEN c_acctbal < 1000 THEN NULL ELSE 'Boss' END AS Supervisor,
       CASE WHEN c_acctbal < 3000 THEN NULL ELSE 'INACTIVE' END AS Status
FROM {customer}"""
INPUTS["alias_stage"] = """
SELECT concat('DOM', chr(92), CAST(c_custkey AS STRING)) AS Operator
FROM {customer} WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT concat('dom', chr(92), CAST(c_custkey AS STRING)) FROM {customer} WHERE c_mktsegment = 'MACHINERY'
UNION ALL SELECT CAST(c_custkey AS STRING) FROM {customer} WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT concat('DOM', chr(92), 'x', CAST(s_suppkey AS STRING)) FROM {supplier}"""
INPUTS["operator_target"] = """
SELECT PersonUID, PersonID, CAST(NULL AS STRING) AS OperatorID, CAST(NULL AS STRING) AS OISOperatorAlias,
       upper(DisplayName) AS DisplayName, upper(FirstName) AS FirstName, upper(LastName) AS LastName,
       CASE WHEN Department = 'MACHINERY' THEN 'BUILDING' ELSE Department END AS Department, Title,
       Supervisor, coalesce(Status, 'ACTIVE') AS Status,
       CAST('2023-01-01 00:00:00' AS NTZ) AS CreatedDate, CAST('2023-01-01 00:00:00' AS NTZ) AS ModifiedDate
FROM {person_stage} WHERE Supervisor IS NULL OR Department = 'MACHINERY'"""

# --- units and attributes ---------------------------------------------------------------------
INPUTS["unit_stage"] = """
SELECT CAST(min(p_partkey) + 1 AS INT) AS UOMID, p_type AS UomName FROM {part} GROUP BY p_type"""
INPUTS["unit_mapping"] = """
SELECT DISTINCT p_type AS UomName, concat('pi_', p_type) AS PIUOMName FROM {part} WHERE p_size < 30"""
INPUTS["attribute_stage"] = """
SELECT concat('A', CAST(p_partkey AS STRING)) AS ID, p_brand AS EnumerationSetName,
       CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS IsConfigurationItem,
       CASE WHEN p_size > 10 THEN 1 ELSE 0 END AS IsHidden,
       CASE WHEN p_size > 40 THEN 1 ELSE 0 END AS IsManualDataEntry, p_size AS Level, p_name AS Name,
       concat(p_brand, chr(92), p_type) AS Path, nullif(p_type, 'PROMO') AS TraitType,
       CASE WHEN p_size < 10 THEN concat('PI_', p_type) WHEN p_size < 30 THEN lower(p_type)
            WHEN p_size < 45 THEN p_brand END AS UomName
FROM {part}"""
INPUTS["forecast_unit_stage"] = """
SELECT p_brand AS UnitOfMeasure FROM {part} WHERE p_size > 40
UNION ALL SELECT concat('Blank ', p_brand) FROM {part} WHERE p_size < 5
UNION ALL SELECT lower(p_type) FROM {part}
UNION ALL SELECT nullif(c_mktsegment, 'BUILDING') FROM {customer}"""
INPUTS["unit_target"] = """
SELECT CAST(min(p_partkey) + 50 AS BIGINT) AS UnitOfMeasureKey,
       CAST(CASE WHEN min(p_partkey) > 3 THEN 0 ELSE min(p_partkey) + 1 END AS INT) AS UnitOfMeasureID,
       p_type AS UnitOfMeasureName, CAST('2023-01-01 00:00:00' AS NTZ) AS CreatedDate,
       CAST('2023-01-01 00:00:00' AS NTZ) AS ModifiedDate
FROM {part} GROUP BY p_type"""
INPUTS["attribute_target"] = """
SELECT p_partkey + 500 AS AttributeKey, concat('a', CAST(p_partkey AS STRING)) AS AttributeID,
       CAST(CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN -5 ELSE -1 END AS BIGINT) AS UnitOfMeasureKey,
       CAST(-1 AS BIGINT) AS ElementKey, concat('old ', p_brand) AS EnumerationSetName,
       CASE WHEN p_size > 25 THEN 0 ELSE 1 END AS IsConfigurationItem,
       CASE WHEN p_size > 10 THEN 0 ELSE 1 END AS IsHidden,
       CASE WHEN p_size > 40 THEN 0 ELSE 1 END AS IsManualDataEntry, p_size + 1 AS Level,
       concat('old ', p_name) AS Name, concat('old ', p_brand) AS Path, 'old' AS TraitType,
       CASE WHEN p_size > 30 THEN 0 ELSE 1 END AS IsCurrent,
       CAST('1963-01-01 00:00:00' AS NTZ) AS EffectiveStartTime,
       CASE WHEN p_size > 30 THEN CAST('2023-06-01 00:00:00' AS NTZ)
            ELSE CAST('9999-12-31 00:00:00' AS NTZ) END AS EffectiveEndTime,
       0 AS IsDeleted, CAST('2023-01-01 00:00:00' AS NTZ) AS CreatedDate,
       CAST(NULL AS NTZ) AS ModifiedDate
FROM {part} WHERE p_size <> 20
UNION ALL
SELECT s_suppkey + 90000000, concat('S', CAST(s_suppkey AS STRING)), CAST(-1 AS BIGINT),
       CAST(-1 AS BIGINT), s_name, 0, 0, 0, 1, s_name, s_name, 'gone', 1,
       CAST('1963-01-01 00:00:00' AS NTZ), CAST('9999-12-31 00:00:00' AS NTZ), 0,
       CAST('2023-01-01 00:00:00' AS NTZ), CAST(NULL AS NTZ)
FROM {supplier}"""

# Oracle-side tables that the toolkit generates itself.
ORACLE_ONLY: dict[str, str] = {}


def _calendar_sql(days: str) -> str:
    return f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS DateKey, CAST(d AS DATE) AS Date
FROM (SELECT unnest(generate_series(CAST(FirstDay AS TIMESTAMP), CAST(LastDay AS TIMESTAMP),
      INTERVAL 1 DAY)) AS d FROM {days}) t"""


ORACLE_ONLY["ship_calendar"] = _calendar_sql("{ship_days}")
ORACLE_ONLY["event_calendar"] = _calendar_sql("{event_days}")
ORACLE_ONLY["clock_dim"] = """
SELECT CAST(s + 1 AS INT) AS TimeKey,
       strftime(TIMESTAMP '2000-01-01' + to_seconds(s), '%H:%M:%S') AS Time24Hr
FROM range(86400) r(s)"""

_NAME = re.compile(r"\{(\w+)\}")
_SPARK = [("AS NTZ", "AS TIMESTAMP_NTZ"), ("date_format_weekday(e.ts)", "date_format(e.ts, 'EEEE')")]
_DUCKDB = [("AS NTZ", "AS TIMESTAMP"), ("AS STRING", "AS VARCHAR"),
           ("date_format_weekday(e.ts)", "dayname(e.ts)")]


def _dialect(sql: str, swaps: list[tuple[str, str]]) -> str:
    for old, new in swaps:
        sql = sql.replace(old, new)
    return sql


_STORED: dict[tuple[str, str, str], str] = {}


class Inputs:
    """Test tables and inputs of one folder as DataFrames.

    An input is derived and written once per application, as a warehouse stores its
    stage and target tables, and read from there.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getitem__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        known = (self.spark.sparkContext.applicationId, self.folder, name)
        if known not in _STORED:
            sql = _dialect(INPUTS[name], _SPARK)
            needed = set(_NAME.findall(sql))
            derived = self.spark.sql(sql, **{n: self[n] for n in needed})
            path = f"{shared_folder(self.spark)}/inputs/{new_name()}"
            derived.write.parquet(path)
            _STORED[known] = path
        return self.spark.read.parquet(_STORED[known])


def oracle(sql: str) -> str:
    """SQL with every ``{input}`` it uses, directly or not, put in front as a named subquery."""
    texts = {**INPUTS, **ORACLE_ONLY}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in texts and name not in order:
                visit(texts[name])
                order.append(name)

    visit(sql)
    heads = [f"{name} AS ({texts[name].strip()})" for name in order]
    body = sql.strip()
    if heads and body.upper().startswith("WITH "):
        text = "WITH " + ",\n".join(heads) + ",\n" + body[5:]
    else:
        text = ("WITH " + ",\n".join(heads) + "\n" if heads else "") + body
    return _NAME.sub(r"\1", _dialect(text, _DUCKDB))
