"""Calendar, clock and column-function queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from shiftloom.functions import clock, text
from shiftloom.operators import lookups, rollup
from shiftloom.plans import calendar
from shiftloom.sources import generators

from .base import AS_OF, query, shown
from .inputs import INPUTS, Inputs

INPUTS["order_days"] = """
SELECT CAST(min(o_orderdate) AS DATE) AS FirstDay, CAST(max(o_orderdate) AS DATE) AS LastDay
FROM {orders}"""
INPUTS["big_order_days"] = """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS Date FROM {orders}
WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000"""

DATE_PARTS = """
       CAST(day(d) AS SMALLINT) AS Day,
       CAST(CAST(strftime(d, '%U') AS INT)
            + CASE WHEN dayofweek(date_trunc('year', d)) = 0 THEN 0 ELSE 1 END AS SMALLINT) AS Week,
       dayname(d) AS WeekDayName, upper(substr(dayname(d), 1, 3)) AS WeekDayNameShort,
       CAST(dayofweek(d) + 1 AS SMALLINT) AS DayOfWeek, CAST(dayofyear(d) AS SMALLINT) AS DayOfYear,
       CAST(month(d) AS SMALLINT) AS Month, monthname(d) AS MonthName,
       upper(substr(monthname(d), 1, 3)) AS MonthNameShort, CAST(quarter(d) AS SMALLINT) AS Quarter,
       CASE quarter(d) WHEN 1 THEN 'First' WHEN 2 THEN 'second' WHEN 3 THEN 'third' ELSE 'fourth' END
         AS QuarterName,
       CAST(year(d) AS SMALLINT) AS Year, CAST(date_trunc('year', d) AS DATE) AS FirstOfYear"""


def ship_calendar(i: Inputs) -> DataFrame:
    days = generators.calendar_days(i["ship_days"], F.col("FirstDay"), F.col("LastDay"))
    return generators.date_columns(days, AS_OF)


def event_calendar(i: Inputs) -> DataFrame:
    days = generators.calendar_days(i["event_days"], F.col("FirstDay"), F.col("LastDay"))
    return generators.date_columns(days, AS_OF)


@query(f"""
WITH days AS (SELECT unnest(generate_series(CAST(FirstDay AS TIMESTAMP), CAST(LastDay AS TIMESTAMP),
                                            INTERVAL 1 DAY)) AS d FROM {{order_days}})
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS DateKey, CAST(d AS DATE) AS Date, {DATE_PARTS},
       CASE WHEN CAST(d AS DATE) IN (SELECT Date FROM {{big_order_days}})
            THEN '2023-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS CreatedDate
FROM days""")
def date_dimension_merge(i: Inputs) -> DataFrame:
    """Days of all orders merged into a calendar that holds some of them."""
    loaded = generators.date_columns(i["big_order_days"], "2023-01-01")
    days = generators.calendar_days(i["order_days"], F.col("FirstDay"), F.col("LastDay"))
    return shown(calendar.merge_dates(loaded, days, AS_OF).state).drop("ModifiedDate")


@query("""
SELECT DateKey, Date FROM (
  SELECT CAST(strftime(Date, '%Y%m%d') AS INT) AS DateKey, Date FROM {big_order_days}
  UNION SELECT CAST(strftime(d, '%Y%m%d') AS INT), CAST(d AS DATE)
  FROM generate_series(TIMESTAMP '1995-03-01', TIMESTAMP '1998-02-28', INTERVAL 1 DAY) g(d)) c""")
def date_dimension_years(i: Inputs) -> DataFrame:
    """Three years of days added to a calendar of the days with big orders."""
    loaded = generators.date_columns(i["big_order_days"], "2023-01-01")
    return calendar.load_dates(loaded, date(1995, 3, 1), 3, AS_OF).state.select("DateKey", "Date")


@query("""
SELECT c.TimeKey, c.Time24Hr, strftime(TIMESTAMP '2000-01-01' + to_seconds(c.TimeKey - 1), '%I:%M:%S %p')
         AS Time12Hr, c.Time24Hr AS Time24HrTimeType,
       CAST(floor((c.TimeKey - 1) / 3600) AS SMALLINT) AS Hour24,
       CAST(strftime(TIMESTAMP '2000-01-01' + to_seconds(c.TimeKey - 1), '%I') AS SMALLINT) AS Hour12,
       CAST(substr(c.Time24Hr, 4, 2) AS SMALLINT) AS MinuteNumber,
       CAST(substr(c.Time24Hr, 7, 2) AS SMALLINT) AS SecondNumber, coalesce(e.n, 0) AS Events
FROM {clock_dim} c LEFT JOIN (SELECT strftime(ts, '%H:%M:%S') AS t, count(*) AS n FROM {events}
                              GROUP BY 1) e ON e.t = c.Time24Hr""")
def time_dimension_events(i: Inputs) -> DataFrame:
    """Events per second of the day on the time dimension."""
    counts = i["events"].groupBy(clock.clock_text(F.col("ts")).alias("t")).agg(F.count("*").alias("n"))
    times = calendar.load_times(i.spark, AS_OF).drop("CreatedDate", "ModifiedDate")
    joined = times.join(counts, times["Time24Hr"] == counts["t"], "left")
    return joined.select(*times.columns, F.coalesce("n", F.lit(0)).alias("Events"))


@query("""
SELECT CAST(year(l_shipdate) AS SMALLINT) AS Year, monthname(l_shipdate) AS MonthName,
       upper(substr(dayname(l_shipdate), 1, 3)) AS WeekDayNameShort, count(*) AS Lines
FROM {lineitem} GROUP BY 1, 2, 3""")
def date_view_shipments(i: Inputs) -> DataFrame:
    """Line items by the calendar's presentation view."""
    view = calendar.date_view(ship_calendar(i))
    lines = i["lineitem"].select(F.to_date("l_shipdate").alias("Date"))
    joined = lines.join(view, "Date")
    return joined.groupBy("Year", "MonthName", "WeekDayNameShort").agg(F.count("*").alias("Lines"))


@query("""
SELECT CAST(hour(ts) AS SMALLINT) AS Hour24, strftime(ts, '%I:%M:%S %p')[10:] AS Half, count(*) AS Events
FROM {events} GROUP BY 1, 2""")
def time_view_events(i: Inputs) -> DataFrame:
    """Events by the clock's presentation view."""
    view = calendar.time_view(calendar.load_times(i.spark, AS_OF))
    events = i["events"].select(clock.clock_text(F.col("ts")).alias("Time24Hr"))
    joined = events.join(view, "Time24Hr")
    half = F.right(F.col("Time12Hr"), F.lit(2)).alias("Half")
    return joined.groupBy("Hour24", half).agg(F.count("*").alias("Events"))


@query(f"""
SELECT o_orderkey AS OrderID, CAST(strftime(d, '%Y%m%d') AS INT) AS DateKey, {DATE_PARTS},
       CAST(CAST(d AS DATE) + INTERVAL 2 YEAR AS DATE) AS TwoYearsOn,
       CAST(CAST(d AS DATE) - INTERVAL 1 DAY AS DATE) AS DayBefore,
       CAST(date_diff('day', DATE '1995-01-01', CAST(d AS DATE)) AS INT) AS DaysSince
FROM (SELECT o_orderkey, o_orderdate AS d FROM {{orders}}) t""")
def date_functions(i: Inputs) -> DataFrame:
    """Every date function on every order date."""
    rows = i["orders"].select("o_orderkey", F.to_date("o_orderdate").alias("Date"))
    parts = generators.date_columns(rows.select("Date").distinct(), AS_OF)
    parts = calendar.date_view(parts).withColumns({
        "TwoYearsOn": F.add_months("Date", 24),
        "DayBefore": F.date_sub("Date", 1),
        "DaysSince": F.datediff("Date", F.lit("1995-01-01").cast("date")),
    })
    return rows.join(parts, "Date").drop("Date").withColumnRenamed("o_orderkey", "OrderID")


@query("""
SELECT event_id AS EventID, strftime(ts, '%H:%M:%S') AS Clock,
       date_diff('minute', TIMESTAMP '2024-01-10 06:00:30', ts) AS MinutesCrossed,
       strftime(TIMESTAMP '2024-01-10 06:00:00'
                + to_minutes(CAST(abs(floor(date_diff('minute', TIMESTAMP '2024-01-10 06:00:00', ts)
                                            * 1.00 / 5) + 1) * 5 AS INT)), '%Y-%m-%d %H:%M:%S') AS BandEnd,
       strftime(TIMESTAMP '2024-01-10 06:00:00'
                + to_minutes(CAST((floor(date_diff('minute', TIMESTAMP '2024-01-10 06:00:00', ts)
                                         / 60) + 1) * 60 AS INT)), '%Y-%m-%d %H:%M:%S') AS BandEndUnfolded,
       strftime(ts + INTERVAL 90 MINUTE - INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS Shifted,
       strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS EasternClock
FROM {events}""")
def time_functions(i: Inputs) -> DataFrame:
    """Minute boundaries, bands, shifts and zone conversion on every event (January: UTC-5)."""
    ts, anchor = F.col("ts"), clock.moment("2024-01-10 06:00:00")

    def seconds(col):
        return F.substring(col.cast("string"), 1, 19)

    return i["events"].select(
        F.col("event_id").alias("EventID"),
        clock.clock_text(ts).alias("Clock"),
        clock.minutes_crossed(clock.moment("2024-01-10 06:00:30"), ts).alias("MinutesCrossed"),
        seconds(clock.band_end(anchor, ts, 5)).alias("BandEnd"),
        seconds(clock.band_end(anchor, ts, 60, fold_negative=False)).alias("BandEndUnfolded"),
        seconds(clock.add_seconds(clock.add_minutes(ts, F.lit(90)), -1)).alias("Shifted"),
        seconds(clock.to_zone(ts, "America/New_York")).alias("EasternClock"),
    )


@query("""
SELECT event_id AS EventID,
       CASE WHEN raw = 'Calc Failed' THEN NULL
            WHEN regexp_matches(raw, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')
            THEN CAST(trim(raw) AS DOUBLE) END AS Number
FROM (SELECT event_id, CASE WHEN value < 0.5 THEN 'Calc Failed'
                            WHEN value < 1 THEN CAST(value AS VARCHAR) || 'd'
                            WHEN value < 2 THEN '$' || CAST(value AS VARCHAR)
                            WHEN value < 3 THEN ' ' || CAST(value AS VARCHAR) || ' '
                            WHEN value < 4 THEN '-' || CAST(value AS VARCHAR)
                            WHEN value < 5 THEN CAST(value AS VARCHAR) || 'e2'
                            WHEN value < 6 THEN 'NaN' WHEN value < 7 THEN '' WHEN value < 8 THEN NULL
                            WHEN value < 9 THEN '-' ELSE CAST(value AS VARCHAR) END AS raw
      FROM {events}) t""")
def guarded_numbers(i: Inputs) -> DataFrame:
    """Numeric parse of clean and dirty texts."""
    value = F.col("value")
    plain = value.cast("string")
    raw = (
        F.when(value < 0.5, "Calc Failed").when(value < 1, F.concat(plain, F.lit("d")))
        .when(value < 2, F.concat(F.lit("$"), plain))
        .when(value < 3, F.concat(F.lit(" "), plain, F.lit(" ")))
        .when(value < 4, F.concat(F.lit("-"), plain)).when(value < 5, F.concat(plain, F.lit("e2")))
        .when(value < 6, "NaN").when(value < 7, "").when(value < 8, F.lit(None)).when(value < 9, "-")
        .otherwise(plain)
    )
    rows = i["events"].select("event_id", raw.alias("raw"))
    return rows.select(F.col("event_id").alias("EventID"), text.number_or_null(F.col("raw")).alias("Number"))


@query("""
SELECT Attribute, CategoryName, CategoryName ILIKE '%Run Status%' AS RunStatus,
       Attribute ILIKE '%mode' OR Attribute ILIKE '%L/H' OR Attribute ILIKE '%on/off' AS State,
       lower(Attribute) IN ('conditioning ph', 'level %') OR Attribute ILIKE '%level'
         OR Attribute ILIKE '%levels' AS Level, count(*) AS Readings
FROM {readings} GROUP BY ALL""")
def reading_kinds(i: Inputs) -> DataFrame:
    """Readings by the tests that sort them."""
    attribute, category = F.col("Attribute"), F.col("CategoryName")
    return i["readings"].groupBy(
        attribute, category, text.is_run_status(category).alias("RunStatus"),
        text.is_state_attribute(attribute).alias("State"),
        text.is_level_attribute(attribute).alias("Level"),
    ).agg(F.count("*").alias("Readings"))


@query("""
SELECT p_partkey AS PartID, a.pos AS position, a.item AS LeftItem, b.item AS RightItem
FROM {part},
     LATERAL (SELECT unnest(string_split(replace(p_name, ' ', ','), ',')) AS item,
                     generate_subscripts(string_split(replace(p_name, ' ', ','), ','), 1) AS pos) a
JOIN LATERAL (SELECT unnest(string_split(p_type || ',' || p_brand || ',x', ',')) AS item,
                     generate_subscripts(string_split(p_type || ',' || p_brand || ',x', ','), 1) AS pos) b
  ON a.pos = b.pos""")
def paired_columns(i: Inputs) -> DataFrame:
    """Two comma-separated texts paired by position; the third item has no partner."""
    rows = i["part"].select(
        F.col("p_partkey").alias("PartID"),
        F.replace("p_name", F.lit(" "), F.lit(",")).alias("l"),
        F.concat_ws(",", "p_type", "p_brand", F.lit("x")).alias("r"),
    )
    pairs = text.paired_rows(rows, "l", "r", ("LeftItem", "RightItem"))
    return pairs.select("PartID", F.col("position").cast("bigint").alias("position"), "LeftItem", "RightItem")


@query("""
SELECT p_brand AS Brand, p_size AS Size, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS Types
FROM {part} GROUP BY 1, 2""")
def listed_types(i: Inputs) -> DataFrame:
    """Types per brand and size as one text."""
    rows = i["part"].select(F.col("p_brand").alias("Brand"), F.col("p_size").alias("Size"), "p_type")
    return lookups.describe(rows, ["Brand", "Size"], "p_type", "Types")


@query("""
SELECT p_partkey AS PartID, unnest(string_split(replace(p_name, ' ', ','), ',')) AS Word,
       generate_subscripts(string_split(replace(p_name, ' ', ','), ','), 1) AS position
FROM {part}""")
def split_words(i: Inputs) -> DataFrame:
    """One row per item of a comma-separated text."""
    rows = i["part"].select(
        F.col("p_partkey").alias("PartID"), F.replace("p_name", F.lit(" "), F.lit(",")).alias("csv")
    )
    words = text.split_rows(rows, "csv", "Word")
    return words.select("PartID", "Word", F.col("position").cast("bigint").alias("position"))


@query("""
SELECT o_orderkey AS OrderID, o_totalprice AS Price FROM {orders}
ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def largest_orders(i: Inputs) -> DataFrame:
    """The 100 largest orders."""
    rows = i["orders"].select(F.col("o_orderkey").alias("OrderID"), F.col("o_totalprice").alias("Price"))
    return lookups.first_rows(rows, [F.desc("Price"), F.asc("OrderID")], 100)


@query("""
SELECT ElementID, count(*) AS Readings, strftime(max(Time), '%Y-%m-%d %H:%M:%S') AS LastTime
FROM {readings}
WHERE Time <= (SELECT max(ShiftEndTime) - INTERVAL 1 SECOND FROM {readings}) GROUP BY 1""")
def readings_before_shift_end(i: Inputs) -> DataFrame:
    """Readings up to one second before the latest shift end."""
    rows = rollup.before_shift_end(i["readings"])
    return rows.groupBy("ElementID").agg(
        F.count("*").alias("Readings"),
        F.substring(F.max("Time").cast("string"), 1, 19).alias("LastTime"),
    )
