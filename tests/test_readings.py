"""Run status against the plain join, and the other options."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shiftloom.operators.rollup import roll_up
from shiftloom.operators.status import flag_readings, status_switches
from shiftloom.functions import clock

START = datetime(2024, 1, 1, 6)
SCHEMA = ("ElementAttributeID string, ElementID string, Attribute string, Value string, "
          "CategoryName string, Time timestamp_ntz")


def sample(seed, size=400, sensors=4):
    dice = random.Random(seed)
    rows = []
    for _ in range(size):
        sensor = "hot" if dice.random() < 0.4 else f"s{dice.randrange(sensors)}"
        time = START + timedelta(seconds=30 * dice.randrange(-40, 400))
        if dice.random() < 0.2:
            rows.append((sensor, sensor, "Run", dice.choice(["Off", "ON"]), "x run status", time))
        else:
            value = dice.choice(["1.5", "2.25", "Calc Failed", None, "7"])
            rows.append((sensor, sensor, dice.choice(["Flow", "Tank level", "Pump mode"]), value, "Process", time))
    rows.append((None, "e", "Flow", "1", "Process", START))
    rows.append((None, "e", "Run", "OFF", "run status", START - timedelta(hours=1)))
    rows.append(("z", "z", "Flow", "1", None, START))
    return rows


def plain_join(readings):
    """Every measurement with every switch of its sensor."""
    status = readings.where("lower(CategoryName) LIKE '%run status%'").selectExpr(
        "ElementAttributeID a", "ElementID e", "Value status", "Time from_time",
        "lead(Time) OVER (PARTITION BY ElementAttributeID, ElementID ORDER BY Time, Value) to_time")
    rows = readings.where("NOT lower(CategoryName) LIKE '%run status%'")
    joined = rows.join(status, F.expr("ElementAttributeID = a AND ElementID = e"), "left")
    return joined.selectExpr(
        "ElementAttributeID", "ElementID", "Attribute", "Value", "Time",
        "CASE WHEN lower(status) = 'off' AND Time > from_time AND Time <= to_time THEN 1 ELSE 0 END off")


@pytest.mark.parametrize("hot_rows", [5, 1000])
@pytest.mark.parametrize("seed", [1, 2])
def test_flags_equal_the_plain_join(spark, seed, hot_rows):
    readings = spark.createDataFrame(sample(seed), SCHEMA)
    keys = ["ElementAttributeID", "ElementID", "Attribute", "Value", "Time"]
    expected = plain_join(readings).groupBy(*keys).agg(F.count("*").alias("n"), F.sum("off").alias("off"))
    found = flag_readings(readings, hot_rows=hot_rows).groupBy(*keys).agg(
        F.sum("_weight").alias("n"), F.sum("_stopped").alias("off"))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_roll_up_equals_the_plain_join(spark):
    readings = spark.createDataFrame(sample(3), SCHEMA)
    anchor = clock.moment(START)
    copies = plain_join(readings).withColumn("_weight", F.lit(1)).withColumnRenamed("off", "_stopped")
    show = lambda df: sorted(
        (tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)
    found = show(roll_up(flag_readings(readings), anchor, 5))
    assert found == show(roll_up(copies, anchor, 5))
    assert not any("mode" in r[1] for r in found)


def test_open_stop(spark):
    rows = [("a", "a", "Run", "OFF", "Run Status", START),
            ("a", "a", "Flow", "1", "Process", START + timedelta(minutes=9))]
    readings = spark.createDataFrame(rows, SCHEMA)
    assert flag_readings(readings).first()["_stopped"] == 0
    assert flag_readings(readings, close_open_off=True).first()["_stopped"] == 1


def test_switches_cross_slots(spark):
    rows = [("a", "a", "Run", v, "Run Status", START + timedelta(hours=h)) for h, v in enumerate(["ON", "OFF", None])]
    found = status_switches(spark.createDataFrame(rows, SCHEMA)).orderBy("InitialStatusTime").collect()
    assert [(r.InitialStatus, r.NextStatus) for r in found] == [("ON", "OFF"), ("OFF", None), (None, "0")]
    assert [r.NextStatusTime for r in found] == [START + timedelta(hours=1), START + timedelta(hours=2), None]
