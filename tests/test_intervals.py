"""Versions that hold a moment: the ordered pass beside a plain join."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shiftloom.operators import intervals
from shiftloom.operators.intervals import join_versions
from shiftloom.operators.lookups import Lookup, look_up

T0 = datetime(2024, 1, 1)
VERSIONS = "vid int, code string, f timestamp_ntz, e timestamp_ntz"


def hours(n):
    return None if n is None else T0 + timedelta(hours=n)


def chain(code, n, first=0):
    return [(first + k, code, hours(k), hours(k + 1)) for k in range(n)]


def plain(rows, versions):
    out = []
    for r in rows:
        found = [v for v in versions if None not in (r[1], r[2], *v[1:]) and v[1].lower() == r[1].lower() and v[2] <= r[2] <= v[3]]
        out += [(*r, v[0]) for v in found] or [(*r, None)]
    return sorted(out, key=repr)


def joined(spark, rows, versions, **how):
    source = spark.createDataFrame(rows, "id int, code string, t timestamp_ntz")
    side = spark.createDataFrame(versions, VERSIONS).withColumnRenamed("code", "other")
    found = join_versions(source, side, {"_k": F.lower("code")}, {"_k": F.lower("other")}, "t", "f", "e", **how)
    return sorted((tuple(r) for r in found.select("id", "code", "t", "vid").collect()), key=repr)


@pytest.mark.parametrize("slot_rows", [7, 100_000])
def test_equals_a_plain_join(spark, slot_rows):
    rng = random.Random(3)
    versions = chain("A", 30) + chain("b", 3, 100)
    versions += [(200, "a", hours(2), hours(20)), (201, "a", hours(5), hours(5)), (202, "a", hours(5), hours(4)), (203, "a", None, hours(9)),
                 (204, "a", hours(8), None), (205, None, hours(0), hours(30))]
    versions += [(300 + k, "deep", hours(k), hours(60)) for k in range(25)]  # more open versions than are listed
    versions += [(400 + k, "c", hours(rng.randrange(50)), hours(rng.randrange(50))) for k in range(40)]
    rows = [(k, rng.choice(["a", "A", "b", "c", "deep", "none", None]), rng.choice([None, *map(hours, range(-2, 64))])) for k in range(300)]
    rows += [(1000, "a", hours(5.5)), (1000, "a", hours(5.5))]
    assert joined(spark, rows, versions, many=4, slot_rows=slot_rows) == plain(rows, versions)


def test_few_versions_and_empty_tables(spark):
    versions, rows = chain("a", 3), [(1, "a", hours(1)), (2, "x", hours(1))]
    assert joined(spark, rows, versions) == plain(rows, versions)
    assert joined(spark, rows, []) == plain(rows, [])
    assert joined(spark, [], chain("a", 100)) == []


def test_a_key_of_many_versions_makes_no_product(spark):
    n = 20_000
    versions = spark.range(n).select(
        F.col("id").cast("int").alias("PartKey"), F.lit("p").alias("PartID"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id as int))").alias("EffectiveStartTime"),
        F.expr("timestamp_ntz'2024-01-01 00:00:59' + make_interval(0, 0, 0, 0, 0, cast(id as int))").alias("EffectiveEndTime"),
    )
    rows = spark.range(200_000).select(
        F.lit("P").alias("PartID"), F.expr("timestamp_ntz'2024-01-01 00:00:30' + make_interval(0, 0, 0, 0, 0, cast(id % 20000 as int))").alias("t"))
    spec = Lookup("Part", "PartKey", "Found", (("PartID", "PartID"),), effective_at="t", required=True)
    found = look_up(rows, versions, spec)
    expected = "CAST(minute(t) + 60 * hour(t) + 1440 * datediff(t, DATE '2024-01-01') AS INT)"
    assert found.count() == 200_000 and found.where(F.expr(f"Found <> {expected}")).isEmpty()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and intervals.MANY < n
