from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shiftloom.operators.keys import assign_keys
from shiftloom.operators.merge import (
    HistoryRules, KeyRules, VersionRules, history, insert_only, upsert, versioned,
)

NOW, THEN, END = datetime(2024, 2, 1), datetime(2023, 1, 1), datetime(9999, 12, 31)
TYPE1 = "k long, id string, a string, b int, CreatedDate timestamp_ntz, ModifiedDate timestamp_ntz"
TYPE2 = ("k long, id string, a string, b int, IsCurrent int, EffectiveStartTime timestamp_ntz, "
         "EffectiveEndTime timestamp_ntz, IsDeleted int, CreatedDate timestamp_ntz, ModifiedDate timestamp_ntz")
SOURCE = "id string, a string, b int"
KEY = KeyRules(("id",), surrogate="k")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture
def type1(spark):
    return spark.createDataFrame([
        (1, "same", "x", 1, THEN, THEN), (2, "changed", "x", 1, THEN, THEN),
        (3, "null", None, 1, THEN, THEN), (4, "gone", "x", 1, THEN, THEN)], TYPE1)


@pytest.fixture
def source(spark):
    return spark.createDataFrame(
        [("SAME", "X", 1), ("changed", "x", 2), ("null", "y", 1), ("new", "n", None), (None, "m", 1)], SOURCE)


def test_upsert_any(type1, source):
    result = upsert(type1, source, KEY, NOW, update=("a", "b"))
    assert rows(result.existing, "id", "a", "b", "ModifiedDate") == [
        ("changed", "x", 2, NOW), ("gone", "x", 1, THEN), ("null", None, 1, THEN), ("same", "x", 1, THEN)]
    assert rows(result.inserted, "id", "a", "CreatedDate") == [("new", "n", NOW), (None, "m", NOW)]
    assert sorted(r.k for r in result.state.collect()) == [1, 2, 3, 4, 5, 6]
    assert rows(result.changes, "action", "id") == [
        ("INSERT", "new"), ("INSERT", None), ("UPDATE", "changed")]


def test_upsert_null_safe(type1, source):
    result = upsert(type1, source, KEY, NOW, update=("a", "b"), null_safe=True)
    assert rows(result.existing.where("ModifiedDate > CreatedDate"), "id") == [("changed",), ("null",)]


def test_upsert_twice_changes_nothing(type1, source):
    known = source.where("id is not null")
    once = upsert(type1, known, KEY, NOW, update=("a", "b")).state
    assert upsert(once, known, KEY, NOW, update=("a", "b")).changes.count() == 0


def test_upsert_without_update_columns(type1, source):
    result = upsert(type1, source, KEY, NOW, update=(), mode="always")
    assert rows(result.existing, "id", "b") == rows(type1, "id", "b")


def test_duplicates(spark, type1):
    twice = spark.createDataFrame([("changed", "p", 5), ("changed", "q", 6)], SOURCE)
    with pytest.raises(PySparkException, match="several source rows"):
        upsert(type1, twice, KEY, NOW, update=("a", "b")).state.collect()
    first = upsert(type1, twice, KeyRules(("id",), duplicates="first"), NOW, update=("a", "b"))
    assert rows(first.existing.where("id = 'changed'"), "a", "b") == [("p", 5)]
    fresh = spark.createDataFrame([("n", "p", 5), ("n", "p", 5)], SOURCE)
    assert insert_only(type1, fresh, KEY, NOW).inserted.count() == 2


def test_insert_only(type1, source):
    result = insert_only(type1, source, KEY, NOW, stamp_modified=False)
    assert result.existing is type1
    assert rows(result.inserted, "id", "ModifiedDate") == [("new", None), (None, None)]


@pytest.fixture
def type2(spark):
    return spark.createDataFrame([
        (1, "all", "x", 1, 0, THEN, NOW, 0, THEN, THEN), (2, "all", "x", 1, 1, THEN, END, 0, THEN, None),
        (3, "one", "x", 1, 1, THEN, END, 0, THEN, None), (4, "null", None, 1, 1, THEN, END, 0, THEN, None),
        (5, "gone", "x", 1, 1, THEN, END, 0, THEN, None), (6, "back", "x", 1, 1, THEN, END, 1, THEN, None)], TYPE2)


@pytest.fixture
def changed(spark):
    return spark.createDataFrame([
        ("all", "y", 2), ("one", "y", 1), ("null", "y", 2), ("back", "x", 1), ("new", "n", 1)], SOURCE)


def test_history_all_columns_must_change(type2, changed):
    result = history(type2, changed, KEY, HistoryRules(tracked=("a", "b")), NOW)
    assert rows(result.inserted, "id", "a", "IsCurrent", "ModifiedDate") == [
        ("all", "y", 1, None), ("new", "n", 1, None)]
    assert rows(result.existing, "k", "IsCurrent", "IsDeleted") == [
        (1, 0, 0), (2, 0, 0), (3, 1, 0), (4, 1, 0), (5, 1, 1), (6, 1, 1)]
    assert rows(result.existing.where("k = 2"), "EffectiveEndTime", "ModifiedDate") == [(NOW, NOW)]
    assert rows(result.changes, "action", "id") == [("INSERT", "new"), ("UPDATE", "all"), ("UPDATE", None)]


def test_history_any_keeps_one_open_row(type2, changed):
    how = HistoryRules(tracked=("a", "b"), change="any", null_safe=True, undelete=True)
    result = history(type2, changed, KEY, how, NOW)
    assert rows(result.inserted, "id") == [("all",), ("new",), ("null",), ("one",)]
    assert rows(result.existing.where("IsDeleted = 1"), "id") == [("gone",)]
    open_rows = result.state.where("IsCurrent = 1").groupBy("id").count()
    assert open_rows.where("count <> 1").count() == 0
    again = history(result.state, changed, KEY, how, datetime(2024, 3, 1))
    assert again.inserted.count() == 0


def test_history_always_versions_history_rows(type2, changed):
    how = HistoryRules(change="always", only_current=False, stamp_new=True, stamp_deleted=True)
    result = history(type2, changed, KEY, how, NOW)
    assert rows(result.inserted, "id") == [("all",), ("all",), ("back",), ("new",), ("null",), ("one",)]
    assert rows(result.existing.where("id = 'gone'"), "IsDeleted", "ModifiedDate") == [(1, NOW)]


def test_history_first_version(type2, changed):
    how = HistoryRules(tracked=("a", "b"), first_start=datetime(1963, 1, 1), first_nulls=("b",),
                       constants={"a": "fixed"})
    result = history(type2, changed, KEY, how, NOW)
    assert rows(result.inserted, "id", "a", "b", "EffectiveStartTime") == [
        ("all", "fixed", 2, NOW), ("new", "fixed", None, datetime(1963, 1, 1))]


VERSIONED = "id int, v int, s timestamp_ntz, e timestamp_ntz, CreatedDate timestamp_ntz, ModifiedDate timestamp_ntz"


def test_versioned(spark):
    target = spark.createDataFrame([
        (1, 5, THEN, None, THEN, None), (2, 5, THEN, None, THEN, None), (3, 5, THEN, None, THEN, None),
        (4, 5, THEN, THEN, THEN, None), (5, None, THEN, None, THEN, None), (6, 5, THEN, THEN, THEN, None)], VERSIONED)
    stage = spark.createDataFrame([(1, 5), (2, None), (5, -1), (6, 7), (7, None), (8, 1)], "id int, v int")
    rules, how = KeyRules(("id",)), VersionRules("s", "e", "v")
    result = versioned(target, stage, rules, how, NOW)
    assert rows(result.existing, "id", "e") == [
        (1, None), (2, NOW), (3, NOW), (4, NOW), (5, None), (6, THEN)]
    assert rows(result.inserted, "id", "v", "s", "e", "ModifiedDate") == [
        (2, None, NOW, None, None), (8, 1, NOW, None, NOW)]
    lenient = VersionRules("s", "e", "v", only_open=True, reopen=True)
    result = versioned(target, stage, rules, lenient, NOW)
    assert rows(result.existing.where("id = 4"), "e") == [(THEN,)]
    assert rows(result.inserted, "id") == [(2,), (6,), (8,)]


def test_assign_keys(spark):
    data = spark.range(2000).select(F.lit(None).cast("long").alias("k"), F.col("id"))
    copies = data.unionByName(data.where("id < 500")).repartition(7)
    found = assign_keys(copies, "k", ["id"], F.lit(10))
    assert sorted(r.k for r in found.collect()) == list(range(11, 2511))
    assert rows(found, "k", "id") == rows(assign_keys(copies.repartition(3), "k", ["id"], F.lit(10)), "k", "id")


VERSION = "id string, v {kind}, StartDate timestamp_ntz, EndDate timestamp_ntz, CreatedDate timestamp_ntz, ModifiedDate timestamp_ntz"


@pytest.mark.parametrize("kind, same, other", [
    ("string", ("open", "OPEN"), ("open", "shut")), ("timestamp_ntz", (THEN, THEN), (THEN, NOW)),
    ("date", (THEN.date(), THEN.date()), (THEN.date(), NOW.date())), ("int", (-1, None), (-1, 2)),
])
def test_versions_of_any_type(spark, kind, same, other):
    target = spark.createDataFrame([("a", same[0], THEN, None, THEN, None), ("b", other[0], THEN, None, THEN, None)], VERSION.format(kind=kind))
    source = spark.createDataFrame([("a", same[1]), ("b", other[1])], f"id string, v {kind}")
    result = versioned(target, source, KeyRules(("id",)), VersionRules("StartDate", "EndDate", "v"), NOW)
    assert rows(result.existing, "id", "EndDate") == [("a", None), ("b", NOW)]
    assert rows(result.inserted, "id", "v") == [("b", other[1])]


def test_a_merge_reads_the_target_twice(spark, tmp_path, type1, source, monkeypatch):
    from shiftloom.operators import merge

    type1.withColumn("onlyhere", F.lit(1)).write.parquet(f"{tmp_path}/t")
    target, written = spark.read.parquet(f"{tmp_path}/t"), []
    plain = merge.settle

    def counted(df):
        written.append(df._jdf.queryExecution().executedPlan().toString().count(f"{tmp_path}/t"))
        return plain(df)

    monkeypatch.setattr(merge, "settle", counted)
    result = upsert(target, source.where("id is not null"), KEY, NOW, update=("a", "b"))
    state = result.existing._jdf.queryExecution().executedPlan().toString().count(f"{tmp_path}/t")
    assert sum(written) == 1 and state == 1
    assert f"{tmp_path}/t" not in result.changes._jdf.queryExecution().executedPlan().toString()
