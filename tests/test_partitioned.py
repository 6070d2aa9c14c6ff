"""Merges into partitioned tables leave the files of other partitions alone."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shiftloom.operators.merge import KeyRules, VersionRules
from shiftloom.operators.partitioned import Partitions, inside, insert_partitions, upsert_partitions, versioned_partitions
from shiftloom.sources import tables

AS_OF = datetime(2024, 2, 1)
SCHEMA = "id int, v int, CreatedDate timestamp_ntz, ModifiedDate timestamp_ntz, day int"
DAY = Partitions(("day",))
KEY = KeyRules(("id", "day"))


@pytest.fixture
def path(spark, tmp_path):
    old = datetime(2020, 1, 1)
    rows = [(1, 10, old, old, 1), (2, 20, old, old, 1), (3, 30, old, old, 2), (4, 40, old, old, 3), (5, 50, old, old, None)]
    tables.append(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/t", ("day",))
    return f"{tmp_path}/t"


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def kept(before, path):
    """Folders whose files are all as they were."""
    now = files(path)
    return {name.split("/")[0] for name in before} - {name.split("/")[0] for name in before.keys() ^ now.keys()}


def values(spark, path):
    return sorted(((r.id, r.v, r.day) for r in spark.read.parquet(path).collect()), key=repr)


def source(spark, *rows):
    return tables.settle(spark.createDataFrame(list(rows), "id int, v int, day int"))


def test_upsert_writes_only_changed_partitions(spark, path):
    before = files(path)
    # Day 3 is in the source without a change, day 2 is not in it at all.
    feed = upsert_partitions(path, source(spark, (1, 11, 1), (4, 40, 3), (6, 60, 1)), KEY, DAY, AS_OF, ("v",))
    assert sorted((r.action, r.id) for r in feed.collect()) == [("INSERT", 6), ("UPDATE", 1)]
    assert values(spark, path) == [(1, 11, 1), (2, 20, 1), (3, 30, 2), (4, 40, 3), (5, 50, None), (6, 60, 1)]
    assert kept(before, path) == {"day=2", "day=3", "day=__HIVE_DEFAULT_PARTITION__"}


def test_an_empty_source_changes_nothing(spark, path):
    before = files(path)
    empty = tables.settle(spark.createDataFrame([], "id int, v int, day int"))
    upsert_partitions(path, empty, KEY, DAY, AS_OF, ("v",))
    assert files(path) == before


def test_stale_rows_go_where_asked(spark, path):
    before = files(path)
    parts = Partitions(("day",), stale="remove")
    upsert_partitions(path, source(spark, (1, 10, 1), (9, 90, None)), KeyRules(("id", "day"), null_safe=True), parts, AS_OF, ("v",))
    assert values(spark, path) == [(1, 10, 1), (3, 30, 2), (4, 40, 3), (9, 90, None)]
    assert kept(before, path) == {"day=2", "day=3"}


def test_more_partitions_than_are_listed(spark, path):
    rows = source(spark, (1, 11, 1), (3, 31, 2), (4, 41, 3))
    upsert_partitions(path, rows, KEY, Partitions(("day",), listed=1), AS_OF, ("v",))
    assert values(spark, path) == [(1, 11, 1), (2, 20, 1), (3, 31, 2), (4, 41, 3), (5, 50, None)]


def test_the_scan_names_its_partitions(spark, path, capsys):
    part = inside(spark.read.parquet(path), source(spark, (1, 1, 1), (4, 4, None)), DAY)
    part.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters" in plan and "Join" not in plan
    assert len(part.inputFiles()) == 5 and {r.day for r in part.collect()} == {1, None}
    two = Partitions(("day", "id"))
    assert inside(part, source(spark, (1, 1, 1), (5, 4, None)), two).count() == 2


def test_inserts_are_appended_with_keys_above_all_others(spark, path):
    before = files(path)
    rules = KeyRules(("v", "day"), surrogate="id")
    insert_partitions(path, source(spark, (0, 10, 1), (0, 70, 1), (0, 80, 2)), rules, DAY, AS_OF)
    assert sorted((v, day) for _, v, day in values(spark, path)) [-2:] == [(70, 1), (80, 2)]
    assert {i for i, v, _ in values(spark, path) if v in (70, 80)} == {6, 7}
    assert before.items() <= files(path).items()
    # A key without the day is looked for everywhere.
    insert_partitions(path, source(spark, (3, 0, 1), (8, 0, 1)), KeyRules(("id",)), DAY, AS_OF)
    assert [day for i, v, day in values(spark, path) if i == 3] == [2] and len(values(spark, path)) == 8


def test_versions_close_only_in_the_sources_partitions(spark, tmp_path):
    schema = "id int, code int, start timestamp_ntz, stop timestamp_ntz, CreatedDate timestamp_ntz, ModifiedDate timestamp_ntz, day int"
    old = datetime(2020, 1, 1)
    rows = [(1, 1, old, None, old, None, 1), (2, 1, old, None, old, None, 1), (3, 1, old, None, old, None, 2)]
    path = f"{tmp_path}/t"
    tables.append(spark.createDataFrame(rows, schema), path, ("day",))
    before = files(path)
    stage = tables.settle(spark.createDataFrame([(1, 2, 1)], "id int, code int, day int"))
    versioned_partitions(path, stage, KEY, DAY, VersionRules("start", "stop", "code"), AS_OF)
    found = sorted((r.id, r.code, r.stop is None) for r in spark.read.parquet(path).collect())
    assert found == [(1, 1, False), (1, 2, True), (2, 1, False), (3, 1, True)]
    assert kept(before, path) == {"day=2"}


def test_keys_without_the_partition_are_refused(spark, path):
    with pytest.raises(ValueError, match="day"):
        upsert_partitions(path, source(spark, (1, 1, 1)), KeyRules(("id",)), DAY, AS_OF, ("v",))
    with pytest.raises(ValueError, match="stale"):
        upsert_partitions(path, source(spark, (1, 1, 1)), KEY, Partitions(("day",), stale="drop"), AS_OF, ("v",))
    assert spark.read.parquet(path).where(F.col("id") == 1).count() == 1
