"""Versions of a table: commits that see each other, schemas, roll-back."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shiftloom.sources import versions as v
from shiftloom.sources.tables import new_name


def rows(spark, *values):
    return spark.createDataFrame([(x,) for x in values], "a int")


def numbers(df):
    return sorted(r.a for r in df.collect())


@pytest.fixture
def table(spark):
    name = f"published_{new_name()}"
    yield name
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": name})


def test_an_added_column_is_visible(spark, tmp_path, table):
    base = f"{tmp_path}/it's a table"
    v.publish_version(rows(spark, 1, 2), base, "one", None, table)
    assert numbers(spark.table(table)) == [1, 2]
    wider = rows(spark, 3).withColumns({"b": F.lit("x"), "odd `name'": F.lit(1)})
    v.publish_version(wider, base, "two", "one", table)
    assert spark.table(table).columns == ["a", "b", "odd `name'"] and spark.newSession().table(table).first().b == "x"
    v.publish_version(wider.where("a < 0"), base, "three", "two", table)
    assert spark.table(table).count() == 0 and spark.table(table).columns == wider.columns
    assert v.read_version(spark, base, "one").columns == ["a"] and numbers(v.read_version(spark, base, "one")) == [1, 2]
    assert [x.previous for x in v.versions(spark, base)] == [None, "one", "two"]


def test_the_second_writer_is_refused(spark, tmp_path, table):
    base = f"{tmp_path}/t"
    v.publish_version(rows(spark, 1), base, "one", None, table)
    v.publish_version(rows(spark, 2), base, "two", "one", table)
    with pytest.raises(v.VersionConflict, match="'two', not 'one'"):
        v.publish_version(rows(spark, 3), base, "late", "one", table)
    with pytest.raises(v.VersionConflict):
        v.publish_version(rows(spark, 3), base, "late", None, table)
    with pytest.raises(ValueError, match="already"):
        v.publish_version(rows(spark, 3), base, "one", "two", table)
    assert numbers(spark.table(table)) == [2] and [x.name for x in v.versions(spark, base)] == ["one", "two"]


def test_a_writer_overtaken_during_its_write_is_refused(spark, tmp_path, monkeypatch, table):
    base = f"{tmp_path}/t"
    v.publish_version(rows(spark, 1), base, "one", None)
    commit = v._commit

    def overtaken(session, place, entry):
        monkeypatch.setattr(v, "_commit", commit)
        v.publish_version(rows(spark, 2), base, "first", "one", table)
        commit(session, place, entry)

    monkeypatch.setattr(v, "_commit", overtaken)
    with pytest.raises(v.VersionConflict, match="another writer"):
        v.publish_version(rows(spark, 3), base, "second", "one", table)
    assert numbers(spark.table(table)) == [2] and v.current(spark, base).name == "first"
    assert len(list((tmp_path / "t" / v.LOG).glob(".*-*"))) <= 1  # at most a checksum of the entry put aside


def test_an_aborted_write_leaves_the_old_version(spark, tmp_path, table):
    base = f"{tmp_path}/t"
    v.publish_version(rows(spark, 1), base, "one", None, table)
    bad = rows(spark, 1, 2).select(F.when(F.col("a") > 1, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("a")).alias("a"))
    with pytest.raises(PySparkException):
        v.publish_version(bad, base, "two", "one", table)
    assert numbers(spark.table(table)) == [1] and v.current(spark, base).name == "one"
    v.publish_version(rows(spark, 5), base, "two", "one", table)
    v.publish_version(rows(spark, 6), base, "three", "two", table)
    gone = v.forget_versions(spark, base, keep=2)
    assert len(gone) in (1, 2) and any(name.startswith("one-") for name in gone)
    assert numbers(spark.table(table)) == [6] and numbers(v.read_version(spark, base, "two")) == [5]


def test_roll_back_to_a_named_version(spark, tmp_path, table):
    base = f"{tmp_path}/t"
    v.publish_version(rows(spark, 1), base, "one", None, table)
    v.publish_version(rows(spark, 2).withColumn("b", F.lit(1)), base, "two", "one", table)
    with pytest.raises(v.VersionConflict):
        v.roll_back(spark, base, "one", "one", table)
    back = v.roll_back(spark, base, "one", "two", table)
    assert numbers(spark.table(table)) == [1] and spark.table(table).columns == ["a"]
    assert v.current(spark, base) == back and back.previous == "two"
    v.publish_version(rows(spark, 4), base, "three", back.name, table)
    assert numbers(v.read_version(spark, base)) == [4]
    with pytest.raises(ValueError, match="no version"):
        v.roll_back(spark, base, "never", "three")
    with pytest.raises(ValueError, match="no version"):
        v.read_version(spark, f"{tmp_path}/nothing")
