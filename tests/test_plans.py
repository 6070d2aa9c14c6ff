from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException

from shiftloom.operators import hierarchy, lookups
from shiftloom.operators.lookups import Lookup, column_pairs, fact_lookups, resolve
from shiftloom.plans.metadata import forecast_lookup_table
from shiftloom.sources import tables
from shiftloom.sources.tables import settle

REASON = ("ReasonID int, ReasonCode string, ReasonCodeParent string, ReasonHierarchy string, ReasonName string, "
          "OeeCategory string, ReasonPath string")


def test_flatten_leaves_out_cycles_and_orphans(spark):
    rows = [(1, "a", None, "H", "A", "o", "A"), (2, "b", "a", "H", "B", "o", "A\\B"),
            (3, "c", "lost", "H", "C", "o", "A\\C"), (4, "d", "e", "H", "D", "o", "X\\D"),
            (5, "e", "d", "H", "E", "o", "X\\D\\E"), (6, "f", "a", "other", "F", "o", "A\\F")]
    found = hierarchy.flatten(hierarchy.with_parent_id(spark.createDataFrame(rows, REASON))).collect()
    assert sorted((r.ReasonID, r.Level1Name, r.Level2Name, r.Level3Name) for r in found) == [
        (1, "A", None, None), (2, "A", "B", None)]


def test_flatten_below_the_named_levels(spark):
    names = [chr(97 + n) for n in range(12)]
    rows = [(n, names[n], names[n - 1] if n else None, "H", names[n], "o", "\\".join(names[:n + 1])) for n in range(12)]
    chain = hierarchy.with_parent_id(spark.createDataFrame(rows, REASON))
    deep = {r.ReasonID: r for r in hierarchy.flatten(chain).collect()}
    assert len(deep) == 12 and deep[11].Level10Name == "j" and deep[11].Level == 12


def test_flatten_follows_parents_whatever_the_path_depth(spark):
    rows = [(n, f"c{n}", f"c{n - 1}" if n else None, "H", f"n{n}", "o", "r" if n == 0 else f"x\\{n}") for n in range(14)]
    found = {r.ReasonID: r for r in hierarchy.flatten(hierarchy.with_parent_id(spark.createDataFrame(rows, REASON))).collect()}
    assert sorted(found) == list(range(14))
    assert all(found[n].Level1Name == "n0" and found[n].Level2Name == f"n{n}" for n in range(1, 14))


NODES = "ReasonID int, ReasonCode string, ReasonHierarchy string, ReasonName string, OeeCategory string, Level int, ReasonParentID int"


def climbed(rows):
    """Names by level of each row that reaches a root, by walking up."""
    by, out = {r[0]: r for r in rows if r[0] is not None}, []
    for r in rows:
        names, seen, at = {}, set(), r
        while at is not None and id(at) not in seen:
            seen.add(id(at))
            names.setdefault(at[5], at[3])
            if at[5] == 1:
                out.append((r[0], r[3], *[names.get(n) for n in range(1, 11)]))
                break
            at = by.get(at[6])
    return sorted(out, key=repr)


def names_of(rows):
    return sorted(((r.ReasonID, r.ReasonName, *[r[f"Level{n}Name"] for n in range(1, 11)]) for r in rows), key=repr)


@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.integers(0, 13)), st.booleans()), max_size=14))
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_flatten_equals_walking_up(spark, parts):
    rows = [(n, "c", "H", f"n{n}" if named else None, "o", level, up) for n, (level, up, named) in enumerate(parts)]
    rows += [(None, "c", "H", "no id", "o", 3, 0), (None, "c", "H", "root", "o", 1, 5)]
    assert names_of(hierarchy.flatten(spark.createDataFrame(rows, NODES)).collect()) == climbed(rows)


def test_a_long_chain_takes_few_joins(spark, monkeypatch):
    rows = [(n, "c", "H", f"n{n}", "o", min(n, 300) + 1, n - 1) for n in range(1000)]
    rows += [(2000 + n, "c", "H", f"loop{n}", "o", 5, 2000 + (n + 1) % 50) for n in range(50)] + [(3000, "c", "H", "below", "o", 6, 2007)]
    written = []
    monkeypatch.setattr(hierarchy, "settle", lambda df: written.append(settle(df)) or written[-1])
    found = hierarchy.flatten(spark.createDataFrame(rows, NODES))
    assert names_of(found.collect()) == climbed(rows) and found.count() == 1000
    assert len(written) <= 12


@pytest.mark.parametrize("twice", [(3, "A", None, "h", "A2", "o", "A"), (2, "c", None, "H", "C", "o", "C")])
def test_repeated_codes_and_ids_fail(spark, twice):
    rows = [(1, "a", None, "H", "A", "o", "A"), (2, "b", "a", "H", "B", "o", "A\\B"), twice]
    with pytest.raises(PySparkException, match="occurs twice"):
        hierarchy.with_parent_id(spark.createDataFrame(rows, REASON)).collect()


def test_parent_key_refuses_two_current_rows(spark):
    dimension = spark.createDataFrame([(1, 10, 1), (2, 10, 1)], "k long, id int, IsCurrent int")
    stage = spark.createDataFrame([(5, 10)], "id int, parent int")
    with pytest.raises(PySparkException, match="several current rows"):
        hierarchy.with_parent_key(stage, dimension, "parent", "id", "k", "parent_key").collect()


def test_lookup_misses(spark):
    source = spark.createDataFrame([("A",), ("z",), (None,)], "code string")
    dimension = spark.createDataFrame([(7, "a")], "k long, code string")
    spec = Lookup("D", "k", "key", (("code", "code"),))
    assert [r.key for r in resolve(source, [spec], {"D": dimension}).collect()] == [7, -1, -1]
    kept = resolve(source, lookups.without_default([spec]), {"D": dimension})
    assert [r.key for r in kept.collect()] == [7, None, None]
    assert {r.key for r in resolve(source, [spec], {}).collect()} == {-1}
    with pytest.raises(ValueError):
        resolve(source, [], {})


def test_metadata_specs():
    assert column_pairs("a, b", "c,d") == [("a", "c"), ("b", "d")]
    with pytest.raises(ValueError):
        column_pairs("a,b", "c")
    row = {"FactTableName": "F", "FactColumnName": "PartKey", "StgColumnName": "p,q", "LookupTableName": "Part",
           "LookupTableAliasName": "x", "LookupColumnName": "r,s", "LookupIsSCD": "Yes", "SCDDateField": "at"}
    spec, = fact_lookups([row, {**row, "LookupTableName": "Location"}], "F", {"Part": "PartKey"})
    assert spec.on == (("p", "r"), ("q", "s")) and spec.effective_at == "at" and spec.key == "PartKey"


def test_forecast_lookup_table(spark):
    rows = forecast_lookup_table(spark, datetime(2024, 1, 1)).collect()
    assert len(rows) == 11 and len([r for r in rows if r.LookupTableName == "ForecastDetail"]) == 9


def test_sinks(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "v int, part string")
    tables.append(rows, f"{base}/t", ("part",))
    tables.append(rows.where("v = 1"), f"{base}/t", ("part",))
    tables.replace_partitions(spark.createDataFrame([(9, "a")], "v int, part string"), f"{base}/t", ["part"])
    assert sorted((r.v, r.part) for r in tables.read_table(spark, f"{base}/t").collect()) == [(2, "b"), (9, "a")]
    tables.reload(rows, f"{base}/s")
    tables.clear(spark, f"{base}/s")
    assert tables.read_table(spark, f"{base}/s").schema == rows.schema and spark.read.parquet(f"{base}/s").count() == 0


def test_null_partitions_are_merged(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "v int, part string"
    tables.append(spark.createDataFrame([(1, None), (2, "a"), (3, "b")], schema), path, ("part",))
    source = spark.createDataFrame([(4, None), (5, "a")], schema)
    tables.merge_partitions(path, source, ["part"], lambda rows: rows.unionByName(source))
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5]


def test_settled_tables(spark):
    settled = tables.settle(spark.range(5))
    files = settled.inputFiles()
    tables.forget_settled(spark, settled)
    with pytest.raises(PySparkException):
        spark.read.parquet(files[0].rsplit("/", 1)[0]).count()


def test_a_shared_folder_is_asked_for():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"getCheckpointDir": lambda self: None})()

    with pytest.raises(ValueError, match="checkpoint"):
        tables.shared_folder(Session())
