import pytest

from __spark_entry__ import oracle_sql, queries
from check_oracle import compare, connect
from shiftloom.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    assert oracle_sql()[name] == SQL[name]
    assert compare(queries()[name](spark, FOLDER), connect(FOLDER), SQL[name]) == []


def test_one_query_for_each_operator_and_the_pipeline():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())
