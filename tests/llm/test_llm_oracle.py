"""The registered queries: against their SQL where there is one, and plans of native ones."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as driver
from tallyline.llm import queries

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(
    not pathlib.Path(SF_DIR).is_dir(), reason="driver tables not present"
)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_oracle(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "conversations", "embeddings"):
        duck.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    df = driver.queries()[name](spark, SF_DIR)
    result = duck.execute(driver.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    order = [names.index(column) for column in df.columns]
    expected = [tuple(row[i] for i in order) for row in result.fetchall()]
    actual = [tuple(row) for row in df.collect()]
    assert actual and sorted(actual, key=repr) == sorted(expected, key=repr)


def test_every_operator_has_a_query():
    numbers = {name.split("_")[0] for name in queries.queries()}
    assert numbers == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", ["op1_url_filters", "op9_chat_formatting", "op10_quality_rules"])
def test_native_queries_run_no_python_and_no_pairs(spark, name):
    plan = driver.queries()[name](spark, SF_DIR)._jdf.queryExecution().toString()
    for node in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"):
        assert node not in plan
