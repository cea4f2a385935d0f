"""Every named query against its SQL on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from entity360.oracle import ORACLE_SQL
from entity360.registry import QUERIES, run

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = run(name, spark, FOLDER)
    rel = duck.sql(ORACLE_SQL[name])
    kinds = {c: str(t) for c, t in zip(rel.columns, rel.types, strict=True)}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == kinds
    columns = sorted(df.columns)
    places = [rel.columns.index(c) for c in columns]
    want = sorted(repr(tuple(row[i] for i in places)) for row in rel.fetchall())
    got = sorted(repr(tuple(row)) for row in df.select(*columns).collect())
    assert got == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_entry_runs(spark):
    df = driver.entry(spark)
    assert len(df.columns) == 81 and df.count() > 0


def test_oracle_states_the_same_expectations_on_its_own():
    from entity360 import oracle
    from entity360.operators import quality

    for name in ("NOT_NULL", "ACCEPTED", "UNIQUE", "UNIQUE_COMBINATION", "RELATED"):
        assert getattr(oracle, f"_{name}") == getattr(quality, name)
