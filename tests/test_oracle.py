"""Every registered query against its DuckDB SQL on sf0.001 (the driver
checks sf0.01 the same way; ``python tests/oracle_check.py`` runs that)."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck
from sparkcount.plans import catalog
from conftest import SF001

# the library's own operators; the optional subpackage has its own tests
QUERIES = {k: f for k, f in E.queries().items() if k in catalog.queries()}
SQL = {k: q for k, q in E.oracle_sql().items() if k in QUERIES}


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL[name], SF001)
    assert r["rows_ok"], r
    assert r["cols_ok"], r
    assert r["hash_ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["triangles"]
    assert df.collect()[0][0] == 7852


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, con, name):
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in QUERIES[name](spark, SF001).schema.fields}
    rel = con.sql(SQL[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert spark_types == duck_types
