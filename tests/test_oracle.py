"""Every query with a SQL twin gives the same rows, types and values in both engines."""

import os

import duckdb
import pytest

from tidemark.plans import registry

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_same_as_sql(key, spark, sf_dir, database):
    result = QUERIES[key](spark, sf_dir)
    names = sorted(result.columns)
    relation = database.sql(ORACLE[key])
    assert sorted(relation.columns) == names
    expected_types = dict(zip(relation.columns, (str(t) for t in relation.types)))
    assert {name: TYPES[kind] for name, kind in result.dtypes} == expected_types
    expected = database.execute(f"SELECT {', '.join(names)} FROM ({ORACLE[key]})").fetchall()
    actual = [tuple(row) for row in result.select(*names).collect()]
    assert ordered(actual) == ordered(expected)


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    without = set(QUERIES) - set(ORACLE)
    assert without == {
        "kmeans_k_sweep",
        "kmeans_segments",
        "churn_lr",
        "churn_rf",
        "churn_gbt",
        "churn_cv",
        "feature_importance",
        "best_model",
        "churn_scored",
        "ltv_model",
        "ltv_scored",
        "customer_master",
    }
