"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from workloads import oracle, registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["lineitem", "events"]
QUERIES, ORACLE = registry.QUERIES, oracle.ORACLE

# Fitting boosted trees takes long; tests/test_forecast.py and tests/test_jobs.py cover it.
SLOW = {"end_to_end_run"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def rows(df: pd.DataFrame) -> list[tuple]:
    def value(v):
        if v is None or pd.isna(v):
            return None
        return str(v) if isinstance(v, pd.Timestamp) else v

    ordered = df[sorted(df.columns)]
    return sorted((tuple(map(value, r)) for r in ordered.itertuples(index=False)), key=repr)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {
        "train_model", "score_predictions", "feature_importance", "end_to_end_run",
    }


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE and n not in SLOW])
def test_query_agrees_with_sql(spark, database, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    expected = database.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert len(got) > 0
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_query_without_sql_yields_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_contract_lists_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 65 and df.count() == 397
