"""Every registered query that has SQL, against DuckDB on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import LLM_ORACLE, LLM_QUERIES, entry, oracle_sql, queries
from tests.conftest import SMALL
from tools.check_oracle import TABLES, compare


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - set(LLM_ORACLE)))
def test_same_rows_as_sql(spark, db, name):
    assert compare(queries()[name](spark, SMALL), db, oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry(spark).count() > 0


def test_only_models_have_no_sql():
    assert set(oracle_sql()) <= set(queries())
    assert set(queries()) - set(oracle_sql()) - set(LLM_QUERIES) == {
        "mortality_model", "mortality_model_without_location", "severity_model", "hospitalization_model",
        "feature_importance", "ml_metrics", "cluster_departments", "cluster_departments_profile",
        "cluster_groups", "cluster_groups_profile",
    }
