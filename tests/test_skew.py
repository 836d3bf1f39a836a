"""Right results when a third of all rows share a key, and with orphans and NULL keys."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tests.conftest import SMALL
from tools.check_oracle import TABLES, compare

CHANGES = {
    "lineitem": """SELECT CASE WHEN i % 3 = 0 THEN 7 WHEN i % 101 = 0 THEN NULL WHEN i % 103 = 0 THEN 99999999 ELSE l_orderkey END AS l_orderkey,
                          CASE WHEN i % 3 = 1 THEN 5 WHEN i % 107 = 0 THEN NULL ELSE l_partkey END AS l_partkey,
                          CASE WHEN i % 2 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey,
                          * EXCLUDE (i, l_orderkey, l_partkey, l_suppkey)
                   FROM (SELECT *, row_number() OVER () AS i FROM '{path}')""",
    "orders": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 3 WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
                        * EXCLUDE (o_orderkey, o_custkey)
                 FROM '{path}'""",
    "customer": """SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN 4 WHEN c_custkey % 19 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
                          c_acctbal, c_mktsegment
                   FROM '{path}'""",
}
NAMES = (
    "temporal_monthly", "geo_department", "geo_region", "geo_municipality_top50", "infra_capacity", "kpis", "by_location",
    "severity_index", "attack_rate", "age_region", "cumulative_cases", "age_top_departments", "recovery_by_source",
    "rank_departments", "critical_municipalities", "consolidated", "dedup_cases", "join_any", "join_first_match",
    "coverage", "pk_fk_check", "group_features",
)
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.files.openCostInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    db = duckdb.connect()
    for table in TABLES:
        select = CHANGES.get(table, "SELECT * FROM '{path}'").format(path=f"{SMALL}/{table}.parquet")
        db.execute(f"COPY ({select}) TO '{folder}/one_{table}.parquet' (FORMAT parquet)")
        # Several files, hence several map tasks: a partition is split between their outputs.
        spark.read.parquet(f"{folder}/one_{table}.parquet").repartition(8).write.parquet(f"{folder}/{table}.parquet")
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/one_{table}.parquet'")
    previous = {key: spark.conf.get(key) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield folder, db
    for key, value in previous.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys_orphans_and_nulls(spark, skewed, name):
    folder, db = skewed
    assert compare(queries()[name](spark, folder), db, oracle_sql()[name]) == ""


def test_hot_order_is_split_at_run_time(spark, skewed):
    """Reports with keys of the line and of the order join unfolded lines; their hot key is split."""
    folder, _ = skewed
    df = queries()["attack_rate"](spark, folder)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
