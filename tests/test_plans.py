"""Plans stay the ones that hold at scale."""

import re

import pytest

from tests.conftest import SMALL, same_rows, table_rows
from vigia.bindings import queries, star
from vigia.bindings.queries import DATASET_QUERIES, MODEL_QUERIES, PLAIN_QUERIES, QUERIES

# Queries that run jobs or write before they return are left out.
RUNNING = {"national_cumulative", "national_cumulative_municipality"}
WRITING = {"parquet_partitioned", "csv_roundtrip", "csv_result", "json_latest", "publish_table", "landing_audit",
           "stage_counts", "snapshot_by_stamp", "csv_dimensions", "empty_dimension", "department_cases", "snapshot_changes",
           "incremental_trusted", "auc_by_ranks", "age_ranks", *RUNNING, *MODEL_QUERIES}


@pytest.fixture()
def large(spark):
    """Plan as if no table were small enough to broadcast."""
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def plan(spark, name):
    text = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_nested_loops_no_python(large, name):
    text = plan(large, name)
    for bad in ("NestedLoop", "CartesianProduct", "Python", "Pandas", "ArrowEval"):
        assert bad not in text


@pytest.mark.parametrize("name", sorted({*DATASET_QUERIES, *PLAIN_QUERIES} - RUNNING))
def test_cases_are_read_once(large, name):
    assert plan(large, name).count("lineitem.parquet") == 1


def test_joins_and_columns_follow_the_report(large):
    text = plan(large, "by_status")
    assert "orders.parquet" not in text and "customer.parquet" not in text and "part.parquet" in text
    assert "Join" not in plan(large, "demo_sex").replace("SortMergeJoin [l_partkey], [p_partkey]", "")
    scan = re.search(r"FileScan parquet \[([^\]]*)\].*lineitem", plan(large, "temporal_monthly"))
    assert scan[1] == "l_orderkey,l_returnflag"


def test_lines_are_folded_before_the_order_join(large):
    text = plan(large, "temporal_monthly")
    below = text[text.index("SortMergeJoin [l_orderkey]"):]
    assert re.search(r"keys=\[l_orderkey\].*\n.*Exchange hashpartitioning\(l_orderkey.*\n.*partial_sum", below)
    # ... and orders by customer where the report has no column of the order.
    assert "keys=[o_custkey]" in plan(large, "geo_department")


def test_only_one_row_per_group_enters_single_partitions(large):
    for name in ("rank_departments", "cumulative_cases"):
        text = plan(large, name)
        assert "SinglePartition" in text
        assert text.index("SinglePartition") < text.index("partial_sum")


def test_top_is_cut_in_each_task(large):
    text = plan(large, "cumulative_cases")
    assert text.index("10, Final") < text.index("SinglePartition") < text.index("10, Partial")
    assert "TakeOrderedAndProject" in plan(large, "geo_municipality_top50")


def test_filters_reach_the_scan(large):
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in plan(large, "temporal_monthly")


@pytest.mark.parametrize("name", sorted(RUNNING))
def test_running_totals_need_no_single_partition(large, name):
    text = plan(large, name)
    assert "SinglePartition" not in text and "NestedLoop" not in text
    assert re.search(r"Exchange hashpartitioning\(__range", text)


@pytest.fixture()
def many_customers(spark):
    """Plan as if the customers were so many that Spark's guess of the department dimension is beyond what it broadcasts."""
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1MB")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_cases_are_not_shuffled_for_a_few_departments(many_customers, monkeypatch):
    written = []

    def write(df, root, **options):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return write_cases(df, root, **options)

    write_cases = queries.write_cases
    monkeypatch.setattr(queries, "write_cases", write)
    counts = dict(table_rows(QUERIES["stage_counts"](many_customers, SMALL)))
    assert counts["leidos"] >= counts["limpios"] > 0 and counts["enriquecidos"] >= counts["limpios"]
    assert "SortMergeJoin" not in written[0] and written[0].count("BroadcastHashJoin") == 2


def test_stored_departments_are_the_departments(spark, tmp_path):
    folder = str(tmp_path)
    rows = {
        "nation": [(1, "A", 1), (2, None, 2), (None, "C", None), (1, "A", 1), (30, "D", 9)],
        "region": [(1, "R"), (2, None)],
        "customer": [(1, "x", 1, 0.0, "s"), (2, "y", 1, 0.0, "s"), (3, "z", None, 0.0, "s")],
    }
    for name, data in rows.items():
        spark.createDataFrame(data, star.TABLES[name]).write.parquet(f"{folder}/{name}.parquet")
    stored, plain = star.stored_departments(spark, folder), star.departments(spark, folder)
    assert stored.dtypes == plain.dtypes and stored.count() == 5 and same_rows(stored, plain)
