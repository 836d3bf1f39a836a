import os
import re
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import types as T
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tests.conftest import case_rows, raw_row, same_rows, table_rows, write_json_array
from vigia.model import DIMENSION_SCHEMAS, RAW_CASE_SCHEMA, Vocabulary
from vigia.plans.etl import derived_columns
from vigia.sources import landing
from vigia.sources.files import read_head
from vigia.sources.landing import audit, count_lines, land_snapshot, land_tables
from vigia.sources.readers import (
    latest_snapshot,
    read_cases,
    read_csv,
    read_json_array,
    read_latest,
    read_table,
    unfitting_values,
)
from vigia.sources.scratch import scratch_path, scratch_root
from vigia.sources.writers import deal, flat_columns, publish, save_if_any, save_result, write_cases, write_csv


def stamp(path, seconds):
    os.utime(path, (seconds, seconds))


def test_newest_file_is_read_whatever_its_name(spark, tmp_path):
    write_json_array(tmp_path / "a" / "20240101_000000.json", [raw_row(id_de_caso="new")])
    write_json_array(tmp_path / "a" / "20250101_000000.json", [raw_row(id_de_caso="old"), raw_row(id_de_caso="old")])
    stamp(tmp_path / "a" / "20240101_000000.json", 2_000_000)
    stamp(tmp_path / "a" / "20250101_000000.json", 1_000_000)
    assert [r.id_de_caso for r in read_latest(spark, str(tmp_path / "a"), RAW_CASE_SCHEMA).collect()] == ["new"]
    # Equal times: the later name.
    stamp(tmp_path / "a" / "20250101_000000.json", 2_000_000)
    assert latest_snapshot(spark, str(tmp_path / "a")).endswith("20250101_000000.json")


def test_csv_and_unknown_and_missing(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.csv").write_text("id,n\na,1\nb,2\n")
    assert read_latest(spark, str(tmp_path / "c")).dtypes == [("id", "string"), ("n", "int")]
    assert read_csv(spark, str(tmp_path / "c" / "x.csv")).dtypes == [("id", "string"), ("n", "string")]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.txt").write_text("?")
    with pytest.raises(ValueError, match="x.txt"):
        read_latest(spark, str(tmp_path / "t"))
    (tmp_path / "empty").mkdir()
    for name in ("empty", "absent"):
        with pytest.raises(FileNotFoundError):
            read_latest(spark, str(tmp_path / name))


def test_json_array_and_single_object(spark, tmp_path):
    write_json_array(tmp_path / "many.json", [{"a": 1}, {"a": 2}])
    write_json_array(tmp_path / "one.json", {"a": 3})
    assert table_rows(read_json_array(spark, str(tmp_path / "many.json"))) == [(1,), (2,)]
    assert table_rows(read_json_array(spark, str(tmp_path / "one.json"))) == [(3,)]


def test_landed_snapshots(spark, tmp_path, dimensions):
    zone = str(tmp_path)
    first = spark.range(5)
    land_snapshot(first, zone, "d", datetime(2024, 1, 1))
    folder = land_snapshot(spark.range(7), zone, "d", datetime(2024, 1, 2, 3, 4, 5))
    assert folder.endswith("d/snapshot=20240102_030405")
    assert read_latest(spark, f"{zone}/d").count() == 7
    landed = land_tables(dimensions, zone, "mysql/")
    assert table_rows(landed) == [("departamentos", 5), ("hospitales", 4), ("municipios", 4)]
    name = "municipios"
    assert same_rows(dimensions[name], read_latest(spark, f"{zone}/mysql/{name}", DIMENSION_SCHEMAS[name]))


def test_line_counts(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.csv").write_text("h\n1\n2\n")
    (tmp_path / "f" / "b.csv").write_text("h\n")
    counts = count_lines(spark, str(tmp_path / "f"))
    assert sorted(r.registros for r in counts.collect()) == [0, 2]
    assert count_lines(spark, str(tmp_path / "f"), header_lines=9).agg(F.max("registros")).first()[0] == 0
    assert table_rows(audit({"x": counts})) == [("x", 2)]


def test_cases_by_period(spark, tmp_path):
    root = str(tmp_path / "cases")
    cases = case_rows(spark, 900)
    assert write_cases(cases, root) == 900
    back = read_cases(spark, root)
    assert same_rows(cases, back)
    some = read_cases(spark, root, (2020, 3), (2021, 2))
    expected = cases.filter("(anio_reporte = 2020 AND mes_reporte >= 3) OR (anio_reporte = 2021 AND mes_reporte <= 2)")
    assert some.count() == expected.count() > 0
    assert re.search(r"PartitionFilters: \[[^\]]*anio_reporte", some._jdf.queryExecution().executedPlan().toString())
    # One file per month: the rows of a month were brought together.
    files = back.select(F.input_file_name()).distinct().count()
    assert files == back.select("anio_reporte", "mes_reporte").distinct().count()
    # Dynamic overwrite keeps the other months.
    write_cases(cases.filter("anio_reporte = 2020 AND mes_reporte = 1").limit(3), root, replace_only_present=True)
    kept = cases.filter("NOT (anio_reporte = 2020 AND mes_reporte = 1)").count()
    assert read_cases(spark, root).count() == kept + 3


def test_results_as_parquet_and_csv(spark, tmp_path):
    df = spark.createDataFrame([("a ", 1, [1.0, 2.0]), (" b", 2, [3.0, 4.0])], "k string, n bigint, xs array<double>")
    df = df.withColumn("features", array_to_vector("xs"))
    assert flat_columns(df) == ["k", "n"]
    assert save_result(df, str(tmp_path), "r") == 2
    assert len(list((tmp_path / "r.csv").glob("part-*.csv"))) == 1
    assert table_rows(read_csv(spark, str(tmp_path / "r.csv"))) == [(" b", "2"), ("a ", "1")]
    assert spark.read.parquet(str(tmp_path / "r.parquet")).columns == df.columns
    save_result(spark.range(0, 100, 1, 4), str(tmp_path), "many", one_file=False)
    assert len(list((tmp_path / "many.csv").glob("part-*.csv"))) > 1


def test_absent_and_empty_results_are_not_written(spark, tmp_path):
    assert save_if_any(spark, None, str(tmp_path), "none") is None
    assert save_if_any(spark, spark.range(0), str(tmp_path), "empty") is None
    assert save_if_any(spark, spark.range(2), str(tmp_path), "some") == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["some.csv", "some.parquet"]


def test_publishing_replaces_contents(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(5), "vigia_test_publish", path)
    publish(spark.range(2), "vigia_test_publish", path)
    assert spark.table("vigia_test_publish").count() == 2
    spark.sql("DROP TABLE vigia_test_publish")


def test_a_load_that_fails_leaves_the_contents(spark, tmp_path):
    path, name = str(tmp_path / "t"), "vigia_test_swap"
    publish(spark.range(5), name, path)
    reader = spark.table(name)  # somebody who has begun to read
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no luck")).cast("bigint")).alias("id"))
    with pytest.raises(Exception, match="no luck"):
        publish(broken, name, path)
    assert spark.table(name).count() == 5
    first = publish(spark.range(2), name, path)
    assert reader.count() == 5 and spark.table(name).count() == 2
    publish(spark.range(3), name, path)
    last = publish(spark.range(4).withColumn("more", F.lit("it's")), name, path)
    assert table_rows(spark.table(name), "id", "more") == [(0, "it's"), (1, "it's"), (2, "it's"), (3, "it's")]
    assert not (tmp_path / "t" / first.rpartition("/")[2]).exists() and len([p for p in (tmp_path / "t").iterdir() if (p / "_SUCCESS").exists()]) == 2
    assert spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"].endswith(last.rpartition("/")[2])
    spark.sql(f"DROP TABLE {name}")


def scanned_rows(df):
    """Rows that the scans of a query gave on, after it has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, waiting = 0, [plan]
    while waiting:
        node = waiting.pop()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
        if "Scan parquet" in node.nodeName():
            found += node.metrics().apply("numOutputRows").value()
    return found


def test_row_groups_without_the_department_or_id_are_skipped(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("CAST(xxhash64(id) AS STRING) AS id_caso", "CAST(pmod(xxhash64(id, 1), 20) AS STRING) AS codigo_departamento",
                                          "CAST(2020 + id % 2 AS INT) AS anio_reporte", "CAST(id % 2 AS INT) AS mes_reporte", "repeat(CAST(id AS STRING), 9) AS other")
    options = {"parquet.block.size": "65536", "parquet.page.size": "4096"}
    assert write_cases(rows, str(tmp_path / "c"), options=options) == 60_000
    cases = read_cases(spark, str(tmp_path / "c"))
    one = cases.filter("codigo_departamento = '7'")
    assert one.count() == rows.filter("codigo_departamento = '7'").count()
    assert scanned_rows(one) < 15_000
    wanted = rows.first()["id_caso"]
    assert cases.filter(F.col("id_caso") == wanted).count() == 1
    # The Bloom filters: ids are in order only within a department.
    assert scanned_rows(cases.filter(F.col("id_caso") == wanted)) < 15_000
    # Another query is not served fewer rows.
    assert cases.agg(F.sum("mes_reporte")).first()[0] == 30_000


def test_pages_beside_lines(spark, tmp_path):
    folder = complete(tmp_path / "d" / "snapshot=20240101_000000")
    (folder / "a.json").write_text('{"a": 1}\n{"a": 2}\n')
    write_json_array(folder / "b.json", [{"a": 3}, {"a": 4}])
    (folder / "c.json").write_text('\n  {\n "a":\n 5}')
    (folder / "d.json").write_text('{"a": 6, "b": "' + "x" * 10_000 + '"}\n{"a": 7}')
    (folder / "e.json").write_text("")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert [r.a for r in read_latest(spark, str(tmp_path / "d"), schema).orderBy("a").collect()] == [1, 2, 3, 4, 5, 6, 7]


def test_landed_lists_are_compressed_and_cut_by_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "FILE_RECORDS", 300)
    rows = spark.range(1000).coalesce(1).select(F.col("id").alias("a"), F.lit("x" * 200).alias("b"))
    folder = Path(land_snapshot(rows, str(tmp_path), "d", datetime(2024, 1, 1)))
    files = sorted(folder.glob("part-*"))
    assert len(files) == 4 and all(f.name.endswith(".json.gz") for f in files)
    assert sum(f.stat().st_size for f in files) < 1000 * 200 / 5
    read = read_latest(spark, str(tmp_path / "d"), T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())]))
    assert table_rows(read, "a") == table_rows(rows, "a")
    assert [r.registros for r in count_lines(spark, str(folder), header_lines=0).orderBy("registros").collect()] == [100, 300, 300, 300]
    # What tells lines from pages is read from the contents, not from the compressed bytes.
    assert read_head(spark, str(files[0]), 5) == b'{"a":'


def test_values_that_do_not_fit_are_counted(spark, tmp_path):
    folder = complete(tmp_path / "d" / "snapshot=20240101_000000")
    (folder / "part-0.csv").write_text("Region,codigo_dane,extra,id_departamento,poblacion_2020\nR,05,x,5,many\nS,11,y,z,\nT,12,y,z,7\n")
    schema = DIMENSION_SCHEMAS["departamentos"]
    assert unfitting_values(spark, str(tmp_path / "d"), schema) == {"id_departamento": 2, "poblacion_2020": 1}
    write_json_array(complete(tmp_path / "e" / "snapshot=20240101_000000") / "a.json", [{"region": "R"}])
    assert unfitting_values(spark, str(tmp_path / "e"), schema) == {}


def test_scratch_folder_is_stable_within_a_session(spark):
    assert scratch_root(spark) == scratch_root(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_relational_reads_need_bounds(spark):
    with pytest.raises(ValueError, match="bounds"):
        read_table(spark, "jdbc:x:y", "t", column="id")


def test_csv_keeps_blanks(spark, tmp_path):
    write_csv(spark.createDataFrame([(" x ",)], "v string"), str(tmp_path / "b"))
    assert read_csv(spark, str(tmp_path / "b")).first().v == " x "


def complete(folder):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "_SUCCESS").touch()
    return folder


def test_all_pages_of_a_snapshot_are_read(spark, tmp_path):
    folder = complete(tmp_path / "d" / "snapshot=20240101_000000")
    write_json_array(folder / "page1.json", [{"a": 1}, {"a": 2}])
    write_json_array(folder / "page2.json", [{"a": 3}])
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert table_rows(read_latest(spark, str(tmp_path / "d"), schema)) == [(1, None), (2, None), (3, None)]


def test_unfinished_snapshots_and_unreadable_records(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType())])
    (complete(tmp_path / "d" / "snapshot=20240101_000000") / "part-0.json").write_text('{"a": 1}\n')
    half = tmp_path / "d" / "snapshot=20240202_000000"
    half.mkdir()
    (half / "part-0.json").write_text('{"a": 2}\n')
    assert table_rows(read_latest(spark, str(tmp_path / "d"), schema)) == [(1,)]
    (complete(half) / "part-1.json").write_text("{broken\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_latest(spark, str(tmp_path / "d"), schema).collect()


def test_csv_columns_are_matched_by_header(spark, tmp_path):
    folder = complete(tmp_path / "d" / "snapshot=20240101_000000")
    (folder / "part-0.csv").write_text("Region,codigo_dane,extra,id_departamento\nR,05,x,5\nS,11,y,z\n")
    df = read_latest(spark, str(tmp_path / "d"), DIMENSION_SCHEMAS["departamentos"])
    assert df.schema == DIMENSION_SCHEMAS["departamentos"]
    assert table_rows(df, "codigo_dane", "region", "id_departamento", "capital") == [("05", "R", 5, None), ("11", "S", None, None)]


def test_column_that_is_null_throughout(spark, tmp_path, dimensions):
    emptied = dimensions["municipios"].withColumn("categoria", F.lit(None).cast("string"))
    land_snapshot(emptied, str(tmp_path), "m", datetime(2024, 1, 1))
    df = read_latest(spark, str(tmp_path / "m"), DIMENSION_SCHEMAS["municipios"])
    assert df.columns == emptied.columns and df.count() == emptied.count()


def test_stale_results_go(spark, tmp_path):
    assert save_if_any(spark, spark.range(3), str(tmp_path), "r") == 3
    assert save_if_any(spark, spark.range(0), str(tmp_path), "r") is None
    assert not (tmp_path / "r.parquet").exists() and not (tmp_path / "r.csv").exists()


def test_derived_columns_do_not_cross_the_network(spark, tmp_path):
    columns = derived_columns(Vocabulary())
    cases = case_rows(spark, 900)
    plain = cases.drop(*columns)
    dealt = deal(plain, ["anio_reporte", "mes_reporte"], columns)
    below = dealt._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")[1]
    assert "anio_reporte" in below and not any(c in below for c in set(columns) - {"anio_reporte", "mes_reporte"})
    assert write_cases(plain, str(tmp_path / "a"), derived=columns) == write_cases(cases, str(tmp_path / "b")) == 900
    one, other = read_cases(spark, str(tmp_path / "a")), read_cases(spark, str(tmp_path / "b"))
    assert one.dtypes == other.dtypes and same_rows(one, other)
    assert one.select(F.input_file_name()).distinct().count() == other.select(F.input_file_name()).distinct().count()
