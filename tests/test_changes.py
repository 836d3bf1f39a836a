"""Differences of snapshots, and cases brought up to date by them."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import table_rows
from tests.test_pipeline import raw_records
from vigia.model import RAW_CASE_SCHEMA
from vigia.operators.changes import snapshot_changes
from vigia.plans.etl import clean_cases, derive_cases, enrich_cases
from vigia.plans import pipeline
from vigia.plans.pipeline import cleaned_list, refresh_cases
from vigia.sources.writers import write_cases

SCHEMA = "k int, a string, b string"


def test_kinds_of_change(spark):
    old = [(1, "x", "y"), (2, "x", None), (3, "q", "q"), (4, "m", "n"), (4, "m", "n"), (None, "n", "n"), (6, "u", "v"), (6, "s", "t"), (7, "d", "d"), (7, "d", "d")]
    new = [(1, "x", "y"), (2, None, "x"), (5, "z", "z"), (4, "m", "n"), (None, "o", "n"), (6, "s", "t"), (6, "u", "v"), (7, "e", "e"), (7, "e", "e")]
    before, now = (spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (old, new))
    got = {r.k: (r.cambio, r.a_antes, r.a_ahora) for r in snapshot_changes(before, now, ["k"], carried=["a"]).collect()}
    assert got == {2: ("cambiado", "x", None), 3: ("retirado", "q", None), 4: ("cambiado", "m", "m"), 5: ("nuevo", None, "z"),
                   None: ("cambiado", "n", "o"), 7: ("cambiado", "d", "e")}
    assert snapshot_changes(now, now, ["k"]).isEmpty() and snapshot_changes(now.limit(0), now.limit(0), ["k"]).isEmpty()
    with pytest.raises(ValueError, match="b"):
        snapshot_changes(before.drop("b"), now, ["k"])


def test_one_shuffle_without_a_join(spark):
    df = spark.createDataFrame([(1, "x", "y")], SCHEMA)
    plan = snapshot_changes(df, df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def listed(spark, records):
    return spark.createDataFrame([tuple(r.values()) for r in records], RAW_CASE_SCHEMA)


def files_of(root):
    found = Counter()
    for folder, _, names in os.walk(root):
        for name in names:
            if name.endswith(".parquet"):
                found[os.path.relpath(folder, root), name, os.stat(os.path.join(folder, name)).st_mtime_ns] += 1
    return found


def test_only_touched_months_are_written(spark, tmp_path, dimensions):
    newer = list(raw_records(400))
    older = []
    for i, r in enumerate(newer):
        r = dict(r)
        if i == 8:  # changes in 2020-01
            r["estado"] = "Otro"
        if i == 13:  # moves from 2021-07 to 2021-02
            r.update(fecha_reporte_web="2021-07-01 00:00:00")
        if i != 24:  # new in 2020-01
            older.append(r)
    older.append(dict(newer[0], id_de_caso="gone", fecha_reporte_web="sin fecha"))  # the only case without a date
    old, new = listed(spark, older), listed(spark, newer)

    def trusted(raw):
        return derive_cases(enrich_cases(clean_cases(raw), dimensions["departamentos"], dimensions["municipios"], dimensions["hospitales"]))

    root, whole = str(tmp_path / "cases"), str(tmp_path / "whole")
    write_cases(trusted(old), root)
    before = files_of(root)
    months = refresh_cases(spark, old, new, dimensions, root)
    assert set(months) == {(None, None), (2020, 1), (2021, 7), (2021, 2)}
    write_cases(trusted(new), whole)
    got, want = spark.read.parquet(root), spark.read.parquet(whole)
    assert table_rows(got.select(*want.columns)) == table_rows(want)
    kept = before & files_of(root)
    folders = {k[0] for k in kept}
    assert folders == {k[0] for k in before} - {"anio_reporte=2020/mes_reporte=1", "anio_reporte=2021/mes_reporte=2", "anio_reporte=2021/mes_reporte=7",
                                                "anio_reporte=__HIVE_DEFAULT_PARTITION__/mes_reporte=__HIVE_DEFAULT_PARTITION__"}
    assert not os.path.exists(f"{root}/anio_reporte=2021/mes_reporte=7")
    assert refresh_cases(spark, new, new, dimensions, root) == [] and files_of(root) - kept
    assert got.filter(F.col("id_caso") == "gone").isEmpty()


def test_a_cleaned_list_is_not_cleaned_again(spark, tmp_path, dimensions, monkeypatch):
    records = [r | {"fecha_reporte_web": f"2020-0{1 + k % 4}-05"} for k, r in enumerate(raw_records(120))]
    old = spark.createDataFrame(records, RAW_CASE_SCHEMA)
    new = old.withColumn("estado", F.when(F.col("id_de_caso") == "7", F.lit("Otro")).otherwise(F.col("estado")))
    roots, before, found = [str(tmp_path / n) for n in ("raw", "clean")], cleaned_list(old), []
    for root in roots:
        write_cases(derive_cases(enrich_cases(before.drop("__period"), *dimensions.values())), root)
    calls = []
    monkeypatch.setattr(pipeline, "clean_cases", lambda *a: calls.append(1) or clean_cases(*a))
    for root, given in zip(roots, (old, before), strict=True):
        months = refresh_cases(spark, given, new, dimensions, root)
        found.append((months, len(calls), table_rows(spark.read.parquet(root))))
    assert found[0][0] == found[1][0] and len(found[0][0]) == 1 and found[0][2] == found[1][2]
    assert (found[0][1], found[1][1]) == (2, 3)
