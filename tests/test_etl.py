import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import raw_row, table_rows
from vigia.model import CASE_COLUMNS, DATE_FORMATS, RAW_CASE_SCHEMA, RAW_NAMES, Vocabulary
from vigia.plans.etl import (
    canonical_columns,
    clean_cases,
    derive_cases,
    enrich_cases,
    hospital_capacity,
    unmatched_aliases,
    with_capacity,
    with_department,
    with_municipality,
)


def raw(spark, *rows):
    return spark.createDataFrame([tuple(raw_row(**r).values()) for r in rows], RAW_CASE_SCHEMA)


def test_missing_columns_become_typed_nulls(spark):
    df = canonical_columns(spark.createDataFrame([("1", "x")], "id_caso string, estado string"))
    assert df.columns == list(RAW_NAMES) and set(dict(df.dtypes).values()) == {"string"}
    assert df.first().id_caso == "1" and df.first().sexo is None


def test_first_present_name_wins(spark):
    df = spark.createDataFrame([("a", "b")], "departamento_nom string, nombre_departamento string")
    assert canonical_columns(df).first().nombre_departamento == "b"


def test_csv_headers(spark):
    df = spark.createDataFrame([("2020-03-06", "7", "05")], "`fecha reporte web` string, `ID de caso` string, `Código DIVIPOLA departamento` string")
    row = clean_cases(df).first()
    assert (row.fecha_reporte, row.id_caso, row.codigo_departamento) == (dt.date(2020, 3, 6), "7", "05")


def test_clean_keeps_one_row_per_id_and_needs_a_department(spark):
    df = raw(
        spark,
        dict(id_de_caso="1", fecha_reporte_web="07/03/2020", departamento="5", edad="30", unidad_medida="1"),
        dict(id_de_caso="1", fecha_reporte_web="2020-03-06", departamento="5", edad="31", unidad_medida="1"),
        dict(id_de_caso="2", fecha_reporte_web="junk", departamento=None),
        dict(id_de_caso="3", departamento="11", edad="x", unidad_medida="1"),
    )
    for n in (1, 4, 7):
        got = table_rows(clean_cases(df.repartition(n)), "id_caso", "fecha_reporte", "edad_anios")
        assert got == [("1", dt.date(2020, 3, 6), 31.0), ("3", None, None)]


def test_enriched_and_plain_widths(spark, dimensions):
    cases = clean_cases(raw(spark, dict(id_de_caso="1", departamento="5", ciudad_municipio="5001")))
    plain = derive_cases(enrich_cases(cases, dimensions["departamentos"], None, dimensions["hospitales"]))
    full = derive_cases(enrich_cases(cases, *(dimensions[n] for n in ("departamentos", "municipios", "hospitales"))))
    assert len(plain.columns) == 25 and len(full.columns) == 34
    assert set(full.columns) == set(CASE_COLUMNS)
    row = full.first()
    assert (row.poblacion_departamento, row.region, row.poblacion_municipio, row.num_hospitales,
            row.total_camas_uci, row.total_camas_general) == (6000, "Andina", 2500, 2, 200, 750)


def test_departments_by_code_or_name(spark, dimensions):
    cases = spark.createDataFrame(
        [(1, "5", "X"), (2, "25", "Bogotá"), (3, "8001", " barranquilla "), (4, "99", "LA GUAJIRA")],
        "id int, codigo_departamento string, nombre_departamento string")
    either = with_department(cases, dimensions["departamentos"])
    # 8001 is cut to 80, so the case meets that department and, by its name, another one.
    assert table_rows(either, "id", "poblacion_departamento") == [(1, 6000), (2, 3000), (2, 7000), (3, 0), (3, 2000), (4, None)]
    one = with_department(cases, dimensions["departamentos"], first_match=True)
    assert table_rows(one, "id", "poblacion_departamento") == [(1, 6000), (2, 3000), (3, 0), (4, None)]
    assert "GUAJIRA" in [r[0] for r in unmatched_aliases(dimensions["departamentos"]).collect()]


def test_municipality_codes_and_ids_are_two_systems(spark, dimensions):
    cases = spark.createDataFrame([(1, "05001"), (2, "5088"), (3, "ABC"), (4, None)], "id int, codigo_municipio string")
    assert table_rows(with_municipality(cases, dimensions["municipios"]), "id", "poblacion_municipio") == [
        (1, 2500), (2, 500), (3, None), (4, None)]
    # Code 5088 is BELLO, id 5088 is ITAGUI.
    assert table_rows(with_capacity(cases, dimensions["hospitales"]), "id", "total_camas_uci") == [
        (1, 200), (2, 7), (3, None), (4, None)]
    through = with_capacity(cases, dimensions["hospitales"], dimensions["municipios"])
    assert table_rows(through, "id", "total_camas_uci") == [(1, 200), (2, None), (3, None), (4, None)]
    assert table_rows(hospital_capacity(dimensions["hospitales"])) == [(11001, 1, 90, 500), (5001, 2, 200, 750), (5088, 1, 7, 70)]


def test_outcome_flags_use_the_vocabulary(spark):
    df = spark.createDataFrame([("Fallecido", "Recuperado", 70.0, dt.date(2021, 1, 1))],
                               "estado string, recuperado string, edad_anios double, fecha_reporte date")
    row = derive_cases(df).first()
    assert (row.fallecido, row.recuperado_flag, row.grupo_edad, row.anio_reporte, row.mes_reporte, row.semana_reporte) == (
        1, 1, "65+", 2021, 1, 53)
    assert derive_cases(df, Vocabulary(deceased=("X",))).first().fallecido == 0
    assert derive_cases(df).select(F.col("fallecido")).dtypes == [("fallecido", "int")]


def test_the_usable_duplicate_survives(spark):
    cases = raw(
        spark,
        {"id_de_caso": "7", "fecha_reporte_web": "2020-03-06"},
        {"id_de_caso": "7", "departamento": "5", "fecha_reporte_web": "junk"},
        {"id_de_caso": "7", "departamento": "5", "fecha_reporte_web": "2020-03-07", "sexo": "F"},
        {"id_de_caso": "8", "fecha_reporte_web": "2020-03-06"},
    )
    kept = clean_cases(cases).select("id_caso", "codigo_departamento", "sexo").collect()
    assert [tuple(r) for r in kept] == [("7", "5", "F")]


def test_the_date_parser_stands_once_in_the_plan(spark):
    """Written out for each column it made a method too long to compile."""
    raw = spark.createDataFrame([raw_row(id_de_caso="1", departamento="05", fecha_reporte_web="2020-03-06", fecha_muerte="07/03/2020")], RAW_CASE_SCHEMA)
    cleaned = clean_cases(raw)
    assert cleaned._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") <= len(DATE_FORMATS)
    row = cleaned.first()
    assert (row.fecha_reporte, row.fecha_muerte, row.fecha_diagnostico) == (dt.date(2020, 3, 6), dt.date(2020, 3, 7), None)
