import pytest

from vigia.model import Thresholds
from vigia.plans import views


@pytest.fixture(scope="module")
def tables(spark):
    departments = spark.createDataFrame(
        [("A", "Andina", 1000, 100, 5, 10000.0, 5.0), ("B", "Andina", 500, 80, 1, 16000.0, 1.25),
         ("C", None, None, 60, 0, None, 0.0), (None, "Caribe", 100, 40, 1, float("nan"), 2.5)],
        "nombre_departamento string, region string, poblacion_departamento int, total_casos bigint, "
        "fallecidos bigint, casos_por_100k double, tasa_letalidad double")
    regions = spark.createDataFrame(
        [("Andina", 180, 6), ("Caribe", 40, 1), (None, 60, 0), ("null", 1, 0), ("", 2, 0)],
        "region string, total_casos bigint, fallecidos bigint")
    summary = spark.createDataFrame([(280, 7, 2.5)], "total_casos bigint, total_fallecidos bigint, tasa_letalidad_general double")
    return departments, regions, summary


def test_consolidated(tables):
    departments, regions, summary = tables
    rows = views.consolidated(departments, regions, summary).collect()
    assert [(r.nombre_departamento, r.casos_region, r.casos_nacional) for r in rows] == [
        ("A", 180, 280), ("B", 180, 280), ("C", None, 280), (None, 40, 280)]
    only = views.consolidated(departments, regions, summary, region="Andina", limit=1).collect()
    assert [r.nombre_departamento for r in only] == ["A"]


def test_arguments_are_values_not_sql(tables):
    departments, regions, summary = tables
    text = "x' OR '1' = '1"
    assert views.department_detail(departments, text).isEmpty()
    assert views.consolidated(departments, regions, summary, region=text).isEmpty()
    assert views.department_detail(departments, "A").count() == 1


def test_dashboard_fills_gaps(tables):
    departments, regions, _ = tables
    rows = {r.nombre_departamento: r for r in views.dashboard(departments, regions).collect()}
    assert rows["C"].region == "Sin región" and rows["C"].casos_region == 0 and rows["C"].casos_por_100k == 0.0
    assert rows["N/A"].casos_por_100k == 0.0 and rows["N/A"].letalidad_region == 2.5
    table = views.ranked_table(views.dashboard(departments, regions), Thresholds()).collect()
    assert [(r.posicion, r.nombre_departamento, r.nivel) for r in table] == [
        (1, "A", "badge-high"), (2, "N/A", "badge-medium"), (3, "B", "badge-low"), (4, "C", "badge-low")]


def test_small_views(tables):
    departments, regions, summary = tables
    assert [r.region for r in views.region_distribution(regions).collect()] == ["Andina", "Caribe"]
    assert views.kpis(summary).count() == 1
    comparison = {r.region: r for r in views.region_comparison(departments).collect()}
    assert comparison["Andina"].num_departamentos == 2 and comparison["Andina"].casos_promedio == 90.0
    assert round(comparison["Andina"].letalidad_regional, 4) == 3.3333
    affected = views.affected_population(departments, 2).collect()
    assert [(r.nombre_departamento, r.porcentaje_afectado) for r in affected] == [(None, 40.0), ("B", 16.0)]
    assert views.top_cfr(departments, 1).first().nombre_departamento == "A"
    assert len(views.CATALOGUE) == 13


def test_temporal_limit(spark):
    months = spark.createDataFrame([(2021, 2, 5), (2020, 12, 9), (2021, 1, 7)], "anio_reporte int, mes_reporte int, total_casos int")
    assert [r.mes_reporte for r in views.temporal(months).collect()] == [12, 1, 2]
    assert views.temporal(months, 1).count() == 1
    assert [r.periodo for r in views.with_period(views.temporal(months)).collect()] == ["2020-12", "2021-01", "2021-02"]
    assert [r.total_casos for r in views.critical_months(months, 2).collect()] == [9, 7]
