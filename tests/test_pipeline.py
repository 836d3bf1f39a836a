import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import raw_row, table_rows, write_json_array
from vigia.__main__ import main
from vigia.model import Thresholds
from vigia.plans import models, pipeline, views
from vigia.plans.pipeline import Settings, Zones, run_all, run_analytics, run_etl, run_models
from vigia.plans.reports import DATASETS, ROLLUP_OF
from vigia.sources.landing import land_tables

SETTINGS = Settings(Thresholds(month_cases=2, critical_cases=2, critical_per_100k=1.0, recovered_cases=1, cluster_cases=1), trees=2)


def raw_records(number):
    departments = [("5", "ANTIOQUIA", "5001"), ("11", "BOGOTA", "11001"), ("25", "CUNDINAMARCA", "25754"),
                   ("8", "BARRANQUILLA", "8001"), ("77", "NADIE", "77001")]
    for i in range(number):
        code, name, municipality = departments[i % 5]
        day = f"202{i % 2}-0{1 + i % 4}-1{i % 10}"
        yield raw_row(
            id_de_caso=str(i), fecha_reporte_web=f"{day} 00:00:00", fecha_de_notificaci_n=day, departamento=code,
            departamento_nom=name, ciudad_municipio=municipality, ciudad_municipio_nom=f"M{municipality}",
            edad=str(i * 7 % 95), unidad_medida="1", sexo="FM"[i % 2], fuente_tipo_contagio=("Comunitaria", "Importado")[i % 3 == 0],
            ubicacion=("Casa", "Hospital", "UCI")[i * i % 3], estado=("Leve", "Grave", "Moderado", "Fallecido")[(i * i + i // 5) % 4],
            recuperado="Recuperado" if i % 4 else "Activo", fecha_diagnostico=day, fecha_recuperado=day,
            fecha_inicio_sintomas=day, fecha_muerte=None,
        )


@pytest.fixture(scope="module")
def zones(spark, tmp_path_factory, dimensions):
    root = tmp_path_factory.mktemp("zones")
    records = list(raw_records(400))
    write_json_array(root / "raw" / "api" / "casos" / "20240101_000000.json", records + records[:50])
    land_tables(dimensions, str(root / "raw"), "mysql/")
    return Zones(str(root / "raw"), str(root / "trusted"), str(root / "refined"))


def test_whole_run(spark, zones, tmp_path):
    audit = {(r.stage, r.item): r for r in run_all(spark, zones, SETTINGS, tables_root=str(tmp_path)).collect()}
    assert audit["etl", "covid_processed"].rows == 400 and audit["etl", "enriched"].rows == 320
    assert all(audit["analytics", name].status == "ok" for name in DATASETS)
    assert audit["models", "ml_metrics_completas"].rows == 1
    assert audit["models", "predictions_mortality"].rows == audit["models", "predictions_severity"].rows > 0
    for table in pipeline.PUBLISHED:
        assert spark.table(table).count() == audit["analytics", table].rows
        spark.sql(f"DROP TABLE {table}")
    kpis = spark.read.parquet(f"{zones.analytics}/dashboard_kpis.parquet").first()
    assert kpis.total_casos == 400 and kpis.departamentos_afectados == 5
    assert len(spark.read.parquet(zones.cases).columns) == 34
    assert spark.read.parquet(f"{zones.refined}/audit.parquet").count() == len(audit)
    csv = spark.read.option("header", True).csv(f"{zones.models}/clusters_departamentos.csv")
    assert "cluster" in csv.columns and "features" not in csv.columns


def test_rollups_write_what_the_cases_say(spark, zones, tmp_path):
    run_etl(spark, zones, SETTINGS)
    direct = Zones(zones.raw, zones.trusted, str(tmp_path / "direct"))
    summed = Zones(zones.raw, zones.trusted, str(tmp_path / "summed"))
    run_analytics(spark, direct, Settings(SETTINGS.thresholds, use_rollups=False, extra_reports=True))
    run_analytics(spark, summed, Settings(SETTINGS.thresholds, extra_reports=True))
    for name in DATASETS:
        left, right = (spark.read.parquet(f"{z.analytics}/{name}.parquet") for z in (direct, summed))
        assert left.schema == right.schema
        columns = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in left.dtypes]
        assert table_rows(left.select(*columns)) == table_rows(right.select(*columns)), name


def test_written_datasets_are_queried_by_sql(spark, zones, tmp_path):
    run_etl(spark, zones, SETTINGS)
    other = Zones(zones.raw, zones.trusted, str(tmp_path))
    run_analytics(spark, other, SETTINGS, names=[
        "dashboard_kpis", "geografia_departamentos", "geografia_regiones", "temporal_mensual",
        "geografia_municipios_top50", "sql_ranking_departamentos"])
    names = views.register(spark, other.analytics)
    assert len(names) == 11 and all(spark.table(name).count() > 0 for name in names)
    rows = spark.sql("SELECT * FROM vista_consolidada WHERE region = :region ORDER BY total_casos DESC LIMIT 2",
                     args={"region": "Andina"}).collect()
    assert len(rows) == 2 and {r.casos_nacional for r in rows} == {400}
    assert spark.sql("SELECT * FROM ranking_departamentos ORDER BY ranking LIMIT 20").first().ranking == 1
    for name in names:
        spark.catalog.dropTempView(name)


def test_missing_dimensions_leave_cases_plain(spark, zones, tmp_path):
    write_json_array(tmp_path / "raw" / "api" / "casos" / "1.json", list(raw_records(60)))
    plain = Zones(str(tmp_path / "raw"), str(tmp_path / "trusted"), str(tmp_path / "refined"))
    audit = run_analytics(spark, plain, SETTINGS, run_etl(spark, plain, SETTINGS))
    status = {(stage, item): s for stage, item, _, s, _ in audit.rows}
    assert status["etl", "departamentos"] == "absent"
    assert status["analytics", "geografia_regiones"] == status["analytics", "tasa_ataque"] == "skipped"
    assert status["analytics", "sql_edad_departamento"] == "ok"
    assert len(spark.read.parquet(plain.cases).columns) == 25
    names = views.register(spark, plain.analytics)
    assert {"temporal_mensual", "dashboard_kpis", "top_meses_criticos"} <= set(names) and "vista_consolidada" not in names
    for name in names:
        spark.catalog.dropTempView(name)


def test_one_failing_model_leaves_the_others(spark, zones, tmp_path, monkeypatch):
    def broken(*args, **kwargs):
        raise ValueError("no fit")

    run_etl(spark, zones, SETTINGS)
    monkeypatch.setattr(models, "severity_model", broken)
    other = Zones(zones.raw, zones.trusted, str(tmp_path))
    status = {item: s for _, item, _, s, _ in run_models(spark, other, SETTINGS).rows}
    assert status["predictions_severity"] == "failed" and status["predictions_mortality"] == "ok"
    assert status["clusters_grupos_poblacionales"] in ("ok", "skipped")
    row = spark.read.parquet(f"{other.models}/ml_metrics_completas.parquet").first()
    assert row.severity_f1 is None and row.mortality_f1 is not None


def test_a_broken_dimension_is_an_error(spark, zones, tmp_path):
    write_json_array(tmp_path / "raw" / "api" / "casos" / "1.json", list(raw_records(5)))
    (tmp_path / "raw" / "mysql" / "departamentos").mkdir(parents=True)
    (tmp_path / "raw" / "mysql" / "departamentos" / "x.xml").write_text("<x/>")
    with pytest.raises(ValueError, match="x.xml"):
        run_etl(spark, Zones(str(tmp_path / "raw"), str(tmp_path / "t"), ""), SETTINGS)


def test_no_cases_stop_the_run(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    with pytest.raises(FileNotFoundError):
        run_all(spark, Zones(str(tmp_path / "raw"), str(tmp_path / "t"), str(tmp_path / "r")), SETTINGS)


def test_failed_models_do_not_stop_publishing(spark, zones, tmp_path, monkeypatch):
    def fail(*_, **__):
        raise RuntimeError("no luck")

    monkeypatch.setattr(models, "mortality_model", fail)
    other = Zones(zones.raw, str(tmp_path / "t"), str(tmp_path / "r"))
    rows = run_all(spark, other, SETTINGS, tables_root=str(tmp_path / "tables")).collect()
    assert [(r.item, r.message) for r in rows if r.status == "failed"] == [("predictions_mortality", "no luck")]
    assert sum(r.stage == "publish" for r in rows) == 3
    for table in pipeline.PUBLISHED:
        spark.sql(f"DROP TABLE {table}")


def test_command_line_needs_a_job():
    with pytest.raises(SystemExit):
        main([])


def written(root):
    """When each file of the datasets was written."""
    found = {}
    for folder, _, names in os.walk(root):
        found.update({os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names})
    return found


def test_a_broken_run_goes_on_where_it_stopped(spark, zones, tmp_path, monkeypatch):
    other = Zones(zones.raw, str(tmp_path / "t"), str(tmp_path / "r"))
    run = {"settings": SETTINGS, "tables_root": str(tmp_path / "tables")}

    def broken(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "run_models", broken)
        with pytest.raises(KeyboardInterrupt):
            run_all(spark, other, **run)
    before = written(other.analytics) | written(other.cases)
    assert len({os.path.basename(os.path.dirname(p)) for p in before if p.endswith("_SUCCESS")}) >= 2 * 29
    resumed = run_all(spark, other, resume=True, **run).collect()
    assert {p: t for p, t in written(other.analytics).items()} | written(other.cases) == before
    models_before = written(other.models)
    again = run_all(spark, other, resume=True, **run).collect()
    assert written(other.models) == models_before
    whole = run_all(spark, Zones(zones.raw, str(tmp_path / "t2"), str(tmp_path / "r2")), **run).collect()
    assert [tuple(r) for r in resumed] == [tuple(r) for r in again] == [tuple(r) for r in whole]
    for table in pipeline.PUBLISHED:
        spark.sql(f"DROP TABLE {table}")


def test_what_has_changed_is_done_again(spark, zones, tmp_path):
    run_etl(spark, zones, SETTINGS)
    other = Zones(zones.raw, zones.trusted, str(tmp_path))
    names = ["dashboard_kpis", "estado_casos", "geografia_regiones"]

    def run(settings=SETTINGS):
        manifest = pipeline.manifest_of(spark, other, settings)
        run_analytics(spark, other, settings, names=names, manifest=manifest)
        return {p: t for p, t in written(other.analytics).items() if "rollup" not in p}

    first = run()
    assert run() == first
    path = f"{other.analytics}/estado_casos.parquet"
    spark.read.parquet(path).limit(1).coalesce(1).write.mode("append").parquet(path)  # somebody wrote there
    second = run()
    assert {p for p, t in second.items() if first.get(p) != t} and all("estado_casos" in p for p, t in second.items() if first.get(p) != t)
    third = run(Settings(Thresholds(cluster_cases=7), trees=2))
    assert all(second.get(p) != t for p, t in third.items())
    run_etl(spark, zones, SETTINGS)  # new trusted cases
    assert all(third.get(p) != t for p, t in run(Settings(Thresholds(cluster_cases=7), trees=2)).items())


def test_three_reads_of_the_cases_feed_a_run():
    """Two roll-ups and the weeks; durations come from the states of a roll-up."""
    assert [name for name in DATASETS if name not in ROLLUP_OF] == ["temporal_semanal"]
