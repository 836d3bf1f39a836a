"""The registered queries: every operator over the driver's tables.

Each takes (session, folder of the tables) and returns a DataFrame.  Doubles are rounded to six
digits, because the last bits of a float sum depend on the order of its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigia.bindings import star
from vigia.bindings.star import (
    LINE_ORDER,
    THRESHOLDS,
    VOCABULARY,
    case_fact,
    order_rollup,
    raw_cases,
    report_source,
    table,
)
from vigia.functions.dates import days_between, parse_date, period_label, week_start
from vigia.functions.measures import age_in_years, bucket_label
from vigia.functions.text import canonical_name, fold_text, pad_code
from vigia.model import DATE_COLUMNS, DIMENSION_SCHEMAS, RAW_CASE_SCHEMA
from vigia.operators.changes import snapshot_changes
from vigia.operators.dedup import keep_first
from vigia.operators.integrity import duplicate_keys, key_report
from vigia.operators.lookup import coverage, join_any, join_first_match
from vigia.operators.prefix import area_under_curve, mid_ranks
from vigia.operators.report import pivot_counts, rollup, state_columns
from vigia.operators.split import split_bucket
from vigia.plans import etl, models, views
from vigia.plans.pipeline import Settings, cleaned_list, refresh_cases
from vigia.plans.reports import SEX_RATIO, dataset, find_report
from vigia.sources.landing import audit, count_lines, land_snapshot
from vigia.sources.readers import read_cases, read_csv, read_json_lines, read_latest
from vigia.sources.scratch import scratch_path
from vigia.sources.writers import publish, save_if_any, write_cases, write_csv, write_parquet

Query = Callable[[SparkSession, str], DataFrame]

# Names of the test departments that are spelled differently here and there.
ALIASES = {"NATION_1": "NATION_ONE", "NATION_3": "NATION_THREE"}
SUBSTRINGS = {"NATION_2": "NATION_TWO"}


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


# --- result datasets -------------------------------------------------------------------------

def _source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == SEX_RATIO:
        return case_fact(spark, sf_dir, ["grupo_edad", "sexo"])
    return report_source(spark, sf_dir, find_report(name))


def _dataset(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return dataset(_source(spark, sf_dir, name), name, THRESHOLDS, VOCABULARY)


def _dataset_query(name: str) -> Query:
    return lambda spark, sf_dir: rounded(_dataset(spark, sf_dir, name))


def _plain_query(name: str) -> Query:
    """The dataset on cases without enrichment."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        plain = find_report(name).fallback
        return rounded(dataset(report_source(spark, sf_dir, plain), name, THRESHOLDS, VOCABULARY))

    return run


DATASET_QUERIES = {
    "temporal_monthly": "temporal_mensual",
    "temporal_weekly": "temporal_semanal",
    "demo_age": "demografia_edad",
    "demo_sex": "demografia_sexo",
    "demo_age_sex": "demografia_edad_sexo",
    "geo_department": "geografia_departamentos",
    "geo_region": "geografia_regiones",
    "geo_municipality_top50": "geografia_municipios_top50",
    "infra_capacity": "infraestructura_salud",
    "by_transmission": "tipo_contagio",
    "by_location": "ubicacion_casos",
    "by_status": "estado_casos",
    "kpis": "dashboard_kpis",
    "evolution_active": "dashboard_evolucion",
    "top_departments": "dashboard_top_departamentos",
    "mortality_age_sex": "mortalidad_edad_sexo",
    "time_to_diagnosis": "tiempo_diagnostico",
    "cfr_month_department": "cfr_temporal_departamento",
    "recovery_time": "tiempo_recuperacion",
    "recovery_by_source": "recuperacion_por_tipo",
    "critical_municipalities": "municipios_criticos",
    "department_severity": "severidad_departamentos",
    "attack_rate": "tasa_ataque",
    "sex_ratio_pivot": SEX_RATIO,
    "severity_index": "indice_gravedad",
    "rank_departments": "sql_ranking_departamentos",
    "cfr_evolution": "sql_evolucion_letalidad",
    "age_region": "sql_edad_region",
    "cumulative_cases": "sql_casos_acumulados",
    "mortality_department_month": "mortalidad_departamento_mes",
    "time_to_death": "tiempo_diagnostico_muerte",
    "mortality_by_recovery": "mortalidad_por_tipo_recuperacion",
    "health_status": "estado_salud_actual",
    "critical_departments": "departamentos_criticos",
    "cumulative_cfr": "indicadores_epidemiologicos",
    "national_cumulative": "casos_acumulados_nacional",
    "national_cumulative_municipality": "casos_acumulados_municipales",
}
PLAIN_QUERIES = {
    "geo_department_plain": "geografia_departamentos",
    "geo_municipality_top50_plain": "geografia_municipios_top50",
    "rank_departments_plain": "sql_ranking_departamentos",
    "age_top_departments": "sql_edad_region",
}


# --- cleaning --------------------------------------------------------------------------------

def header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spaced, accented headers -> canonical columns, over the whole raw list."""
    return etl.canonical_columns(_spaced_headers(raw_cases(spark, sf_dir)))


def _spaced_headers(raw: DataFrame) -> DataFrame:
    """The raw list under the headers of its CSV export."""
    # CSV headers, in the order of the JSON fields.
    headers = (
        "fecha reporte web", "ID de caso", "Fecha de notificación", "Código DIVIPOLA departamento",
        "Nombre departamento", "Código DIVIPOLA municipio", "Nombre municipio", "Edad",
        "Unidad de medida de edad", "Sexo", "Tipo de contagio", "Ubicación del caso", "Estado",
        "Recuperado", "Fecha de diagnóstico", "Fecha de recuperación", "Fecha de inicio de síntomas",
        "Fecha de muerte",
    )
    return raw.toDF(*headers)


def clean_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = etl.canonical_columns(raw_cases(spark, sf_dir))
    return raw.select("id_caso", *[parse_date(F.col(c)).alias(c) for c in DATE_COLUMNS])


def age_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = etl.canonical_columns(raw_cases(spark, sf_dir))
    age = age_in_years(F.col("edad"), F.col("unidad_edad"))
    return rounded(raw.select("id_caso", "edad", "unidad_edad", age.alias("edad_anios")))


def age_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both treatments of an unknown age: in the last group, or apart."""
    raw = etl.canonical_columns(raw_cases(spark, sf_dir))
    age = age_in_years(F.col("edad"), F.col("unidad_edad"))
    grouped = raw.select(
        bucket_label(age).alias("grupo_edad"),
        bucket_label(age, null_label="sin dato").alias("grupo_edad_conocida"),
    )
    return grouped.groupBy("grupo_edad", "grupo_edad_conocida").agg(F.count(F.lit(1)).alias("casos"))


def alias_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = etl.canonical_columns(raw_cases(spark, sf_dir))
    name = canonical_name(F.col("nombre_departamento"), ALIASES, SUBSTRINGS)
    return (
        raw.select("nombre_departamento", name.alias("nombre_canonico"),
                   fold_text(F.col("nombre_departamento")).alias("nombre_plegado"))
        .groupBy("nombre_departamento", "nombre_canonico", "nombre_plegado")
        .agg(F.count(F.lit(1)).alias("casos"))
    )


def code_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = case_fact(spark, sf_dir, ["codigo_departamento", "codigo_municipio"])
    return (
        fact.select(
            pad_code(F.col("codigo_departamento"), 2).alias("departamento_2"),
            pad_code(F.col("codigo_municipio"), 2).alias("municipio_2"),
            pad_code(F.col("codigo_municipio"), 5).alias("municipio_5"),
        )
        .groupBy("departamento_2", "municipio_2", "municipio_5")
        .agg(F.count(F.lit(1)).alias("casos"))
    )


def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["fecha_reporte", "anio_reporte", "mes_reporte", "semana_reporte"]
    fact = case_fact(spark, sf_dir, columns)
    return (
        fact.withColumns({
            "lunes": week_start(F.col("fecha_reporte")),
            "periodo": period_label(F.col("anio_reporte"), F.col("mes_reporte")),
        })
        .groupBy(*columns, "lunes", "periodo")
        .agg(F.count(F.lit(1)).alias("casos"))
    )


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["estado", "recuperado", "fallecido", "recuperado_flag"]
    return case_fact(spark, sf_dir, columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("casos"))


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = case_fact(spark, sf_dir, ["id_caso", "fecha_inicio_sintomas", "fecha_notificacion",
                                     "fecha_diagnostico", "fecha_recuperacion", "fecha_muerte"])
    diagnosis = F.col("fecha_diagnostico")
    return fact.select(
        "id_caso",
        days_between(diagnosis, F.col("fecha_inicio_sintomas")).alias("dias_sintomas_diagnostico"),
        days_between(F.col("fecha_notificacion"), diagnosis).alias("dias_notificacion_diagnostico"),
        days_between(F.col("fecha_recuperacion"), diagnosis).alias("dias_recuperacion"),
        days_between(F.col("fecha_muerte"), diagnosis).alias("dias_muerte"),
    )


def dedup_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("id_caso", F.expr("l_orderkey * 10 + l_linenumber"))
    return keep_first(lines, ["id_caso"], LINE_ORDER).select(
        "id_caso", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        F.col("l_shipdate").cast("date").alias("l_shipdate"),
    )


def clean_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(etl.clean_cases(raw_cases(spark, sf_dir)))


# --- enrichment ------------------------------------------------------------------------------

def _two_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases whose code is the customer's nation and whose name is the supplier's: they often differ."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    placed = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
    named = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"], "left")
    df = lines.join(placed, lines["l_orderkey"] == placed["o_orderkey"], "left")
    df = df.join(named, df["l_suppkey"] == named["s_suppkey"], "left")
    return df.select(
        F.expr("l_orderkey * 10 + l_linenumber").alias("id_caso"),
        # A code no department has, for one case in ten.
        F.expr("CASE WHEN l_partkey % 10 = 0 THEN '99' ELSE lpad(CAST(c_nationkey AS STRING), 2, '0') END")
        .alias("codigo"),
        F.expr("CASE WHEN l_partkey % 4 = 0 THEN 'DESCONOCIDO' ELSE n_name END").alias("nombre"),
    )


def _departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.stored_departments(spark, sf_dir).select(
        "codigo_dane", F.col("nombre_departamento").alias("nombre_dim"), "id_departamento", "poblacion_2020", "region",
    )


def or_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_any(_two_names(spark, sf_dir), _departments(spark, sf_dir), F.col("codigo"),
                    F.col("nombre"), "codigo_dane", "nombre_dim")


def first_match_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_first_match(_two_names(spark, sf_dir), _departments(spark, sf_dir), F.col("codigo"),
                            F.col("nombre"), "codigo_dane", "nombre_dim")


def _trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = etl.enrich_cases(
        etl.clean_cases(raw_cases(spark, sf_dir)),
        star.stored_departments(spark, sf_dir), star.municipalities(spark, sf_dir), star.hospitals(spark, sf_dir),
        aliases={}, substrings={},
    )
    return etl.derive_cases(cases, VOCABULARY)


def etl_trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ETL over the raw list: all 34 columns of the trusted cases."""
    return rounded(_trusted(spark, sf_dir))


def enrich_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment without cleaning, department by code or else name."""
    fact = case_fact(spark, sf_dir, ["id_caso", "codigo_departamento", "nombre_departamento", "codigo_municipio"])
    df = etl.enrich_cases(
        fact, star.stored_departments(spark, sf_dir), star.municipalities(spark, sf_dir),
        star.hospitals(spark, sf_dir), aliases={}, substrings={}, first_match=True,
    )
    return rounded(df)


def capacity_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hospital capacity reached through the municipality dimension (id to code)."""
    fact = case_fact(spark, sf_dir, ["id_caso", "codigo_municipio"])
    return etl.with_capacity(fact, star.hospitals(spark, sf_dir), star.municipalities(spark, sf_dir))


def enrichment_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["poblacion_departamento", "poblacion_municipio", "num_hospitales"]
    return coverage(case_fact(spark, sf_dir, columns), columns)


def hospital_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.hospital_capacity(star.hospitals(spark, sf_dir))


def pk_fk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "departamentos": star.departments(spark, sf_dir),
        "municipios": star.municipalities(spark, sf_dir),
        "hospitales": star.hospitals(spark, sf_dir),
        "ordenes": table(spark, sf_dir, "orders"),
        "casos": table(spark, sf_dir, "lineitem").withColumn("id_caso", F.expr("l_orderkey * 10 + l_linenumber")),
    }
    primary = {"departamentos": "id_departamento", "municipios": "id_municipio",
               "hospitales": "id_hospital", "casos": "id_caso"}
    foreign = [
        ("municipios", "id_departamento", "departamentos", "id_departamento"),
        ("hospitales", "id_municipio", "municipios", "id_municipio"),
        ("casos", "l_orderkey", "ordenes", "o_orderkey"),
        # Most customers have no supplier of the same key: orphans on purpose.
        ("municipios", "id_municipio", "hospitales", "id_municipio"),
    ]
    return key_report(tables, primary, foreign)


def duplicate_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.expr("l_orderkey * 10 + l_linenumber").alias("id_caso"))
    return duplicate_keys(lines, ["id_caso"])


# --- views -----------------------------------------------------------------------------------

VIEW_KEYS = ("nombre_departamento", "region", "poblacion_departamento", "nombre_municipio")


def _view(build: Callable[..., DataFrame], *names: str) -> Query:
    """A view over datasets.

    Several datasets are taken from one roll-up written to the shared folder, so that the cases are
    read once, as they are when the datasets have been published.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if len(names) == 1:
            return rounded(build(_dataset(spark, sf_dir, names[0])))
        states = list(state_columns(VOCABULARY))
        summed = rollup(order_rollup(spark, sf_dir, VIEW_KEYS, states), VIEW_KEYS, VOCABULARY)
        path = scratch_path(spark, "view")
        write_parquet(summed, path)
        source = spark.read.schema(summed.schema).parquet(path)
        return rounded(build(*[dataset(source, name, THRESHOLDS, VOCABULARY) for name in names]))

    return run


DEPARTMENTS, REGIONS = "geografia_departamentos", "geografia_regiones"
MONTHS, SUMMARY = "temporal_mensual", "dashboard_kpis"

VIEW_QUERIES: dict[str, Query] = {
    "kpis_view": _view(views.kpis, SUMMARY),
    "department_detail": _view(lambda d: views.department_detail(d, "NATION_7"), DEPARTMENTS),
    "ranking_top20": _view(views.ranking, "sql_ranking_departamentos"),
    "regions_view": _view(views.regions, REGIONS),
    "temporal_last": _view(lambda m: views.temporal(m, 24), MONTHS),
    "period_label": _view(lambda m: views.with_period(views.temporal(m)), MONTHS),
    "consolidated": _view(views.consolidated, DEPARTMENTS, REGIONS, SUMMARY),
    "consolidated_region": _view(lambda d, r, k: views.consolidated(d, r, k, region="ASIA", limit=3),
                                 DEPARTMENTS, REGIONS, SUMMARY),
    "top_cfr": _view(views.top_cfr, DEPARTMENTS),
    "critical_months": _view(views.critical_months, MONTHS),
    "region_comparison": _view(views.region_comparison, DEPARTMENTS),
    "affected_population": _view(views.affected_population, DEPARTMENTS),
    "dashboard_consolidated": _view(views.dashboard, DEPARTMENTS, REGIONS),
    "region_distribution": _view(views.region_distribution, REGIONS),
    "top10_cfr": _view(lambda d, r: views.top_cfr_rows(views.dashboard(d, r, None)), DEPARTMENTS, REGIONS),
    "top10_per_100k": _view(lambda d, r: views.top_per_100k(views.dashboard(d, r, None)), DEPARTMENTS, REGIONS),
    "ranked_badges": _view(lambda d, r: views.ranked_table(views.dashboard(d, r, None), THRESHOLDS),
                           DEPARTMENTS, REGIONS),
    "top_municipalities": _view(lambda m: m, "geografia_municipios_top50"),
}


def sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered cases queried by SQL text."""
    fact = case_fact(spark, sf_dir, ["nombre_departamento", "region", "fallecido", "anio_reporte"])
    fact.createOrReplaceTempView("casos_vigia")
    return rounded(spark.sql(
        """
        SELECT region, anio_reporte, COUNT(*) AS casos, SUM(fallecido) AS fallecidos,
               RANK() OVER (PARTITION BY anio_reporte ORDER BY COUNT(*) DESC) AS ranking
        FROM casos_vigia
        WHERE anio_reporte >= :desde
        GROUP BY region, anio_reporte
        """,
        args={"desde": 1997},
    ))


# --- sources and sinks -----------------------------------------------------------------------

def parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted cases written by year and month, one period range read back."""
    root = scratch_path(spark, "cases")
    columns = ["id_caso", "estado", "edad_anios", "anio_reporte", "mes_reporte", "fallecido"]
    write_cases(case_fact(spark, sf_dir, columns), root)
    period = read_cases(spark, root, (1996, 3), (1997, 10))
    return period.groupBy("anio_reporte", "mes_reporte").agg(
        F.count(F.lit(1)).alias("casos"), F.sum("fallecido").alias("fallecidos")
    )


def department_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cases written, those of one department read back: row groups without it are skipped."""
    root = scratch_path(spark, "cases")
    columns = ["id_caso", "codigo_departamento", "estado", "anio_reporte", "mes_reporte", "fallecido"]
    write_cases(case_fact(spark, sf_dir, columns), root)
    return read_cases(spark, root).filter(F.col("codigo_departamento") == 7)


def _older_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw list as it was: some cases not there yet, some with another state or month, some that are gone by now."""
    raw = raw_cases(spark, sf_dir)
    number = F.col("id_de_caso").cast("bigint")
    later = number % 997 == 5
    stated = raw.withColumn("estado", F.when(number % 499 == 3, F.lit("N")).otherwise(F.col("estado")))
    moved = stated.withColumn("fecha_reporte_web", F.when(number % 499 == 4, F.lit("1993-05-06")).otherwise(F.col("fecha_reporte_web")))
    gone = raw.filter(number % 997 == 7).withColumn("id_de_caso", F.concat(F.lit("x"), F.col("id_de_caso"))).withColumn(
        "fecha_reporte_web", F.lit("1980-02-03"))
    return moved.filter(~later).unionByName(gone)


def changed_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is different between two landed snapshots of the raw list, by case."""
    zone = scratch_path(spark, "raw")
    older = land_snapshot(_older_list(spark, sf_dir), zone, "api/casos", datetime(2024, 1, 1))
    newer = land_snapshot(raw_cases(spark, sf_dir), zone, "api/casos", datetime(2024, 1, 8))
    old, new = (read_json_lines(spark, path, RAW_CASE_SCHEMA) for path in (older, newer))
    return snapshot_changes(old, new, ["id_de_caso"], carried=["estado"])


def incremental_trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted cases of an older raw list, brought to the newer one by the months that differ."""
    root = scratch_path(spark, "trusted")
    dimensions = {"departamentos": star.stored_departments(spark, sf_dir), "municipios": star.municipalities(spark, sf_dir),
                  "hospitales": star.hospitals(spark, sf_dir)}
    # Cleaned once, for the trusted cases and for the comparison.
    older = cleaned_list(_older_list(spark, sf_dir))
    write_cases(etl.enrich_cases(older.drop("__period"), **{
        "departments": dimensions["departamentos"], "municipalities": dimensions["municipios"], "hospitals": dimensions["hospitales"],
        "aliases": {}, "substrings": {}}), root, derived=etl.derived_columns(VOCABULARY))
    refresh_cases(spark, older, raw_cases(spark, sf_dir), dimensions, root, Settings(vocabulary=VOCABULARY), {}, {})
    return rounded(read_cases(spark, root))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw list written as CSV under its export headers, read back and cleaned."""
    path = scratch_path(spark, "csv")
    write_csv(_spaced_headers(raw_cases(spark, sf_dir)), path)
    return rounded(etl.clean_cases(read_csv(spark, path)))


def json_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed snapshots of the raw list; the newest one is read."""
    zone = scratch_path(spark, "raw")
    raw = raw_cases(spark, sf_dir)
    land_snapshot(raw.filter(F.col("sexo") == "F"), zone, "api/casos", datetime(2024, 1, 1))
    land_snapshot(raw, zone, "api/casos", datetime(2024, 1, 8))
    df = read_latest(spark, f"{zone}/api/casos", RAW_CASE_SCHEMA)
    return df.groupBy("sexo", "estado", "departamento_nom").agg(F.count(F.lit(1)).alias("registros"))


def snapshot_by_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older snapshot that is landed later; the one with the larger stamp is read."""
    zone = scratch_path(spark, "raw")
    raw = raw_cases(spark, sf_dir)
    land_snapshot(raw, zone, "api/casos", datetime(2024, 1, 8))
    land_snapshot(raw.filter(F.col("sexo") == "F"), zone, "api/casos", datetime(2024, 1, 1))
    df = read_latest(spark, f"{zone}/api/casos", RAW_CASE_SCHEMA)
    return df.groupBy("sexo", "estado", "departamento_nom").agg(F.count(F.lit(1)).alias("registros"))


def csv_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The department dimension landed as CSV and read by its declared schema: codes keep their zeros."""
    zone = scratch_path(spark, "dimensions")
    write_csv(star.departments(spark, sf_dir), f"{zone}/snapshot=20240101_000000")
    df = read_latest(spark, zone, DIMENSION_SCHEMAS["departamentos"])
    return rounded(df.select("codigo_dane", "poblacion_2020", "densidad_poblacional", "region"))


def empty_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A department dimension landed without rows is there: all cases stay, none with a population."""
    zone = scratch_path(spark, "dimensions")
    land_snapshot(star.departments(spark, sf_dir).limit(0), zone, "departamentos", datetime(2024, 1, 1))
    dimension = read_latest(spark, f"{zone}/departamentos", DIMENSION_SCHEMAS["departamentos"])
    cases = etl.with_department(clean_list(spark, sf_dir), dimension)
    return cases.groupBy("sexo").agg(F.count(F.lit(1)).alias("casos"), F.count("poblacion_departamento").alias("con_poblacion"))


def sex_ratio_one_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases by age group and sex with one sex listed: the others are counted together."""
    return pivot_counts(case_fact(spark, sf_dir, ["grupo_edad", "sexo"]), "grupo_edad", "sexo", ["F"])


def csv_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result saved as parquet and CSV; the CSV copy is read."""
    folder = scratch_path(spark, "refined")
    save_if_any(spark, _dataset(spark, sf_dir, "recuperacion_por_tipo"), folder, "recuperacion_por_tipo")
    df = read_csv(spark, f"{folder}/recuperacion_por_tipo.csv", infer=True)
    counts = ["total_casos", "recuperados", "fallecidos"]
    return rounded(df.withColumns({c: F.col(c).cast("bigint") for c in counts}))


def publish_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published table whose contents are replaced."""
    path = scratch_path(spark, "warehouse")
    monthly = _dataset(spark, sf_dir, MONTHS)
    name = f"vigia_{path.rpartition('-')[2]}_temporal_mensual"
    publish(monthly.filter("anio_reporte = 1995"), name, path)
    publish(monthly, name, path)
    return rounded(spark.table(name))


def landing_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in landed CSV files, counted by lines without headers."""
    zone = scratch_path(spark, "landing")
    counts = {}
    for name in ("orders", "customer", "supplier", "nation"):
        write_csv(table(spark, sf_dir, name), f"{zone}/csv/{name}")
        counts[f"csv_{name}"] = count_lines(spark, f"{zone}/csv/{name}")
    return audit(counts)


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after landing, cleaning and enrichment, each counted in the files of its stage."""
    landed = land_snapshot(raw_cases(spark, sf_dir), scratch_path(spark, "raw"), "api/casos")
    raw = read_json_lines(spark, landed, RAW_CASE_SCHEMA)
    clean_path = scratch_path(spark, "clean")
    # Cases of a day beside each other: they are like each other, and cross the network in less when they are dealt by month.
    clean_rows = write_parquet(etl.clean_cases(raw).sortWithinPartitions("fecha_reporte", "codigo_departamento"), clean_path)
    enriched = etl.with_department(
        spark.read.parquet(clean_path), star.stored_departments(spark, sf_dir), {}, {}
    )
    enriched_rows = write_cases(enriched, scratch_path(spark, "trusted"), derived=etl.derived_columns(VOCABULARY))
    written = spark.createDataFrame(
        [("limpios", clean_rows), ("enriquecidos", enriched_rows)], "etapa string, registros bigint"
    )
    lines = count_lines(spark, landed, header_lines=0).agg(F.sum("registros").alias("registros"))
    return lines.select(F.lit("leidos").alias("etapa"), "registros").unionByName(written)


def case_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten first cases in full order, as the ETL shows them."""
    columns = ["id_caso", "fecha_reporte", "nombre_departamento", "nombre_municipio", "edad_anios",
               "sexo", "estado", "grupo_edad", "fallecido", "recuperado_flag"]
    fact = case_fact(spark, sf_dir, columns)
    return rounded(fact.orderBy(*[F.col(c).asc_nulls_first() for c in columns]).limit(10))


# --- models ----------------------------------------------------------------------------------

def _model_cases(spark: SparkSession, sf_dir: str, columns: Iterable[str] = models.MODEL_COLUMNS) -> DataFrame:
    return models.prepare_cases(case_fact(spark, sf_dir, columns))


def ml_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = _model_cases(spark, sf_dir)
    return rounded(models.severity_labels(cases, VOCABULARY).select(
        "id_caso", "edad_anios", "sexo", "tipo_contagio", "grupo_edad", "dias_notificacion_diagnostico",
        "label",
    ))


def ml_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = _model_cases(spark, sf_dir, ["id_caso", *models.COMPLETE, "fecha_notificacion", "fecha_diagnostico"])
    bucket = split_bucket(F.col("id_caso"))
    part = F.when(bucket < models.TRAIN_PERCENT, F.lit("train")).otherwise(F.lit("test"))
    return cases.select("id_caso", bucket.alias("bucket"), part.alias("parte"))


def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = _model_cases(spark, sf_dir, ["ubicacion", *models.COMPLETE, "fecha_notificacion", "fecha_diagnostico"])
    return models.label_counts(models.hospital_labels(cases, VOCABULARY))


def department_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(models.department_table(_model_cases(spark, sf_dir), THRESHOLDS, VOCABULARY))


def group_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(models.group_table(_model_cases(spark, sf_dir), THRESHOLDS, VOCABULARY))


#: Pairs of a label and a numeric score that the area under the curve is asked for.
AREAS = [("fallecido", "edad_anios"), ("fallecido", "dias_notificacion_diagnostico"), ("recuperado_flag", "edad_anios"),
         ("recuperado_flag", "dias_notificacion_diagnostico")]


def auc_by_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the curve of given scores over the test rows, by rank sums; the scores have many ties."""
    _, test = models.hash_split(_model_cases(spark, sf_dir), "id_caso", models.TRAIN_PERCENT)
    rows = [area_under_curve(test, label, score).select(F.lit(label).alias("etiqueta"), F.lit(score).alias("puntaje"),
                                                        F.col("positives").alias("positivos"), F.col("negatives").alias("negativos"), "auc")
            for label, score in AREAS]
    return rounded(reduce(DataFrame.unionByName, rows))


def age_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean ranks of the ages of all cases."""
    return rounded(mid_ranks(case_fact(spark, sf_dir, ["edad_anios"]), "edad_anios"))


def mortality_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test rows of the mortality model: ids, labels, features, standardised features."""
    cases = models.mortality_labels(_model_cases(spark, sf_dir))
    return rounded(models.model_features(cases, ["sexo", "tipo_contagio", "ubicacion", "region"], ["edad_anios", "densidad_poblacional"]))


def severity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test rows of the severity model."""
    cases = models.severity_labels(_model_cases(spark, sf_dir), VOCABULARY)
    return rounded(models.model_features(cases, ["sexo", "tipo_contagio", "grupo_edad"], ["edad_anios", "densidad_poblacional"]))


def hospital_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test rows of the hospital model."""
    cases = models.hospital_labels(_model_cases(spark, sf_dir), VOCABULARY)
    return rounded(models.model_features(cases, ["sexo", "tipo_contagio"], ["edad_anios"]))


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a prediction that follows from the age: severity over the test rows."""
    _, test = models.hash_split(models.severity_labels(_model_cases(spark, sf_dir), VOCABULARY), "id_caso", models.TRAIN_PERCENT)
    guess = F.when(F.col("edad_anios") >= 60, 2.0).when(F.col("edad_anios") >= 30, 1.0).otherwise(0.0)
    return rounded(models.classification_metrics(test.select("label", guess.alias("prediction"))))


def cluster_departments_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departments with standardised features, held against the centres of their clusters."""
    clustered = models.cluster_departments(_model_cases(spark, sf_dir), THRESHOLDS, VOCABULARY)
    return rounded(models.check_clusters(clustered, models.DEPARTMENT_FEATURES, ["nombre_departamento"]))


def cluster_groups_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = models.cluster_groups(_model_cases(spark, sf_dir), THRESHOLDS, VOCABULARY)
    return rounded(models.check_clusters(clustered, models.GROUP_FEATURES, ["grupo_edad", "sexo"]))


def mortality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.mortality_model(_model_cases(spark, sf_dir)).predictions


def mortality_model_without_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.mortality_model(_model_cases(spark, sf_dir), with_location=False).predictions


def severity_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.severity_model(_model_cases(spark, sf_dir), VOCABULARY).predictions


def hospitalization_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.hospitalization_model(_model_cases(spark, sf_dir), VOCABULARY).predictions


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.feature_importance(models.mortality_model(_model_cases(spark, sf_dir)), spark)


def ml_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = _model_cases(spark, sf_dir)
    return models.metrics_row(
        models.mortality_model(cases), models.severity_model(cases, VOCABULARY),
        models.hospitalization_model(cases, VOCABULARY), spark,
    )


def cluster_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.cluster_members(
        models.cluster_departments(_model_cases(spark, sf_dir), THRESHOLDS, VOCABULARY)
    )


def cluster_departments_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.cluster_departments(_model_cases(spark, sf_dir), THRESHOLDS, VOCABULARY).profile


def cluster_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = models.cluster_groups(_model_cases(spark, sf_dir), THRESHOLDS, VOCABULARY).members
    return members.select("grupo_edad", "sexo", "total_casos", *models.GROUP_FEATURES, "cluster")


def cluster_groups_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.cluster_groups(_model_cases(spark, sf_dir), THRESHOLDS, VOCABULARY).profile


OPERATOR_QUERIES: dict[str, Query] = {
    "header_names": header_names,
    "clean_dates": clean_dates,
    "age_years": age_years,
    "age_buckets": age_buckets,
    "alias_names": alias_names,
    "code_norm": code_norm,
    "calendar_parts": calendar_parts,
    "flags": flags,
    "durations": durations,
    "dedup_cases": dedup_cases,
    "clean_cases": clean_list,
    "join_any": or_join,
    "join_first_match": first_match_join,
    "etl_trusted": etl_trusted,
    "enrich_full": enrich_full,
    "capacity_by_code": capacity_by_code,
    "coverage": enrichment_coverage,
    "hospital_capacity": hospital_capacity,
    "pk_fk_check": pk_fk_check,
    "duplicate_cases": duplicate_cases,
    "sql_view": sql_view,
    "parquet_partitioned": parquet_partitioned,
    "csv_roundtrip": csv_roundtrip,
    "csv_result": csv_result,
    "json_latest": json_latest,
    "publish_table": publish_table,
    "landing_audit": landing_audit,
    "stage_counts": stage_counts,
    "case_sample": case_sample,
    "snapshot_by_stamp": snapshot_by_stamp,
    "csv_dimensions": csv_dimensions,
    "empty_dimension": empty_dimension,
    "sex_ratio_one_listed": sex_ratio_one_listed,
    "department_cases": department_cases,
    "snapshot_changes": changed_cases,
    "incremental_trusted": incremental_trusted,
    "auc_by_ranks": auc_by_ranks,
    "age_ranks": age_ranks,
}
MODEL_QUERIES: dict[str, Query] = {
    "ml_dataset": ml_dataset,
    "ml_split": ml_split,
    "label_distribution": label_distribution,
    "department_features": department_features,
    "group_features": group_features,
    "mortality_model": mortality_model,
    "mortality_model_without_location": mortality_model_without_location,
    "severity_model": severity_model,
    "hospitalization_model": hospitalization_model,
    "feature_importance": feature_importance,
    "ml_metrics": ml_metrics,
    "cluster_departments": cluster_departments,
    "cluster_departments_profile": cluster_departments_profile,
    "cluster_groups": cluster_groups,
    "cluster_groups_profile": cluster_groups_profile,
    "mortality_features": mortality_features,
    "severity_features": severity_features,
    "hospital_features": hospital_features,
    "classification_metrics": classification_metrics,
    "cluster_departments_check": cluster_departments_check,
    "cluster_groups_check": cluster_groups_check,
}
QUERIES: dict[str, Query] = {
    **{key: _dataset_query(name) for key, name in DATASET_QUERIES.items()},
    **{key: _plain_query(name) for key, name in PLAIN_QUERIES.items()},
    **OPERATOR_QUERIES,
    **VIEW_QUERIES,
    **MODEL_QUERIES,
}
