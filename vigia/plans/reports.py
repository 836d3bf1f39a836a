"""The result datasets, one declaration each.

``REPORTS`` holds the datasets every run writes, ``EXTRA_REPORTS`` the ones that are only named in
the documentation of the data product.  Dataset and column names are part of its interface.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from vigia.model import Thresholds, Vocabulary
from vigia.operators.report import Report, deviation_of, mean_of, pivot_counts, run_report

CASES = "sum(st_cases)"
DEATHS = "sum(st_deaths)"
RECOVERED = "sum(st_recovered)"
MEAN_AGE = "try_divide(sum(st_age_sum), sum(st_age_n))"
MEAN_DENSITY = "try_divide(sum(st_density_sum), sum(st_density_n))"
CFR = "try_divide(sum(st_deaths), sum(st_cases)) * 100"
CFR_2 = "round(try_divide(sum(st_deaths) * 100D, sum(st_cases)), 2)"
RECOVERY = "try_divide(sum(st_recovered), sum(st_cases)) * 100"
SEVERE_SHARE = "try_divide(sum(st_severe), sum(st_cases)) * 100"
HOSPITAL_SHARE = "try_divide(sum(st_hospital), sum(st_cases)) * 100"
PER_100K_DEPARTMENT = "try_divide(sum(st_cases), max(poblacion_departamento)) * 100000"
PER_100K_MUNICIPALITY = "try_divide(sum(st_cases), max(poblacion_municipio)) * 100000"
SEVERITY = (
    "CASE WHEN letalidad > {high_cfr} THEN 'ALTA' WHEN letalidad > {medium_cfr} THEN 'MEDIA' "
    "ELSE 'BAJA' END"
)
RUNNING_BY_DEPARTMENT = (
    "OVER (PARTITION BY nombre_departamento ORDER BY anio_reporte, mes_reporte "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
)

MONTH = ("anio_reporte", "mes_reporte")
DEPARTMENT = ("nombre_departamento",)

_ALL = [
    # time
    Report(
        "temporal_mensual", MONTH,
        {"total_casos": CASES, "total_fallecidos": DEATHS, "total_recuperados": RECOVERED,
         "tasa_letalidad": CFR},
        order=MONTH,
    ),
    Report(
        "temporal_semanal", ("anio_reporte", "semana_reporte"),
        {"casos": CASES, "edad_promedio": MEAN_AGE},
        order=("anio_reporte", "semana_reporte"),
    ),
    # people
    Report(
        "demografia_edad", ("grupo_edad",),
        {"total_casos": CASES, "fallecidos": DEATHS, "tasa_letalidad": CFR},
        order=("grupo_edad",),
    ),
    Report(
        "demografia_sexo", ("sexo",),
        {"total_casos": CASES, "fallecidos": DEATHS, "edad_promedio": MEAN_AGE},
    ),
    Report("demografia_edad_sexo", ("grupo_edad", "sexo"), {"casos": CASES}, order=("grupo_edad", "sexo")),
    # places
    Report(
        "geografia_departamentos", ("nombre_departamento", "region", "poblacion_departamento"),
        {"total_casos": CASES, "fallecidos": DEATHS, "casos_por_100k": PER_100K_DEPARTMENT,
         "tasa_letalidad": CFR},
        order=("-total_casos",),
        fallback=Report(
            "geografia_departamentos", DEPARTMENT,
            {"total_casos": CASES, "fallecidos": DEATHS, "tasa_letalidad": CFR},
            order=("-total_casos",),
        ),
    ),
    Report(
        "geografia_regiones", ("region",),
        {"total_casos": CASES, "fallecidos": DEATHS,
         "num_departamentos": "count(DISTINCT nombre_departamento)", "densidad_promedio": MEAN_DENSITY},
        grain=DEPARTMENT,
        order=("-total_casos",),
        empty_schema="region string, total_casos bigint, fallecidos bigint",
    ),
    Report(
        "geografia_municipios_top50", ("nombre_municipio", "nombre_departamento", "poblacion_municipio"),
        {"total_casos": CASES, "fallecidos": DEATHS, "incidencia_por_100k": PER_100K_MUNICIPALITY},
        order=("-total_casos",), limit="top_municipalities",
        fallback=Report(
            "geografia_municipios_top50", ("nombre_municipio", "nombre_departamento"),
            {"total_casos": CASES, "fallecidos": DEATHS},
            order=("-total_casos",), limit="top_municipalities",
        ),
    ),
    # Capacity is known per municipality, so it is taken once for each of them and then summed.
    Report(
        "infraestructura_salud", DEPARTMENT,
        {"total_casos": CASES, "fallecidos": DEATHS, "hospitales": "sum(num_hospitales)",
         "camas_uci": "sum(total_camas_uci)", "camas_general": "sum(total_camas_general)"},
        where="num_hospitales IS NOT NULL",
        grain=("codigo_municipio",),
        carried={c: f"max({c})" for c in ("num_hospitales", "total_camas_uci", "total_camas_general")},
        derived={"casos_por_cama_uci": "try_divide(total_casos, camas_uci)"},
        order=("-casos_por_cama_uci",), optional=True, one_file=False,
    ),
    # transmission, location, status
    Report(
        "tipo_contagio", ("tipo_contagio",),
        {"total_casos": CASES, "fallecidos": DEATHS, "tasa_letalidad": CFR},
        order=("-total_casos",),
    ),
    Report(
        "ubicacion_casos", ("ubicacion",),
        {"total_casos": CASES, "fallecidos": DEATHS, "edad_promedio": MEAN_AGE},
        order=("-total_casos",),
    ),
    Report("estado_casos", ("estado",), {"total_casos": CASES, "edad_promedio": MEAN_AGE}),
    # summary
    Report(
        "dashboard_kpis", (),
        {"total_casos": CASES, "total_fallecidos": DEATHS, "total_recuperados": RECOVERED,
         "departamentos_afectados": "count(DISTINCT nombre_departamento)",
         "municipios_afectados": "count(DISTINCT nombre_municipio)",
         "edad_promedio": MEAN_AGE, "tasa_letalidad_general": CFR},
        grain=("nombre_departamento", "nombre_municipio"),
    ),
    Report(
        "dashboard_evolucion", MONTH,
        {"casos_nuevos": CASES, "fallecidos": DEATHS, "recuperados": RECOVERED},
        derived={"casos_activos_estimados": "casos_nuevos - fallecidos - recuperados"},
        order=MONTH,
    ),
    Report(
        "dashboard_top_departamentos", DEPARTMENT, {"casos": CASES},
        order=("-casos",), limit="top_departments",
    ),
    # mortality
    Report(
        "mortalidad_edad_sexo", ("grupo_edad", "sexo"),
        {"total_casos": CASES, "fallecidos": DEATHS, "tasa_mortalidad": CFR, "edad_promedio": MEAN_AGE},
        order=("grupo_edad", "sexo"),
    ),
    Report(
        "tiempo_diagnostico", ("estado",),
        {"dias_promedio": mean_of("st_diagnosis"), "dias_minimo": "min(st_diagnosis_min)",
         "dias_maximo": "max(st_diagnosis_max)", "casos": "sum(st_diagnosis_n)"},
        having="casos > 0",
    ),
    Report(
        "cfr_temporal_departamento", (*MONTH, *DEPARTMENT),
        {"casos": CASES, "fallecidos": DEATHS, "cfr": CFR},
        having="casos > {month_cases}",
        order=(*MONTH, "-cfr"),
    ),
    # recovery
    Report(
        "tiempo_recuperacion", ("grupo_edad", "estado"),
        {"dias_promedio_recuperacion": mean_of("st_recovery"), "desviacion_std": deviation_of("st_recovery"),
         "casos_recuperados": "sum(st_recovery_n)"},
        having="casos_recuperados > 0 AND casos_recuperados > {recovered_cases}",
    ),
    Report(
        "recuperacion_por_tipo", ("tipo_contagio", "ubicacion"),
        {"total_casos": CASES, "recuperados": RECOVERED, "fallecidos": DEATHS,
         "tasa_recuperacion": RECOVERY, "tasa_mortalidad": CFR},
        order=("-total_casos",),
    ),
    # hot spots
    Report(
        "municipios_criticos", ("nombre_municipio", "nombre_departamento", "poblacion_municipio"),
        {"total_casos": CASES, "fallecidos": DEATHS, "incidencia_100k": PER_100K_MUNICIPALITY,
         "letalidad": CFR},
        having="total_casos > {critical_cases} AND incidencia_100k > {critical_per_100k}",
        order=("-incidencia_100k",), optional=True, one_file=False,
    ),
    Report(
        "severidad_departamentos", DEPARTMENT,
        {"casos": CASES, "fallecidos": DEATHS, "letalidad": CFR},
        derived={"categoria_severidad": SEVERITY},
        order=("-letalidad",),
    ),
    # indicators
    Report(
        "tasa_ataque", ("nombre_departamento", "grupo_edad"),
        {"casos": CASES, "poblacion": "max(poblacion_departamento)"},
        derived={"tasa_ataque": "try_divide(casos, poblacion) * 100000"},
        order=("-tasa_ataque",), optional=True,
    ),
    Report(
        "indice_gravedad", DEPARTMENT,
        {"total_casos": CASES, "fallecidos": DEATHS, "porcentaje_graves": SEVERE_SHARE,
         "porcentaje_hospitalizados": HOSPITAL_SHARE, "tasa_letalidad": CFR},
        derived={"indice_gravedad": "porcentaje_graves * {weight_severe}D "
                                    "+ porcentaje_hospitalizados * {weight_hospital}D "
                                    "+ tasa_letalidad * {weight_cfr}D"},
        order=("-indice_gravedad",),
    ),
    # ranking and running totals; the windows run over one row per department or month
    Report(
        "sql_ranking_departamentos", ("nombre_departamento", "region"),
        {"total_casos": CASES, "fallecidos": DEATHS, "tasa_letalidad": CFR_2},
        where="nombre_departamento IS NOT NULL",
        derived={"ranking": "rank() OVER (ORDER BY total_casos DESC)"},
        order=("-total_casos",),
        fallback=Report(
            "sql_ranking_departamentos", DEPARTMENT,
            {"total_casos": CASES, "fallecidos": DEATHS, "tasa_letalidad": CFR_2},
            where="nombre_departamento IS NOT NULL",
            derived={"ranking": "rank() OVER (ORDER BY total_casos DESC)"},
            order=("-total_casos",),
        ),
    ),
    Report(
        "sql_evolucion_letalidad", MONTH,
        {"casos": CASES, "fallecidos": DEATHS, "tasa_letalidad": CFR_2, "edad_promedio": MEAN_AGE},
        order=MONTH,
    ),
    Report(
        "sql_edad_region", ("region", "grupo_edad"),
        {"casos": CASES, "fallecidos": DEATHS, "edad_promedio": f"round({MEAN_AGE}, 1)",
         "tasa_letalidad": CFR_2},
        where="region IS NOT NULL AND grupo_edad IS NOT NULL",
        order=("region", "grupo_edad"),
        fallback=Report(
            "sql_edad_departamento", ("nombre_departamento", "grupo_edad"),
            {"casos": CASES, "fallecidos": DEATHS, "edad_promedio": f"round({MEAN_AGE}, 1)",
             "tasa_letalidad": CFR_2},
            top=("nombre_departamento", "casos", "top_departments"),
            keep="grupo_edad IS NOT NULL",
            order=("nombre_departamento", "grupo_edad"),
        ),
    ),
    Report(
        "sql_casos_acumulados", (*DEPARTMENT, *MONTH),
        {"casos_mes": CASES},
        top=("nombre_departamento", "casos_mes", "top_departments"),
        derived={"casos_acumulados": f"sum(casos_mes) {RUNNING_BY_DEPARTMENT}"},
        order=(*DEPARTMENT, *MONTH),
    ),
]

_EXTRA = [
    Report(
        "mortalidad_departamento_mes", (*MONTH, *DEPARTMENT),
        {"casos": CASES, "fallecidos": DEATHS, "cfr": CFR},
        order=(*MONTH, "-cfr"),
    ),
    Report(
        "tiempo_diagnostico_muerte", ("grupo_edad",),
        {"dias_promedio": mean_of("st_death"), "dias_minimo": "min(st_death_min)", "dias_maximo": "max(st_death_max)",
         "desviacion_std": deviation_of("st_death"), "casos": "sum(st_death_n)"},
        having="casos > 0",
        order=("grupo_edad",),
    ),
    Report(
        "mortalidad_por_tipo_recuperacion", ("recuperado",),
        {"total_casos": CASES, "fallecidos": DEATHS, "tasa_letalidad": CFR},
        order=("-total_casos",),
    ),
    Report(
        "estado_salud_actual", ("estado", "recuperado"), {"total_casos": CASES}, order=("-total_casos",),
    ),
    Report(
        "departamentos_criticos", DEPARTMENT,
        {"casos": CASES, "fallecidos": DEATHS, "letalidad": CFR},
        derived={"categoria_severidad": SEVERITY},
        keep="categoria_severidad = 'ALTA'",
        order=("-letalidad",),
    ),
    Report(
        "indicadores_epidemiologicos", (*DEPARTMENT, *MONTH),
        {"casos": CASES, "fallecidos": DEATHS},
        derived={"casos_acumulados": f"sum(casos) {RUNNING_BY_DEPARTMENT}",
                 "fallecidos_acumulados": f"sum(fallecidos) {RUNNING_BY_DEPARTMENT}",
                 "cfr_acumulado": "try_divide(fallecidos_acumulados, casos_acumulados) * 100"},
        order=(*DEPARTMENT, *MONTH),
    ),
    # The running total of all cases, by day and by day and municipality; in ranges, not in one window over all rows.
    Report(
        "casos_acumulados_nacional", ("fecha_reporte",), {"casos": CASES},
        running={"casos_acumulados": "casos"},
        order=("fecha_reporte",),
    ),
    Report(
        "casos_acumulados_municipales", ("fecha_reporte", "codigo_municipio"), {"casos": CASES},
        running={"casos_acumulados": "casos"},
        order=("fecha_reporte", "codigo_municipio"),
    ),
]

SEX_RATIO = "ratio_sexo_edad"
REPORTS: dict[str, Report] = {r.name: r for r in _ALL}
EXTRA_REPORTS: dict[str, Report] = {r.name: r for r in _EXTRA}
# The 29th dataset has the sexes as columns.
DATASETS = (*REPORTS, SEX_RATIO)


def find_report(name: str) -> Report:
    for report in (*_ALL, *_EXTRA):
        if report.name == name:
            return report
        if report.fallback is not None and report.fallback.name == name:
            return report.fallback
    raise KeyError(name)


def dataset(
    df: DataFrame,
    name: str,
    thresholds: Thresholds = Thresholds(),
    vocabulary: Vocabulary = Vocabulary(),
) -> DataFrame | None:
    """Plan one result dataset by name."""
    if name == SEX_RATIO:
        return pivot_counts(df, "grupo_edad", "sexo", vocabulary.sexes)
    return run_report(df, find_report(name), thresholds, vocabulary)


def one_file(name: str) -> bool:
    """Whether code lists bound the rows of a dataset, so that its CSV copy is one file."""
    return name == SEX_RATIO or find_report(name).one_file


# Keys of the roll-ups that feed the datasets of a whole run.  Their domains are code lists, so the
# first one stays small at any number of cases; the second has one row per municipality.
DEMOGRAPHIC_KEYS = (
    *MONTH, *DEPARTMENT, "region", "poblacion_departamento", "grupo_edad", "sexo",
    "tipo_contagio", "ubicacion", "estado", "recuperado",
)
MUNICIPALITY_KEYS = (
    "codigo_municipio", "nombre_municipio", "nombre_departamento", "poblacion_municipio",
    "num_hospitales", "total_camas_uci", "total_camas_general",
)
# Everything else reads the cases themselves: weeks and days.
ROLLUP_OF = {
    name: MUNICIPALITY_KEYS
    for name in ("geografia_municipios_top50", "infraestructura_salud", "dashboard_kpis", "municipios_criticos")
} | {
    name: DEMOGRAPHIC_KEYS
    for name in (
        "temporal_mensual", "demografia_edad", "demografia_sexo", "demografia_edad_sexo",
        "geografia_departamentos", "geografia_regiones", "tipo_contagio", "ubicacion_casos",
        "estado_casos", "dashboard_evolucion", "dashboard_top_departamentos", "mortalidad_edad_sexo",
        "cfr_temporal_departamento", "recuperacion_por_tipo", "severidad_departamentos", "tasa_ataque",
        SEX_RATIO, "indice_gravedad", "sql_ranking_departamentos", "sql_evolucion_letalidad",
        "sql_edad_region", "sql_casos_acumulados", "mortalidad_departamento_mes",
        "mortalidad_por_tipo_recuperacion", "estado_salud_actual", "departamentos_criticos",
        "indicadores_epidemiologicos", "tiempo_diagnostico", "tiempo_recuperacion", "tiempo_diagnostico_muerte",
    )
}
