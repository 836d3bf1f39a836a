"""Query views over the published datasets.

Arguments of a view are values, never pieces of SQL text.  The definitions of ``ranking``,
``consolidated``, ``top_cfr``, ``critical_months``, ``region_comparison`` and
``affected_population`` are this library's own: only their names and purposes are given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigia.functions.dates import period_label
from vigia.functions.measures import level, rate, zero_if_missing
from vigia.functions.text import is_label, label_or
from vigia.model import Thresholds
from vigia.sources.files import entries

CATALOGUE = {
    "kpis": "National indicators",
    "department_detail": "One department",
    "ranking": "Departments ranked by cases",
    "regions": "Regions by cases",
    "temporal": "Monthly evolution",
    "consolidated": "Departments with their region and the national totals",
    "top_cfr": "Departments with the highest fatality rate",
    "critical_months": "Months with the most cases",
    "region_comparison": "Regions compared, with means per department",
    "affected_population": "Departments by share of population affected",
    "dashboard": "Departments with the fatality rate of their region",
    "region_distribution": "Cases of the regions that have a name",
    "ranked_table": "Dashboard rows with position and badge",
}


def _largest(df: DataFrame, measure: str, keys: Sequence[str], limit: int | None) -> DataFrame:
    ordered = df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(k).asc_nulls_first() for k in keys])
    return ordered if limit is None else ordered.limit(limit)


# Names under which the datasets and views are queried by SQL.
PUBLISHED_NAMES = (
    "dashboard_kpis", "geografia_departamentos", "geografia_regiones", "temporal_mensual",
    "geografia_municipios_top50",
)


def register(spark: SparkSession, folder: str) -> list[str]:
    """Temporary views over the written datasets, so that every query of the service runs as SQL.

    ``folder`` is the analytics folder of a run; returns the names registered.  A run without enrichment has no regions
    and populations: datasets and views that need them are left out.
    """
    there = {e.name for e in entries(spark, folder)}
    written = {
        name: spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
        for name in (*PUBLISHED_NAMES, "sql_ranking_departamentos") if f"{name}.parquet" in there
    }
    departments, regions_, months, summary, ranked = (written.get(name) for name in (
        "geografia_departamentos", "geografia_regiones", "temporal_mensual", "dashboard_kpis", "sql_ranking_departamentos"))
    named = {name: written[name] for name in PUBLISHED_NAMES if name in written}
    # View names.
    if ranked is not None:
        named["ranking_departamentos"] = ranked
    if months is not None:
        named["top_meses_criticos"] = critical_months(months)
    if departments is not None and {"region", "poblacion_departamento"} <= set(departments.columns):
        if regions_ is not None and summary is not None:
            named["vista_consolidada"] = consolidated(departments, regions_, summary, limit=None)
        named["top_departamentos_letalidad"] = top_cfr(departments)
        named["comparativa_regiones"] = region_comparison(departments)
        named["departamentos_poblacion"] = affected_population(departments, limit=None)
    for name, df in named.items():
        df.createOrReplaceTempView(name)
    return list(named)


def kpis(summary: DataFrame) -> DataFrame:
    return summary.limit(1)


def department_detail(departments: DataFrame, name: str) -> DataFrame:
    return departments.filter(F.col("nombre_departamento") == F.lit(name))


def ranking(ranked: DataFrame, limit: int = 20) -> DataFrame:
    return ranked.orderBy("ranking", F.col("nombre_departamento").asc_nulls_first(),
                          F.col("region").asc_nulls_first()).limit(limit)


def regions(by_region: DataFrame) -> DataFrame:
    return _largest(by_region, "total_casos", ["region"], None)


def temporal(by_month: DataFrame, limit: int | None = None) -> DataFrame:
    """Months in ascending order; with a limit the newest ones."""
    year, month = F.col("anio_reporte"), F.col("mes_reporte")
    if limit is not None:
        by_month = by_month.orderBy(year.desc_nulls_last(), month.desc_nulls_last()).limit(limit)
    return by_month.orderBy(year.asc_nulls_first(), month.asc_nulls_first())


def with_period(by_month: DataFrame) -> DataFrame:
    return by_month.withColumn("periodo", period_label(F.col("anio_reporte"), F.col("mes_reporte")))


def _region_totals(by_region: DataFrame) -> DataFrame:
    return by_region.select(
        F.col("region").alias("__region"),
        F.col("total_casos").alias("casos_region"),
        F.col("fallecidos").alias("fallecidos_region"),
    )


def consolidated(
    departments: DataFrame,
    by_region: DataFrame,
    summary: DataFrame,
    region: str | None = None,
    limit: int | None = 20,
) -> DataFrame:
    """Departments ⟕ regions, with the one row of national totals as scalar subqueries."""
    if region is not None:
        departments = departments.filter(F.col("region") == F.lit(region))
    joined = departments.join(
        _region_totals(by_region), departments["region"] == F.col("__region"), "left"
    ).drop("__region")

    def national(column: str) -> Column:
        return summary.select(column).scalar()

    total = joined.withColumns({
        "casos_nacional": national("total_casos"),
        "fallecidos_nacional": national("total_fallecidos"),
        "letalidad_nacional": national("tasa_letalidad_general"),
    })
    return _largest(total, "total_casos", ["nombre_departamento", "region", "poblacion_departamento"], limit)


def top_cfr(departments: DataFrame, limit: int = 20) -> DataFrame:
    return _largest(departments, "tasa_letalidad",
                    ["nombre_departamento", "region", "poblacion_departamento"], limit)


def top_cfr_rows(rows: DataFrame, limit: int = 10) -> DataFrame:
    """Dashboard rows with the highest fatality rate."""
    return _largest(rows, "tasa_letalidad", ["nombre_departamento", "region"], limit)


def top_per_100k(departments: DataFrame, limit: int = 10) -> DataFrame:
    return _largest(departments, "casos_por_100k", ["nombre_departamento", "region"], limit)


def critical_months(by_month: DataFrame, limit: int = 20) -> DataFrame:
    return _largest(by_month, "total_casos", ["anio_reporte", "mes_reporte"], limit)


def region_comparison(departments: DataFrame) -> DataFrame:
    grouped = departments.groupBy("region").agg(
        F.count(F.lit(1)).alias("num_departamentos"),
        F.sum("total_casos").alias("total_casos"),
        F.sum("fallecidos").alias("fallecidos"),
        F.avg("total_casos").alias("casos_promedio"),
        F.avg("tasa_letalidad").alias("letalidad_promedio"),
    )
    return _largest(
        grouped.withColumn("letalidad_regional", rate(F.col("fallecidos"), F.col("total_casos"))),
        "total_casos", ["region"], None,
    )


def affected_population(departments: DataFrame, limit: int | None = 20) -> DataFrame:
    share = rate(F.col("total_casos"), F.col("poblacion_departamento"))
    return _largest(
        departments.select(
            "nombre_departamento", "region", "poblacion_departamento", "total_casos",
            share.alias("porcentaje_afectado"),
        ),
        "porcentaje_afectado", ["nombre_departamento", "region"], limit,
    )


def dashboard(departments: DataFrame, by_region: DataFrame, limit: int | None = 50) -> DataFrame:
    """Departments ⟕ regions by fatality rate, every gap filled for display."""
    joined = departments.join(
        _region_totals(by_region), departments["region"] == F.col("__region"), "left"
    ).withColumn("letalidad_region", rate(F.col("fallecidos_region"), F.col("casos_region")))
    top = _largest(joined, "tasa_letalidad", ["nombre_departamento", "region"], limit)
    return top.select(
        label_or(F.col("nombre_departamento"), "N/A").alias("nombre_departamento"),
        label_or(F.col("region"), "Sin región").alias("region"),
        *[zero_if_missing(F.col(c), "bigint").alias(c) for c in ("total_casos", "fallecidos")],
        *[zero_if_missing(F.col(c), "double").alias(c) for c in ("tasa_letalidad", "casos_por_100k")],
        zero_if_missing(F.col("casos_region"), "bigint").alias("casos_region"),
        zero_if_missing(F.col("letalidad_region"), "double").alias("letalidad_region"),
    )


def region_distribution(by_region: DataFrame) -> DataFrame:
    return _largest(
        by_region.filter(is_label(F.col("region"))).select("region", "total_casos"),
        "total_casos", ["region"], None,
    )


def ranked_table(rows: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Position by fatality rate and a badge; ``rows`` is the dashboard view without limit, one row per department."""
    order = Window.orderBy(F.col("tasa_letalidad").desc_nulls_last(), "nombre_departamento", "region")
    badge = level(
        F.col("tasa_letalidad"),
        [(thresholds.badge_high, "badge-high"), (thresholds.badge_medium, "badge-medium")],
        "badge-low",
    )
    return rows.select(F.row_number().over(order).alias("posicion"), "*", badge.alias("nivel")).orderBy("posicion")
