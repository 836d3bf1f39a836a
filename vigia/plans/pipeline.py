"""The batch job: etl, analytics, models, publish, gated in this order.

A stage that fails stops the run; only the models are optional.  Each written dataset leaves a row
in the audit, with the rows counted in the written files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigia.model import (
    DATE_FORMATS,
    DEPARTMENT_ALIASES,
    DEPARTMENT_SUBSTRINGS,
    DIMENSION_SCHEMAS,
    RAW_CASE_SCHEMA,
    RAW_CASES,
    RAW_DIMENSIONS,
    REFINED_ANALYTICS,
    REFINED_MODELS,
    TRUSTED_CASES,
    Thresholds,
    Vocabulary,
)
from vigia.operators.changes import snapshot_changes
from vigia.operators.lookup import coverage
from vigia.operators.report import rollup
from vigia.plans import models
from vigia.plans.etl import clean_cases, derived_columns, enrich_cases
from vigia.plans.manifest import FOLDER, Manifest
from vigia.plans.reports import (
    DATASETS,
    DEMOGRAPHIC_KEYS,
    EXTRA_REPORTS,
    MUNICIPALITY_KEYS,
    ROLLUP_OF,
    dataset,
    one_file,
)
from vigia.sources.files import remove_path
from vigia.sources.readers import latest_snapshot, read_cases, read_latest, unfitting_values
from vigia.sources.scratch import scratch_path
from vigia.sources.writers import publish, remove_result, save_if_any, save_result, write_cases, write_parquet

# The datasets that become warehouse tables.
PUBLISHED = ("temporal_mensual", "geografia_departamentos", "dashboard_kpis")


#: Stands for the month of a case without a report date.
NO_MONTH = -1


@dataclass(frozen=True)
class Zones:
    """Root folders of the three zones."""

    raw: str
    trusted: str
    refined: str

    @property
    def cases(self) -> str:
        return f"{self.trusted.rstrip('/')}/{TRUSTED_CASES}"

    @property
    def analytics(self) -> str:
        return f"{self.refined.rstrip('/')}/{REFINED_ANALYTICS}"

    @property
    def models(self) -> str:
        return f"{self.refined.rstrip('/')}/{REFINED_MODELS}"


@dataclass(frozen=True)
class Settings:
    thresholds: Thresholds = Thresholds()
    vocabulary: Vocabulary = Vocabulary()
    date_formats: tuple[str, ...] = DATE_FORMATS
    first_match: bool = False       # department by code, else name, instead of either
    extra_reports: bool = False
    use_rollups: bool = True
    parallel: int = 8               # results or models worked on at the same time
    trees: int = models.MORTALITY_TREES


@dataclass
class Audit:
    """What a run did: (stage, item, rows, status, message)."""

    rows: list[tuple] = field(default_factory=list)

    def add(self, stage: str, item: str, rows: int | None, status: str = "ok", message: str = "") -> None:
        self.rows.append((stage, item, rows, status, message))

    def table(self, spark: SparkSession) -> DataFrame:
        schema = "stage string, item string, rows bigint, status string, message string"
        return spark.createDataFrame(self.rows, schema)


def _dimension(spark: SparkSession, zones: Zones, name: str) -> DataFrame | None:
    """A landed dimension, or ``None`` if nothing was landed.  Any other error goes up."""
    try:
        return read_latest(spark, f"{zones.raw.rstrip('/')}/{RAW_DIMENSIONS[name]}", DIMENSION_SCHEMAS[name])
    except FileNotFoundError:
        return None


def _snapshots(spark: SparkSession, zones: Zones) -> list[str]:
    """The snapshots that a run of the ETL reads now."""
    found = []
    for folder in (RAW_CASES, *RAW_DIMENSIONS.values()):
        try:
            found.append(latest_snapshot(spark, f"{zones.raw.rstrip('/')}/{folder}"))
        except FileNotFoundError:
            continue
    return found


def manifest_of(spark: SparkSession, zones: Zones, settings: Settings) -> Manifest:
    """What earlier runs into these zones have finished with the same settings."""
    return Manifest(spark, zones.refined, repr(replace(settings, parallel=0)))


def run_etl(spark: SparkSession, zones: Zones, settings: Settings = Settings(),
            audit: Audit | None = None, manifest: Manifest | None = None) -> Audit:
    """Newest raw list and dimensions -> trusted cases by year and month; nothing if ``manifest`` proves that they are written."""
    audit = audit or Audit()
    snapshots = _snapshots(spark, zones) if manifest else []
    if manifest and (known := manifest.proves("etl", TRUSTED_CASES, snapshots)) is not None:
        audit.rows += known
        return audit
    began, first = manifest.begin(snapshots) if manifest else {}, len(audit.rows)
    raw = read_latest(spark, f"{zones.raw.rstrip('/')}/{RAW_CASES}", RAW_CASE_SCHEMA, csv_as_strings=True)
    dimensions = {name: _dimension(spark, zones, name) for name in RAW_DIMENSIONS}
    for name, df in dimensions.items():
        if df is None:
            audit.add("etl", name, None, "absent", "cases are not enriched")
            continue
        for column, rows in unfitting_values(spark, f"{zones.raw.rstrip('/')}/{RAW_DIMENSIONS[name]}", DIMENSION_SCHEMAS[name]).items():
            audit.add("etl", f"{name}.{column}", rows, "unfitting", "values that are not of the declared type are NULL")
    cases = enrich_cases(
        clean_cases(raw, settings.date_formats),
        dimensions["departamentos"], dimensions["municipios"], dimensions["hospitales"],
        first_match=settings.first_match,
    )
    rows = write_cases(cases, zones.cases, derived=derived_columns(settings.vocabulary))
    audit.add("etl", TRUSTED_CASES, rows)
    written = read_cases(spark, zones.cases)
    if "poblacion_departamento" in written.columns:
        found = coverage(written, ["poblacion_departamento"]).first()
        audit.add("etl", "enriched", found["con_poblacion_departamento"])
    if manifest:
        manifest.record("etl", TRUSTED_CASES, began, [zones.cases], audit.rows[first:])
    return audit


def cleaned_list(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The cleaned cases of a raw list with their report month as ``__period``, written to the scratch folder and read back."""
    path = scratch_path(raw.sparkSession, "clean")
    cases = clean_cases(raw, settings.date_formats)
    period = F.struct(F.year("fecha_reporte").alias("anio"), F.month("fecha_reporte").alias("mes"))
    cases.withColumn("__period", period).write.parquet(path)
    return raw.sparkSession.read.parquet(path)


def refresh_cases(spark: SparkSession, old: DataFrame, new: DataFrame, dimensions: Mapping[str, DataFrame | None], root: str,
                  settings: Settings = Settings(), aliases: Mapping[str, str] = DEPARTMENT_ALIASES,
                  substrings: Mapping[str, str] = DEPARTMENT_SUBSTRINGS) -> list[tuple[int | None, int | None]]:
    """Bring the trusted cases below ``root``, written from the raw list ``old``, to the raw list ``new``.

    Both lists are cleaned, and the ids whose row is new, changed or gone tell which report months are touched, before or
    now.  Only these months are enriched, derived and written, each in place of what it was; a month without cases any more goes.
    The result is that of a whole run over ``new``, given that the dimensions are the same.  Returns the (year, month) pairs touched,
    NULL for cases without a report date.  ``old`` may be the ``cleaned_list`` that the trusted cases were made of; it is not cleaned again.
    """
    before, now = old if "__period" in old.columns else cleaned_list(old, settings), cleaned_list(new, settings)
    found = snapshot_changes(before, now, ["id_caso"], carried=["__period"])
    # Months, not cases: the struct of a row that is not there is NULL, that of a row without date has NULLs inside.
    both = found.select(F.explode(F.array("__period_antes", "__period_ahora")).alias("period")).where("period IS NOT NULL").distinct()
    touched = both.select("period.anio", "period.mes")
    months = sorted(((r["anio"], r["mes"]) for r in touched.collect()), key=lambda m: (m[0] or 0, m[1] or 0))
    if not months:
        return []
    # One number for each month, so that the condition stays short however many there are.
    number = F.coalesce(F.year("fecha_reporte") * 12 + F.month("fecha_reporte"), F.lit(NO_MONTH))
    wanted = number.isin([NO_MONTH if year is None else year * 12 + month for year, month in months])
    cases = enrich_cases(now.filter(wanted).drop("__period"), dimensions["departamentos"], dimensions["municipios"], dimensions["hospitales"],
                         aliases=aliases, substrings=substrings, first_match=settings.first_match)
    left = {(r["anio"], r["mes"]) for r in now.filter(wanted).select("__period.*").distinct().collect()}
    write_cases(cases, root, replace_only_present=True, derived=derived_columns(settings.vocabulary))
    for year, month in months:
        if (year, month) not in left:
            named = [f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in (("anio_reporte", year), ("mes_reporte", month))]
            remove_path(spark, "/".join([root.rstrip("/"), *named]))
    return months


def write_rollups(cases: DataFrame, zones: Zones, vocabulary: Vocabulary) -> dict[tuple[str, ...], DataFrame]:
    """Sums of the cases by the keys most datasets need, written once and read by all of them."""
    spark = cases.sparkSession
    result = {}
    for label, wanted in (("demografico", DEMOGRAPHIC_KEYS), ("municipal", MUNICIPALITY_KEYS)):
        keys = [k for k in wanted if k in cases.columns]
        summed = rollup(cases, keys, vocabulary)
        path = f"{zones.analytics}/rollup_{label}.parquet"
        write_parquet(summed, path)
        result[wanted] = spark.read.schema(summed.schema).parquet(path)
    return result


def run_analytics(spark: SparkSession, zones: Zones, settings: Settings = Settings(), audit: Audit | None = None,
                  names: Sequence[str] | None = None, manifest: Manifest | None = None) -> Audit:
    """Trusted cases -> result datasets, each as parquet and CSV; those that ``manifest`` proves are left as they are."""
    audit = audit or Audit()
    cases = read_cases(spark, zones.cases)
    names = list(names or (*DATASETS, *(EXTRA_REPORTS if settings.extra_reports else ())))
    began = manifest.begin([zones.cases]) if manifest else {}
    known = {name: manifest.proves("analytics", name, [zones.cases]) for name in names} if manifest else {}
    open_ = [name for name in names if known.get(name) is None]
    rollups = write_rollups(cases, zones, settings.vocabulary) if settings.use_rollups and open_ else {}

    def run(name: str) -> list[tuple]:
        if known.get(name) is not None:
            return known[name]
        source = rollups.get(ROLLUP_OF.get(name), cases)
        result = dataset(source, name, settings.thresholds, settings.vocabulary)
        target = "sql_edad_departamento" if name == "sql_edad_region" and "region" not in cases.columns else name
        # Only the regions have an empty stand-in; any other result is written as it is.
        if result is None or name == "geografia_regiones":
            rows = save_if_any(spark, result, zones.analytics, target)
        else:
            rows = save_result(result, zones.analytics, target, one_file(name))
        done = Audit()
        done.add("analytics", target, rows, "ok" if rows is not None else "skipped")
        if manifest:
            outputs = [f"{zones.analytics}/{target}.{kind}" for kind in ("parquet", "csv")]
            manifest.record("analytics", name, began, outputs, done.rows)
        return done.rows

    with ThreadPoolExecutor(settings.parallel) as pool:
        for rows in pool.map(run, names):
            audit.rows += rows
    return audit


def run_models(spark: SparkSession, zones: Zones, settings: Settings = Settings(),
               audit: Audit | None = None, manifest: Manifest | None = None) -> Audit:
    """Trusted cases -> predictions, clusters and metrics; nothing if ``manifest`` proves that all of them are written."""
    audit = audit or Audit()
    if manifest and (known := manifest.proves("models", "all", [zones.cases])) is not None:
        audit.rows += known
        return audit
    began, start = manifest.begin([zones.cases]) if manifest else {}, len(audit.rows)
    cases = models.prepare_cases(read_cases(spark, zones.cases))
    vocabulary, thresholds = settings.vocabulary, settings.thresholds
    with ThreadPoolExecutor(settings.parallel) as pool:
        fits = {
            "predictions_mortality": pool.submit(models.mortality_model, cases, trees=settings.trees),
            "predictions_severity": pool.submit(models.severity_model, cases, vocabulary, trees=settings.trees),
            "predictions_hospitalization": pool.submit(models.hospitalization_model, cases, vocabulary),
            "clusters_departamentos": pool.submit(models.cluster_departments, cases, thresholds, vocabulary),
            "clusters_grupos_poblacionales": pool.submit(models.cluster_groups, cases, thresholds, vocabulary),
        }
    done = {}
    for name, fit in fits.items():
        try:
            done[name] = fit.result()
        except Exception as error:  # noqa: BLE001 - one model that fails is no reason to lose the others
            audit.add("models", name, None, "failed", str(error).splitlines()[0][:500])
            done[name] = None
    mortality, severity, hospital = (done[f"predictions_{name}"] for name in ("mortality", "severity", "hospitalization"))
    for name, fitted in list(done.items())[:3]:
        if fitted is None:
            remove_result(spark, zones.models, name)
            continue
        df = fitted.predictions
        audit.add("models", name, save_result(df, zones.models, name, one_file=False))
        undecided = spark.read.parquet(f"{zones.models}/{name}.parquet").where("prediction IS NULL").count()
        if undecided:
            audit.add("models", f"{name}_undecided", undecided, "undecided", "cases without all features get no prediction")
    if hospital is not None and hospital.warning:
        audit.add("models", "predictions_hospitalization", None, "warning", hospital.warning)
    for members_name, profile_name, clustered in (
        ("clusters_departamentos", "clusters_analisis_departamentos", done["clusters_departamentos"]),
        ("clusters_grupos_poblacionales", "clusters_analisis_poblacional", done["clusters_grupos_poblacionales"]),
    ):
        if clustered is None:
            remove_result(spark, zones.models, members_name)
            remove_result(spark, zones.models, profile_name)
            if not any(row[:2] == ("models", members_name) for row in audit.rows):
                audit.add("models", members_name, None, "skipped", "too few groups or no dimension")
            continue
        audit.add("models", members_name, save_result(clustered.members, zones.models, members_name))
        audit.add("models", profile_name, save_result(clustered.profile, zones.models, profile_name))
    metrics = models.metrics_row(mortality, severity, hospital, spark)
    audit.add("models", "ml_metrics_completas", save_result(metrics, zones.models, "ml_metrics_completas"))
    # A model that failed is tried again by the next run.
    if manifest and not any(row[3] == "failed" for row in audit.rows[start:]):
        manifest.record("models", "all", began, [zones.models], audit.rows[start:])
    return audit


def run_publish(spark: SparkSession, zones: Zones, audit: Audit | None = None,
                database: str | None = None, tables_root: str | None = None) -> Audit:
    """Written datasets -> catalogue tables, contents replaced."""
    audit = audit or Audit()
    for name in PUBLISHED:
        df = spark.read.parquet(f"{zones.analytics}/{name}.parquet")
        table = f"{database}.{name}" if database else name
        publish(df, table, f"{tables_root.rstrip('/')}/{name}" if tables_root else None)
        audit.add("publish", table, None)
    return audit


def run_all(spark: SparkSession, zones: Zones, settings: Settings = Settings(),
            database: str | None = None, tables_root: str | None = None, resume: bool = False) -> DataFrame:
    """The whole job; returns the audit, which is written to the refined zone as well.

    Every run notes in a manifest what it has finished.  ``resume`` leaves out what the manifest proves to be there
    (same settings, inputs and outputs untouched since), with the audit rows it had; publishing is done in any case.
    """
    audit = Audit()
    manifest = manifest_of(spark, zones, settings)
    if not resume:
        remove_path(spark, f"{zones.refined.rstrip('/')}/{FOLDER}")
    try:
        run_etl(spark, zones, settings, audit, manifest)
        run_analytics(spark, zones, settings, audit, manifest=manifest)
        try:
            run_models(spark, zones, settings, audit, manifest)
        except Exception as error:  # noqa: BLE001 - the models are optional, whatever goes wrong
            audit.add("models", "stage", None, "failed", str(error).splitlines()[0][:500])
        run_publish(spark, zones, audit, database, tables_root)
    finally:
        if audit.rows:
            audit.table(spark).coalesce(1).write.mode("overwrite").parquet(
                f"{zones.refined.rstrip('/')}/audit.parquet"
            )
    return audit.table(spark)
