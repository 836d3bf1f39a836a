"""Raw line list -> trusted cases: clean, enrich, derive.

Every function maps DataFrames to a DataFrame and runs nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigia.functions.dates import calendar_parts, parse_date
from vigia.functions.measures import age_in_years, bucket_label, indicator
from vigia.functions.text import canonical_name, normalise_headers, pad_code
from vigia.model import (
    DATE_COLUMNS,
    DATE_FORMATS,
    DEPARTMENT_ALIASES,
    DEPARTMENT_SUBSTRINGS,
    RAW_NAMES,
    Vocabulary,
)
from vigia.operators.dedup import keep_first
from vigia.operators.lookup import join_any, join_first_match, lookup


def pick_column(df: DataFrame, names: Sequence[str]) -> Column:
    """The first of the names the table has, else a NULL string."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    return F.lit(None).cast("string")


def canonical_columns(raw: DataFrame) -> DataFrame:
    """Project any known spelling of the raw columns to the 18 canonical ones."""
    df = normalise_headers(raw)
    return df.select(*[pick_column(df, names).alias(name) for name, names in RAW_NAMES.items()])


def parse_columns(df: DataFrame, date_formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Dates as dates, age in years beside the age as given.

    The parser stands once in the plan, for an array of all dates of a row.  Written out for each column, it and whatever makes
    the rows become one method that is too long for the JVM to compile, and every row is interpreted.
    """
    texts = F.array(*[F.col(c).cast("string") for c in DATE_COLUMNS])
    dates = df.withColumn("__dates", F.transform(texts, lambda text: parse_date(text, date_formats)))
    return dates.withColumns({
        **{c: F.get("__dates", F.lit(k)) for k, c in enumerate(DATE_COLUMNS)},
        "edad_anios": age_in_years(F.col("edad"), F.col("unidad_edad")),
    }).drop("__dates")


def clean_cases(
    raw: DataFrame,
    date_formats: Sequence[str] = DATE_FORMATS,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Canonical, parsed cases, one row per case id, with a department code.

    Rows without a department code can't stay and are no rivals either.  Of several others with one id the first in
    ``order`` stays (default: all other columns, which leaves no ties between different rows), a value before
    a NULL and so a readable date before an unreadable one.  Rows without a code come last in the order and go after
    it: filtered before, the condition would be pushed below the joins and parsers that made the rows.
    """
    parsed = parse_columns(canonical_columns(raw), date_formats)
    order = list(order) if order else [c for c in parsed.columns if c != "id_caso"]
    unknown = F.col("codigo_departamento").isNull()
    return keep_first(parsed, ["id_caso"], [unknown, *order]).filter(~unknown)


def hospital_capacity(hospitals: DataFrame) -> DataFrame:
    """Hospitals and beds per municipality."""
    return hospitals.groupBy("id_municipio").agg(
        F.count(F.lit(1)).alias("num_hospitales"),
        F.sum("camas_uci").alias("total_camas_uci"),
        F.sum("camas_general").alias("total_camas_general"),
    )


def with_department(
    cases: DataFrame,
    departments: DataFrame,
    aliases: Mapping[str, str] = DEPARTMENT_ALIASES,
    substrings: Mapping[str, str] = DEPARTMENT_SUBSTRINGS,
    first_match: bool = False,
) -> DataFrame:
    """Population, density and region of the department.

    The default matches the code or the name, so a case whose code and name point to different
    departments comes out twice.  ``first_match`` uses the name only where the code is unknown.
    """
    dimension = departments.select(
        "codigo_dane",
        F.upper(F.trim("nombre_departamento")).alias("nombre"),
        F.col("poblacion_2020").alias("poblacion_departamento"),
        "densidad_poblacional",
        "region",
    )
    match = join_first_match if first_match else join_any
    return match(
        cases,
        dimension,
        pad_code(F.col("codigo_departamento"), 2),
        canonical_name(F.col("nombre_departamento"), aliases, substrings),
        "codigo_dane",
        "nombre",
    )


def with_municipality(cases: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Population, altitude and category of the municipality, by its 5-digit code."""
    dimension = municipalities.select(
        "codigo_dane",
        F.col("poblacion_2020").alias("poblacion_municipio"),
        "altitud_msnm",
        F.col("categoria").alias("categoria_municipio"),
    )
    return lookup(cases, dimension, pad_code(F.col("codigo_municipio"), 5), "codigo_dane")


def with_capacity(
    cases: DataFrame, hospitals: DataFrame, municipalities: DataFrame | None = None
) -> DataFrame:
    """Hospital capacity of the municipality.

    By default the code of the case is compared with the municipality id, number with number.  Ids
    and codes are two different systems in the dimension; pass ``municipalities`` to go from id to
    code through it.
    """
    capacity = hospital_capacity(hospitals)
    if municipalities is None:
        capacity = capacity.withColumn("id_municipio", F.col("id_municipio").cast("bigint"))
        return lookup(cases, capacity, F.col("codigo_municipio").try_cast("bigint"), "id_municipio")
    codes = municipalities.select("id_municipio", "codigo_dane")
    capacity = capacity.join(codes, "id_municipio").drop("id_municipio")
    return lookup(cases, capacity, pad_code(F.col("codigo_municipio"), 5), "codigo_dane")


def enrich_cases(
    cases: DataFrame,
    departments: DataFrame | None,
    municipalities: DataFrame | None,
    hospitals: DataFrame | None,
    aliases: Mapping[str, str] = DEPARTMENT_ALIASES,
    substrings: Mapping[str, str] = DEPARTMENT_SUBSTRINGS,
    first_match: bool = False,
) -> DataFrame:
    """All three lookups; without one of the dimensions the cases stay as they are."""
    if departments is None or municipalities is None or hospitals is None:
        return cases
    df = with_department(cases, departments, aliases, substrings, first_match)
    df = with_municipality(df, municipalities)
    return with_capacity(df, hospitals)


def derived_columns(vocabulary: Vocabulary = Vocabulary()) -> dict[str, Column]:
    """Age group, report period and outcome flags as expressions over canonical columns."""
    return {
        "grupo_edad": bucket_label(F.col("edad_anios")),
        **calendar_parts(F.col("fecha_reporte"), suffix="_reporte"),
        "fallecido": indicator(F.col("estado"), vocabulary.deceased),
        "recuperado_flag": indicator(F.col("recuperado"), vocabulary.recovered),
    }


def derive_cases(cases: DataFrame, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    return cases.withColumns(derived_columns(vocabulary))


def unmatched_aliases(departments: DataFrame, aliases: Mapping[str, str] = DEPARTMENT_ALIASES) -> DataFrame:
    """Alias targets that no department of the dimension is called."""
    spark = departments.sparkSession
    targets = spark.createDataFrame([(t,) for t in sorted(set(aliases.values()))], "nombre string")
    names = departments.select(F.upper(F.trim("nombre_departamento")).alias("nombre"))
    return targets.join(names, "nombre", "left_anti")
