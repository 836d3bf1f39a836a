"""Names, value sets and schemas of the case line list and its dimensions.

Everything in this module is plain data.  The fixed values below must stay as they are for
results to agree with data and consumers that already exist; everything else takes them as
parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: raw column names accepted for each canonical column, first present wins ---
RAW_NAMES: dict[str, tuple[str, ...]] = {
    "fecha_reporte": ("fecha_reporte_web", "fecha_de_reporte_web"),
    "id_caso": ("id_de_caso", "id_caso"),
    "fecha_notificacion": ("fecha_de_notificacion", "fecha_de_notificaci_n"),
    "codigo_departamento": ("codigo_divipola_departamento", "departamento"),
    "nombre_departamento": ("nombre_departamento", "departamento_nom"),
    "codigo_municipio": ("codigo_divipola_municipio", "ciudad_municipio"),
    "nombre_municipio": ("nombre_municipio", "ciudad_municipio_nom"),
    "edad": ("edad",),
    "unidad_edad": ("unidad_de_medida_de_edad", "unidad_medida"),
    "sexo": ("sexo",),
    "tipo_contagio": ("tipo_de_contagio", "fuente_tipo_contagio"),
    "ubicacion": ("ubicacion_del_caso", "ubicacion"),
    "estado": ("estado",),
    "recuperado": ("recuperado",),
    "fecha_diagnostico": ("fecha_de_diagnostico", "fecha_diagnostico"),
    "fecha_recuperacion": ("fecha_de_recuperacion", "fecha_recuperado"),
    "fecha_inicio_sintomas": ("fecha_de_inicio_de_sintomas", "fecha_inicio_sintomas"),
    "fecha_muerte": ("fecha_de_muerte", "fecha_muerte"),
}

# --- Fixed values: field names of the raw JSON case records ---
RAW_JSON_FIELDS = (
    "fecha_reporte_web", "id_de_caso", "fecha_de_notificaci_n", "departamento", "departamento_nom",
    "ciudad_municipio", "ciudad_municipio_nom", "edad", "unidad_medida", "sexo",
    "fuente_tipo_contagio", "ubicacion", "estado", "recuperado", "fecha_diagnostico",
    "fecha_recuperado", "fecha_inicio_sintomas", "fecha_muerte",
)

# --- Fixed values: date patterns tried in this order ---
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy")
# Patterns also seen in exports of the same list; off unless asked for.
EXTRA_DATE_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSS", "d/M/yyyy H:mm:ss")

# --- Fixed values: age units (code -> units in a year) and age groups ---
AGE_UNITS = {"1": 1, "2": 12, "3": 365}
AGE_CUTS = (18, 30, 50, 65)
AGE_LABELS = ("0-17", "18-29", "30-49", "50-64", "65+")

# --- Fixed values: department spellings mapped to the name used in the dimension ---
DEPARTMENT_ALIASES = {
    "BOGOTA": "BOGOTA D.C.",
    "BOGOTÁ": "BOGOTA D.C.",
    "BOGOTA D.E.": "BOGOTA D.C.",
    "BARRANQUILLA": "ATLANTICO",
    "CARTAGENA": "BOLIVAR",
    "STA MARTA D.E.": "MAGDALENA",
    "SANTA MARTA": "MAGDALENA",
    "N SANTANDER": "NORTE DE SANTANDER",
    "NORTE SANTANDER": "NORTE DE SANTANDER",
    "LA GUAJIRA": "GUAJIRA",
    "GUAJIRA": "GUAJIRA",
}
DEPARTMENT_SUBSTRINGS = {"SAN ANDRES": "SAN ANDRES"}

# --- Fixed values: zone layout ---
RAW_CASES = "api/casos"
RAW_DIMENSIONS = {
    "departamentos": "mysql/departamentos",
    "municipios": "mysql/municipios",
    "hospitales": "mysql/hospitales",
}
TRUSTED_CASES = "covid_processed"
REFINED_ANALYTICS = "analytics"
REFINED_MODELS = "ml"

DATE_COLUMNS = tuple(c for c in RAW_NAMES if c.startswith("fecha_"))
ENRICHMENT_COLUMNS = (
    "poblacion_departamento", "densidad_poblacional", "region",
    "poblacion_municipio", "altitud_msnm", "categoria_municipio",
    "num_hospitales", "total_camas_uci", "total_camas_general",
)
DERIVED_COLUMNS = (
    "grupo_edad", "anio_reporte", "mes_reporte", "semana_reporte", "fallecido", "recuperado_flag",
)
CASE_COLUMNS = (*RAW_NAMES, "edad_anios", *ENRICHMENT_COLUMNS, *DERIVED_COLUMNS)


@dataclass(frozen=True)
class Vocabulary:
    """Values that mark an outcome in the line list (the defaults are the fixed values)."""

    deceased: tuple[str, ...] = ("Fallecido",)
    recovered: tuple[str, ...] = ("Recuperado",)
    severe: tuple[str, ...] = ("Grave",)
    moderate: tuple[str, ...] = ("Moderado",)
    hospital: tuple[str, ...] = ("Hospital", "UCI")
    hospital_label: tuple[str, ...] = ("Hospital", "UCI", "Hospital UCI")
    sexes: tuple[str, ...] = ("F", "M")


@dataclass(frozen=True)
class Thresholds:
    """Cut-offs of the reports (the defaults are the fixed values)."""

    month_cases: int = 50
    recovered_cases: int = 10
    critical_cases: int = 100
    critical_per_100k: float = 500.0
    high_cfr: float = 5.0
    medium_cfr: float = 3.0
    badge_high: float = 3.0
    badge_medium: float = 2.0
    weight_severe: float = 0.4
    weight_hospital: float = 0.3
    weight_cfr: float = 0.3
    top_departments: int = 10
    top_municipalities: int = 50
    cluster_cases: int = 100


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RAW_CASE_SCHEMA = _strings(RAW_JSON_FIELDS)

# --- Fixed values: dimension schemas (types as the relational source declares them) ---
DIMENSION_SCHEMAS = {
    "departamentos": T.StructType([
        T.StructField("id_departamento", T.IntegerType()),
        T.StructField("nombre_departamento", T.StringType()),
        T.StructField("codigo_dane", T.StringType()),
        T.StructField("poblacion_2020", T.LongType()),
        T.StructField("area_km2", T.DoubleType()),
        T.StructField("densidad_poblacional", T.DoubleType()),
        T.StructField("region", T.StringType()),
        T.StructField("capital", T.StringType()),
    ]),
    "municipios": T.StructType([
        T.StructField("id_municipio", T.IntegerType()),
        T.StructField("id_departamento", T.IntegerType()),
        T.StructField("nombre_municipio", T.StringType()),
        T.StructField("codigo_dane", T.StringType()),
        T.StructField("poblacion_2020", T.LongType()),
        T.StructField("altitud_msnm", T.LongType()),
        T.StructField("categoria", T.StringType()),
    ]),
    "hospitales": T.StructType([
        T.StructField("id_hospital", T.IntegerType()),
        T.StructField("nombre", T.StringType()),
        T.StructField("id_municipio", T.IntegerType()),
        T.StructField("nivel_atencion", T.StringType()),
        T.StructField("camas_uci", T.LongType()),
        T.StructField("camas_general", T.LongType()),
        T.StructField("tipo_institucion", T.StringType()),
    ]),
}
DIMENSION_KEYS = {
    "departamentos": "id_departamento",
    "municipios": "id_municipio",
    "hospitales": "id_hospital",
}
# (child table, child column, parent table, parent column)
FOREIGN_KEYS = (
    ("municipios", "id_departamento", "departamentos", "id_departamento"),
    ("hospitales", "id_municipio", "municipios", "id_municipio"),
)
