import json

import pytest
from pyspark.sql import Row

from vigia.model import DIMENSION_SCHEMAS, RAW_JSON_FIELDS
from vigia.session import get_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def raw_row(**values):
    """A raw case record; fields that are not given are null."""
    return {name: values.get(name) for name in RAW_JSON_FIELDS}


@pytest.fixture(scope="session")
def dimensions(spark):
    departments = [
        (5, "ANTIOQUIA", "05", 6000, 1.0, 105.0, "Andina", "Medellín"),
        (11, "BOGOTA D.C.", "11", 7000, 1.0, 4880.0, "Andina", "Bogotá"),
        (25, "CUNDINAMARCA", "25", 3000, 1.0, 143.0, "Andina", "Bogotá"),
        (8, "ATLANTICO", "08", 2000, 1.0, 748.0, "Caribe", "Barranquilla"),
        (80, "FICTICIO", "80", 0, 1.0, 1.0, None, None),
    ]
    municipalities = [
        (5001, 5, "MEDELLIN", "05001", 2500, 1495, "Especial"),
        (5088, 5, "ITAGUI", "05360", 280, 1640, "1"),
        (5079, 5, "BELLO", "05088", 500, 1450, "1"),
        (11001, 11, "BOGOTA D.C.", "11001", 7000, 2640, "Especial"),
    ]
    hospitals = [
        (1, "A", 5001, "Alto", 120, 450, "Privado"),
        (2, "B", 5001, "Alto", 80, 300, "Privado"),
        (3, "C", 5088, "Medio", 7, 70, "Público"),
        (4, "D", 11001, "Alto", 90, 500, "Público"),
    ]
    rows = {"departamentos": departments, "municipios": municipalities, "hospitales": hospitals}
    return {name: spark.createDataFrame(data, DIMENSION_SCHEMAS[name]) for name, data in rows.items()}


def table_rows(df, *order):
    """Rows as plain tuples, sorted."""
    columns = order or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))


def same_rows(left, right):
    """Equal as multisets."""
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def write_json_array(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(records, ensure_ascii=False, indent=2), encoding="utf-8")


def case_rows(spark, number=4000):
    """Trusted-like cases with an even spread of values, one department holding a third of them."""
    departments = ["ANTIOQUIA", "BOGOTA D.C.", "CUNDINAMARCA", "ATLANTICO", "META", "HUILA"]

    def one(i):
        department = departments[0] if i % 3 == 0 else departments[i % 6]
        age = None if i % 97 == 0 else float(i * 7 % 90)
        return Row(
            id_caso=str(i), nombre_departamento=department, codigo_departamento=str(departments.index(department)),
            nombre_municipio=f"M{i % 11}", codigo_municipio=str(i % 11), sexo="F" if i % 2 else "M",
            tipo_contagio=("Comunitaria", "Relacionado", "Importado")[i % 3], ubicacion=("Casa", "Hospital", "UCI")[i * i % 3],
            estado=("Leve", "Grave", "Moderado", "Fallecido")[(i * i + i // 5) % 4],
            recuperado="Recuperado" if i % 5 else "Activo", edad_anios=age,
            fecha=f"202{i % 2}-0{1 + i % 9}-1{i % 10}", region="Andina" if i % 4 else "Caribe",
            poblacion_departamento=1000 * (1 + departments.index(department)),
            densidad_poblacional=10.5 * (1 + departments.index(department)),
            poblacion_municipio=500 + i % 11, num_hospitales=1 + i % 11, total_camas_uci=i % 11, total_camas_general=10,
        )

    rows = spark.createDataFrame([one(i) for i in range(number)])
    from vigia.plans.etl import derive_cases

    dated = rows.selectExpr(
        "* EXCEPT (fecha)", "CAST(fecha AS DATE) AS fecha_reporte", "CAST(fecha AS DATE) AS fecha_inicio_sintomas",
        "date_add(CAST(fecha AS DATE), 3) AS fecha_diagnostico", "date_add(CAST(fecha AS DATE), 1) AS fecha_notificacion",
        "date_add(CAST(fecha AS DATE), 20) AS fecha_recuperacion", "date_add(CAST(fecha AS DATE), 9) AS fecha_muerte",
    )
    return derive_cases(dated)
