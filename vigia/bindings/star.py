"""The case line list over an order star schema (one case per line item).

``case_fact`` joins only the tables that the asked-for columns come from.  All of them are LEFT
lookups by a unique key, so leaving one out cannot change the rows.  Orders take their customer
and nation before they meet the line items: those tables are a fraction of the line items, which
are then shuffled once for orders (and once more for parts where ages are needed) at most.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigia.functions.measures import age_in_years
from vigia.model import CASE_COLUMNS, Thresholds, Vocabulary
from vigia.operators.lookup import lookup
from vigia.operators.report import Report, mentions, required_columns, state_columns, with_states
from vigia.plans.etl import derived_columns, hospital_capacity
from vigia.sources.scratch import scratch_path
from vigia.sources.writers import write_parquet

VOCABULARY = Vocabulary(
    deceased=("R",),
    recovered=("O",),
    severe=("A",),
    moderate=("N",),
    hospital=("BUILDING", "MACHINERY"),
    hospital_label=("BUILDING", "MACHINERY", "FURNITURE"),
    sexes=("F", "O"),
)
# Cut-offs that keep some groups and drop others at every scale of the tables.
THRESHOLDS = Thresholds(month_cases=30, critical_cases=40, critical_per_100k=500.0,
                        high_cfr=34.0, medium_cfr=33.0, badge_high=34.0, badge_medium=33.0)

# Case column -> (tables behind it, SQL over their columns)
_COLUMNS: dict[str, tuple[tuple[str, ...], str]] = {
    "id_caso": ((), "l_orderkey * 10 + l_linenumber"),
    "fecha_reporte": (("orders",), "CAST(o_orderdate AS DATE)"),
    "fecha_inicio_sintomas": (("orders",), "CAST(o_orderdate AS DATE)"),
    "fecha_diagnostico": ((), "CAST(l_shipdate AS DATE)"),
    "fecha_notificacion": (("orders",), "date_add(CAST(o_orderdate AS DATE), l_linenumber)"),
    "fecha_recuperacion": (
        ("orders", "part"),
        "CASE WHEN o_orderstatus = 'O' THEN date_add(CAST(l_shipdate AS DATE), p_size) END",
    ),
    "fecha_muerte": (
        (), "CASE WHEN l_returnflag = 'R' THEN date_add(CAST(l_shipdate AS DATE), CAST(l_quantity AS INT)) END",
    ),
    "codigo_departamento": (("customer",), "c_nationkey"),
    "nombre_departamento": (("nation",), "n_name"),
    "codigo_municipio": (("customer",), "c_custkey"),
    "nombre_municipio": (("customer",), "c_name"),
    "edad": ((), "l_quantity * 2"),
    "unidad_edad": (
        ("part",), "CASE WHEN p_size % 10 = 0 THEN '2' WHEN p_size % 10 = 1 THEN '3' ELSE '1' END",
    ),
    "sexo": ((), "l_linestatus"),
    "tipo_contagio": (("orders",), "o_orderpriority"),
    "ubicacion": (("customer",), "c_mktsegment"),
    "estado": ((), "l_returnflag"),
    "recuperado": (("orders",), "o_orderstatus"),
    "poblacion_departamento": (("nation",), "poblacion_departamento"),
    "densidad_poblacional": (("nation",), "densidad_poblacional"),
    "region": (("nation",), "region"),
    "poblacion_municipio": (("customer",), "1000 + CAST(floor(abs(c_acctbal) * 10) AS BIGINT)"),
    "altitud_msnm": (("customer",), "CAST(c_nationkey AS BIGINT) * 100"),
    "categoria_municipio": (("customer",), "c_mktsegment"),
    "num_hospitales": (("supplier",), "num_hospitales"),
    "total_camas_uci": (("supplier",), "total_camas_uci"),
    "total_camas_general": (("supplier",), "total_camas_general"),
}
_DERIVED_FROM = {
    "edad_anios": ("edad", "unidad_edad"),
    "grupo_edad": ("edad_anios", "edad", "unidad_edad"),
    "anio_reporte": ("fecha_reporte",),
    "mes_reporte": ("fecha_reporte",),
    "semana_reporte": ("fecha_reporte",),
    "fallecido": ("estado",),
    "recuperado_flag": ("recuperado",),
}


# Declared, so that planning a query needs no job that looks for the schema.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Department dimension: nations with their region and 1000 inhabitants per customer."""
    population = (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey")
        .agg((F.count(F.lit(1)) * 1000).alias("poblacion_2020"))
    )
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    df = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    df = df.join(population, df["n_nationkey"] == population["c_nationkey"], "left")
    return df.select(
        F.col("n_nationkey").alias("id_departamento"),
        F.col("n_name").alias("nombre_departamento"),
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("codigo_dane"),
        "poblacion_2020",
        (F.col("poblacion_2020") / (F.col("n_nationkey") + 1)).alias("densidad_poblacional"),
        F.col("r_name").alias("region"),
    )


def stored_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The department dimension, written to the scratch folder and read back.

    Spark guesses the size of what ``departments`` makes from that of all customers, and beyond some number of these it would shuffle the
    cases, once by code and once by name, to join a few dozen rows.  Of a written table it knows the size.
    """
    path = scratch_path(spark, "departamentos")
    df = departments(spark, sf_dir)
    write_parquet(df, path)
    return spark.read.schema(df.schema).parquet(path)


def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipality dimension: customers; the code is the key with 5 digits, longer keys kept whole."""
    key = F.col("c_custkey").cast("string")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id_municipio"),
        F.col("c_nationkey").alias("id_departamento"),
        F.col("c_name").alias("nombre_municipio"),
        F.when(F.length(key) < 5, F.lpad(key, 5, "0")).otherwise(key).alias("codigo_dane"),
        F.expr(_COLUMNS["poblacion_municipio"][1]).alias("poblacion_2020"),
        F.expr(_COLUMNS["altitud_msnm"][1]).alias("altitud_msnm"),
        F.col("c_mktsegment").alias("categoria"),
    )


def hospitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hospital dimension: suppliers."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id_hospital"),
        F.col("s_name").alias("nombre"),
        F.col("s_suppkey").alias("id_municipio"),
        F.floor(F.abs("s_acctbal") / 100).cast("bigint").alias("camas_uci"),
        (F.col("s_suppkey") % 50 * 10).alias("camas_general"),
    )


def _closure(columns: Iterable[str]) -> list[str]:
    wanted = set(columns)
    for column in columns:
        wanted.update(_DERIVED_FROM.get(column, ()))
    unknown = wanted - set(CASE_COLUMNS)
    if unknown:
        raise ValueError(f"no case columns: {sorted(unknown)}")
    return [c for c in CASE_COLUMNS if c in wanted]


def _customer_side(spark: SparkSession, sf_dir: str, tables: set[str]) -> DataFrame:
    """Customers with as much of nation and hospitals as asked for."""
    customer = table(spark, sf_dir, "customer")
    if "nation" in tables:
        nations = departments(spark, sf_dir).select(
            "id_departamento",
            F.col("nombre_departamento").alias("n_name"),
            F.col("poblacion_2020").alias("poblacion_departamento"),
            "densidad_poblacional",
            "region",
        )
        customer = lookup(customer, nations, F.col("c_nationkey"), "id_departamento")
    if "supplier" in tables:
        capacity = hospital_capacity(hospitals(spark, sf_dir))
        customer = lookup(customer, capacity, F.col("c_custkey"), "id_municipio")
    return customer


def _order_side(spark: SparkSession, sf_dir: str, tables: set[str]) -> DataFrame:
    """Orders with their customer, if asked for."""
    orders = table(spark, sf_dir, "orders")
    if not tables & {"customer", "nation", "supplier"}:
        return orders
    customer = _customer_side(spark, sf_dir, tables)
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")


def _with_part(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return lines.join(part, lines["l_partkey"] == part["p_partkey"], "left")


def _tables(columns: Iterable[str]) -> set[str]:
    return {t for c in columns for t in _COLUMNS[c][0]}


def _with_derived(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add the derived columns among ``columns``; the age first, as the age group builds on it."""
    derived = derived_columns(VOCABULARY)
    if "edad_anios" in columns:
        df = df.withColumn("edad_anios", age_in_years(F.col("edad"), F.col("unidad_edad")))
    return df.withColumns({c: derived[c] for c in columns if c in derived})


def case_fact(
    spark: SparkSession,
    sf_dir: str,
    columns: Iterable[str] = CASE_COLUMNS,
    lines: DataFrame | None = None,
) -> DataFrame:
    """Cases with the given columns; ``lines`` replaces the line items, e.g. deduplicated ones."""
    columns = list(columns)
    wanted = _closure(columns)
    stored = [c for c in wanted if c in _COLUMNS]
    tables = _tables(stored)
    fact = table(spark, sf_dir, "lineitem") if lines is None else lines
    # Where neither is broadcast, the lines cross the network for their parts before they have the columns of orders and customers.
    if "part" in tables:
        fact = _with_part(spark, sf_dir, fact)
    if tables - {"part"}:
        orders = _order_side(spark, sf_dir, tables)
        fact = fact.join(orders, fact["l_orderkey"] == orders["o_orderkey"], "left")
    fact = fact.select(*[F.expr(_COLUMNS[c][1]).alias(c) for c in stored])
    return _with_derived(fact, wanted).select(*columns)


# Columns that have one value per order, and the states that follow from them.
ORDER_COLUMNS = frozenset(
    c for c, (tables, text) in _COLUMNS.items() if tables and "part" not in tables and "l_" not in text
) | {"anio_reporte", "mes_reporte", "semana_reporte", "recuperado_flag"}
_LINE_STATES = {
    "st_cases": (), "st_deaths": ("estado", "fallecido"), "st_severe": ("estado",),
    "st_age_sum": ("edad_anios",), "st_age_n": ("edad_anios",),
}
_ORDER_STATES = {"st_recovered": ("recuperado", "recuperado_flag")}
_CUSTOMER_STATES = {
    "st_hospital": ("ubicacion",),
    "st_density_sum": ("densidad_poblacional",), "st_density_n": ("densidad_poblacional",),
}


def _stored(columns: Iterable[str]) -> list[str]:
    return [c for c in _closure(columns) if c in _COLUMNS]


def _add(df: DataFrame, columns: Iterable[str], keep: Iterable[str]) -> DataFrame:
    """Project ``keep`` and the given case columns, those they derive from included."""
    columns = list(columns)
    stored = [F.expr(_COLUMNS[c][1]).alias(c) for c in _stored(columns)]
    return _with_derived(df.select(*keep, *stored), _closure(columns))


def order_rollup(
    spark: SparkSession, sf_dir: str, columns: Iterable[str], states: Iterable[str]
) -> DataFrame:
    """Sums of the states by order or by customer, for reports whose columns are all of these.

    The line items are summed by order before they meet the orders, and the orders by customer
    before they meet the customers if no column of the order itself is asked for.  The joins need
    the same exchanges by these keys, so the sums add none: each task first folds its rows of a key
    into one, and a key that holds a large share of all rows crosses the network once per task.
    """
    columns, states = list(columns), list(states)
    definitions = state_columns(VOCABULARY)

    def of(level: dict[str, tuple[str, ...]]) -> tuple[list[str], list[str]]:
        names = [s for s in level if s in states or s == "st_cases"]  # the others multiply it
        return names, sorted({c for s in names for c in level[s]})

    def scaled(names: list[str]) -> dict[str, Column]:
        """A state that is the same for all cases of the row, times their number."""
        return {s: F.expr(definitions[s]) * F.col("st_cases") for s in names}

    sums, inputs = of(_LINE_STATES)
    lines = table(spark, sf_dir, "lineitem")
    if "part" in _tables(_stored(inputs)):
        lines = _with_part(spark, sf_dir, lines)
    lines = with_states(_add(lines, inputs, ["l_orderkey"]), VOCABULARY, sums)
    df = lines.groupBy("l_orderkey").agg(*[F.sum(s).alias(s) for s in sums])

    names, inputs = of(_ORDER_STATES)
    own = [c for c in columns if _tables(_stored([c])) == {"orders"}]
    orders = table(spark, sf_dir, "orders")
    df = df.join(orders, df["l_orderkey"] == orders["o_orderkey"], "left")
    df = _add(df, sorted({*own, *inputs}), ["o_custkey", *sums]).withColumns(scaled(names))
    sums += names
    names, inputs = of(_CUSTOMER_STATES)
    rest = [c for c in columns if c not in own]
    if rest or names:
        if not own:
            df = df.groupBy("o_custkey").agg(*[F.sum(s).alias(s) for s in sums])
        customer = _customer_side(spark, sf_dir, _tables(_stored([*rest, *inputs])))
        df = df.join(customer, df["o_custkey"] == customer["c_custkey"], "left")
        df = _add(df, sorted({*rest, *inputs}), [*own, *sums]).withColumns(scaled(names))
        sums += names
    return df.select(*columns, *sums)


def report_source(spark: SparkSession, sf_dir: str, report: Report) -> DataFrame:
    """What a report runs on: order sums where its columns allow, else cases."""
    texts = report.texts()
    columns = mentions(texts, CASE_COLUMNS)
    if columns and set(columns) <= ORDER_COLUMNS:
        return order_rollup(spark, sf_dir, columns, mentions(texts, state_columns(VOCABULARY)))
    return case_fact(spark, sf_dir, required_columns(report, VOCABULARY))


# Total order of the line items that share a case id.
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


def raw_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items as an untyped raw list, one text per field and all date spellings.

    Cases of the seventh line have an unreadable report date and those aged 100 an unreadable age;
    codes come without leading zeros and names in lower case, as in real lists.
    """
    fact = case_fact(
        spark, sf_dir,
        ["id_caso", "fecha_reporte", "fecha_notificacion", "fecha_inicio_sintomas",
         "fecha_diagnostico", "fecha_recuperacion", "fecha_muerte", "codigo_departamento",
         "nombre_departamento", "codigo_municipio", "nombre_municipio", "edad", "unidad_edad",
         "sexo", "tipo_contagio", "ubicacion", "estado", "recuperado"],
    )

    def spelled(column: str) -> Column:
        day = F.col(column).cast("string")
        return (
            F.when(F.col("id_caso") % 3 == 0, F.concat(day, F.lit(" 00:00:00")))
            .when(F.col("id_caso") % 3 == 1, day)
            .otherwise(F.concat(F.substring(day, 9, 2), F.lit("/"), F.substring(day, 6, 2), F.lit("/"), F.substring(day, 1, 4)))
        )

    return fact.select(
        F.when(F.col("id_caso") % 10 == 7, F.lit("sin fecha")).otherwise(spelled("fecha_reporte"))
        .alias("fecha_reporte_web"),
        F.col("id_caso").cast("string").alias("id_de_caso"),
        spelled("fecha_notificacion").alias("fecha_de_notificaci_n"),
        F.col("codigo_departamento").cast("string").alias("departamento"),
        F.concat(F.lit(" "), F.lower("nombre_departamento")).alias("departamento_nom"),
        F.col("codigo_municipio").cast("string").alias("ciudad_municipio"),
        F.col("nombre_municipio").alias("ciudad_municipio_nom"),
        F.when(F.col("edad") == 100, F.lit("cien")).otherwise(F.col("edad").cast("int").cast("string"))
        .alias("edad"),
        F.col("unidad_edad").alias("unidad_medida"),
        "sexo",
        F.col("tipo_contagio").alias("fuente_tipo_contagio"),
        "ubicacion",
        "estado",
        "recuperado",
        spelled("fecha_diagnostico").alias("fecha_diagnostico"),
        spelled("fecha_recuperacion").alias("fecha_recuperado"),
        spelled("fecha_inicio_sintomas").alias("fecha_inicio_sintomas"),
        spelled("fecha_muerte").alias("fecha_muerte"),
    )
