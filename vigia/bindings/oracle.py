"""DuckDB SQL with the same results as the registered queries."""

from __future__ import annotations

_DIMENSIONS = """
dept AS (
  SELECT n.n_nationkey AS id_departamento, n.n_name AS nombre, lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS codigo,
         r.r_name AS region, p.poblacion, CAST(p.poblacion AS DOUBLE) / (n.n_nationkey + 1) AS densidad
  FROM nation n
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT c_nationkey, CAST(COUNT(*) * 1000 AS BIGINT) AS poblacion FROM customer GROUP BY c_nationkey) p
    ON p.c_nationkey = n.n_nationkey
), muni AS (
  SELECT c_custkey AS id_municipio, c_nationkey AS id_departamento, c_name AS nombre,
         CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 5 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0')
              ELSE CAST(c_custkey AS VARCHAR) END AS codigo,
         1000 + CAST(floor(abs(c_acctbal) * 10) AS BIGINT) AS poblacion,
         CAST(c_nationkey AS BIGINT) * 100 AS altitud, c_mktsegment AS categoria
  FROM customer
), hosp AS (
  SELECT s_suppkey AS id_municipio, CAST(COUNT(*) AS BIGINT) AS num_hospitales,
         CAST(SUM(floor(abs(s_acctbal) / 100)) AS BIGINT) AS total_camas_uci,
         CAST(SUM(s_suppkey % 50 * 10) AS BIGINT) AS total_camas_general
  FROM supplier GROUP BY s_suppkey
)"""

_FACT = """
, joined AS (
  SELECT l_orderkey * 10 + l_linenumber AS id_caso,
         CAST(o_orderdate AS DATE) AS fecha_reporte,
         CAST(o_orderdate AS DATE) AS fecha_inicio_sintomas,
         CAST(l_shipdate AS DATE) AS fecha_diagnostico,
         CAST(o_orderdate AS DATE) + l_linenumber AS fecha_notificacion,
         CASE WHEN o_orderstatus = 'O' THEN CAST(l_shipdate AS DATE) + p_size END AS fecha_recuperacion,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) END AS fecha_muerte,
         c_nationkey AS codigo_departamento, dept.nombre AS nombre_departamento,
         c_custkey AS codigo_municipio, c_name AS nombre_municipio,
         l_quantity * 2 AS edad,
         CASE WHEN p_size % 10 = 0 THEN '2' WHEN p_size % 10 = 1 THEN '3' ELSE '1' END AS unidad_edad,
         l_linestatus AS sexo, o_orderpriority AS tipo_contagio, c_mktsegment AS ubicacion,
         l_returnflag AS estado, o_orderstatus AS recuperado,
         dept.poblacion AS poblacion_departamento, dept.densidad AS densidad_poblacional, dept.region,
         1000 + CAST(floor(abs(c_acctbal) * 10) AS BIGINT) AS poblacion_municipio,
         num_hospitales, total_camas_uci, total_camas_general
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN dept ON c_nationkey = dept.id_departamento
  LEFT JOIN hosp ON c_custkey = hosp.id_municipio
), aged AS (
  SELECT *, CASE unidad_edad WHEN '1' THEN edad WHEN '2' THEN edad / 12 WHEN '3' THEN edad / 365 END AS edad_anios
  FROM joined
), fact AS (
  SELECT *,
         CASE WHEN edad_anios < 18 THEN '0-17' WHEN edad_anios < 30 THEN '18-29' WHEN edad_anios < 50 THEN '30-49'
              WHEN edad_anios < 65 THEN '50-64' ELSE '65+' END AS grupo_edad,
         CAST(year(fecha_reporte) AS INTEGER) AS anio_reporte,
         CAST(month(fecha_reporte) AS INTEGER) AS mes_reporte,
         CAST(week(fecha_reporte) AS INTEGER) AS semana_reporte,
         CASE WHEN estado = 'R' THEN 1 ELSE 0 END AS fallecido,
         CASE WHEN recuperado = 'O' THEN 1 ELSE 0 END AS recuperado_flag
  FROM aged
)"""

# The raw list as text, and its cleaning with DuckDB's own parser.
def _spelled(column: str) -> str:
    return (
        f"CASE WHEN id_caso % 3 = 0 THEN strftime({column}, '%Y-%m-%d %H:%M:%S') "
        f"WHEN id_caso % 3 = 1 THEN strftime({column}, '%Y-%m-%d') ELSE strftime({column}, '%d/%m/%Y') END"
    )


_RAW = f"""
, raw AS (
  SELECT CAST(id_caso AS VARCHAR) AS id_caso,
         CASE WHEN id_caso % 10 = 7 THEN 'sin fecha' ELSE {_spelled('fecha_reporte')} END AS fecha_reporte,
         {_spelled('fecha_notificacion')} AS fecha_notificacion,
         CAST(codigo_departamento AS VARCHAR) AS codigo_departamento,
         ' ' || lower(nombre_departamento) AS nombre_departamento,
         CAST(codigo_municipio AS VARCHAR) AS codigo_municipio, nombre_municipio,
         CASE WHEN edad = 100 THEN 'cien' ELSE CAST(CAST(edad AS INTEGER) AS VARCHAR) END AS edad,
         unidad_edad, sexo, tipo_contagio, ubicacion, estado, recuperado,
         {_spelled('fecha_diagnostico')} AS fecha_diagnostico,
         {_spelled('fecha_recuperacion')} AS fecha_recuperacion,
         {_spelled('fecha_inicio_sintomas')} AS fecha_inicio_sintomas,
         {_spelled('fecha_muerte')} AS fecha_muerte
  FROM joined
)"""


def _parsed(column: str) -> str:
    return (
        f"CAST(coalesce(try_strptime({column}, '%Y-%m-%d %H:%M:%S'), try_strptime({column}, '%Y-%m-%d'), "
        f"try_strptime({column}, '%d/%m/%Y')) AS DATE) AS {column}"
    )


_DATES = ("fecha_reporte", "fecha_notificacion", "fecha_diagnostico", "fecha_recuperacion",
          "fecha_inicio_sintomas", "fecha_muerte")
_RAW_ORDER = (
    "fecha_reporte", "fecha_notificacion", "codigo_departamento", "nombre_departamento",
    "codigo_municipio", "nombre_municipio", "edad", "unidad_edad", "sexo", "tipo_contagio", "ubicacion",
    "estado", "recuperado", "fecha_diagnostico", "fecha_recuperacion", "fecha_inicio_sintomas",
    "fecha_muerte", "edad_anios",
)
_AGE = (
    "CASE unidad_edad WHEN '1' THEN TRY_CAST(edad AS DOUBLE) WHEN '2' THEN TRY_CAST(edad AS DOUBLE) / 12 "
    "WHEN '3' THEN TRY_CAST(edad AS DOUBLE) / 365 END"
)
_CLEAN = f"""
, parsed AS (
  SELECT * REPLACE ({', '.join(_parsed(c) for c in _DATES)}), {_AGE} AS edad_anios FROM raw
), clean AS (
  SELECT * EXCLUDE (position) FROM (
    SELECT *, row_number() OVER (PARTITION BY id_caso ORDER BY {', '.join(c + ' ASC NULLS LAST' for c in _RAW_ORDER)})
           AS position
    FROM parsed WHERE codigo_departamento IS NOT NULL
  ) WHERE position = 1
)"""


def _dimensions(text: str) -> str:
    return f"WITH {_DIMENSIONS}\n{text}"


def _fact(text: str) -> str:
    return f"WITH {_DIMENSIONS}{_FACT}\n{text}"


def _joined_raw(text: str) -> str:
    joined = _FACT.split(", aged AS")[0]
    return f"WITH {_DIMENSIONS}{joined}{_RAW}\n{text}"


def _clean(text: str, more: str = "") -> str:
    joined = _FACT.split(", aged AS")[0]
    return f"WITH {_DIMENSIONS}{joined}{_RAW}{_CLEAN}{more}\n{text}"


N = "CAST(COUNT(*) AS BIGINT)"
D = "CAST(SUM(fallecido) AS BIGINT)"
R = "CAST(SUM(recuperado_flag) AS BIGINT)"
AGE = "ROUND(AVG(edad_anios), 6)"
CFR = "ROUND(CAST(SUM(fallecido) AS DOUBLE) / COUNT(*) * 100, 6)"
CFR2 = "ROUND(SUM(fallecido) * CAST(100 AS DOUBLE) / COUNT(*), 2)"
RECOVERY = "ROUND(CAST(SUM(recuperado_flag) AS DOUBLE) / COUNT(*) * 100, 6)"
_HOSPITAL = "SUM(CASE WHEN ubicacion IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END)"
_SEVERE = "SUM(CASE WHEN estado = 'A' THEN 1 ELSE 0 END)"


def _days(end: str, start: str) -> str:
    return f"date_diff('day', {start}, {end})"


DIAGNOSIS = _days("fecha_diagnostico", "fecha_inicio_sintomas")
RECOVERED_IN = _days("fecha_recuperacion", "fecha_diagnostico")
DIED_IN = _days("fecha_muerte", "fecha_diagnostico")
TOP10 = """(SELECT nombre_departamento FROM fact GROUP BY nombre_departamento
            ORDER BY COUNT(*) DESC, nombre_departamento ASC NULLS FIRST LIMIT 10)"""

_DEPARTMENTS = f"""SELECT nombre_departamento, region, poblacion_departamento, {N} AS total_casos, {D} AS fallecidos,
       CAST(COUNT(*) AS DOUBLE) / NULLIF(poblacion_departamento, 0) * 100000 AS casos_por_100k,
       CAST(SUM(fallecido) AS DOUBLE) / COUNT(*) * 100 AS tasa_letalidad
FROM fact GROUP BY nombre_departamento, region, poblacion_departamento"""
_REGIONS = f"""SELECT region, {N} AS total_casos, {D} AS fallecidos,
       CAST(COUNT(DISTINCT nombre_departamento) AS BIGINT) AS num_departamentos,
       AVG(densidad_poblacional) AS densidad_promedio
FROM fact GROUP BY region"""
_MONTHS = f"""SELECT anio_reporte, mes_reporte, {N} AS total_casos, {D} AS total_fallecidos, {R} AS total_recuperados,
       {CFR} AS tasa_letalidad
FROM fact GROUP BY anio_reporte, mes_reporte"""
_KPIS = f"""SELECT {N} AS total_casos, {D} AS total_fallecidos, {R} AS total_recuperados,
       CAST(COUNT(DISTINCT nombre_departamento) AS BIGINT) AS departamentos_afectados,
       CAST(COUNT(DISTINCT nombre_municipio) AS BIGINT) AS municipios_afectados,
       {AGE} AS edad_promedio, {CFR} AS tasa_letalidad_general
FROM fact"""
_MUNICIPALITIES = f"""SELECT nombre_municipio, nombre_departamento, poblacion_municipio, {N} AS total_casos, {D} AS fallecidos,
       ROUND(CAST(COUNT(*) AS DOUBLE) / NULLIF(poblacion_municipio, 0) * 100000, 6) AS incidencia_por_100k
FROM fact GROUP BY nombre_municipio, nombre_departamento, poblacion_municipio
ORDER BY total_casos DESC, nombre_municipio, nombre_departamento, poblacion_municipio LIMIT 50"""
_SEVERITY = f"""SELECT nombre_departamento, casos, fallecidos, ROUND(letalidad, 6) AS letalidad,
       CASE WHEN letalidad > 34 THEN 'ALTA' WHEN letalidad > 33 THEN 'MEDIA' ELSE 'BAJA' END AS categoria_severidad
FROM (SELECT nombre_departamento, {N} AS casos, {D} AS fallecidos,
             CAST(SUM(fallecido) AS DOUBLE) / COUNT(*) * 100 AS letalidad
      FROM fact GROUP BY nombre_departamento)"""
_DASHBOARD = f"""SELECT coalesce(d.nombre_departamento, 'N/A') AS nombre_departamento, coalesce(d.region, 'Sin región') AS region,
       d.total_casos, d.fallecidos, ROUND(coalesce(d.tasa_letalidad, 0), 6) AS tasa_letalidad,
       ROUND(coalesce(d.casos_por_100k, 0), 6) AS casos_por_100k, coalesce(r.total_casos, 0) AS casos_region,
       ROUND(coalesce(CAST(r.fallecidos AS DOUBLE) / NULLIF(r.total_casos, 0) * 100, 0), 6) AS letalidad_region
FROM ({_DEPARTMENTS}) d LEFT JOIN ({_REGIONS}) r ON d.region = r.region
ORDER BY d.tasa_letalidad DESC, d.nombre_departamento, d.region LIMIT 50"""
_ALL_ROWS = _DASHBOARD.removesuffix(" LIMIT 50")
_ROUNDED_DEPARTMENTS = f"""SELECT nombre_departamento, region, poblacion_departamento, total_casos, fallecidos,
       ROUND(casos_por_100k, 6) AS casos_por_100k, ROUND(tasa_letalidad, 6) AS tasa_letalidad
FROM ({_DEPARTMENTS})"""
_ROUNDED_REGIONS = f"""SELECT region, total_casos, fallecidos, num_departamentos,
       ROUND(densidad_promedio, 6) AS densidad_promedio FROM ({_REGIONS})"""
_RANKING = f"""SELECT nombre_departamento, region, {N} AS total_casos, {D} AS fallecidos, {CFR2} AS tasa_letalidad,
       CAST(RANK() OVER (ORDER BY COUNT(*) DESC) AS INTEGER) AS ranking
FROM fact WHERE nombre_departamento IS NOT NULL GROUP BY nombre_departamento, region"""


def _consolidated(where: str, limit: int) -> str:
    return f"""SELECT d.nombre_departamento, d.region, d.poblacion_departamento, d.total_casos, d.fallecidos,
       ROUND(d.casos_por_100k, 6) AS casos_por_100k, ROUND(d.tasa_letalidad, 6) AS tasa_letalidad,
       r.total_casos AS casos_region, r.fallecidos AS fallecidos_region,
       k.total_casos AS casos_nacional, k.total_fallecidos AS fallecidos_nacional,
       k.tasa_letalidad_general AS letalidad_nacional
FROM ({_DEPARTMENTS}) d LEFT JOIN ({_REGIONS}) r ON d.region = r.region, ({_KPIS}) k {where}
ORDER BY d.total_casos DESC, d.nombre_departamento, d.region LIMIT {limit}"""


_REPORT_SQL = {
    "temporal_monthly": _MONTHS,
    "temporal_weekly": f"SELECT anio_reporte, semana_reporte, {N} AS casos, {AGE} AS edad_promedio FROM fact GROUP BY anio_reporte, semana_reporte",
    "demo_age": f"SELECT grupo_edad, {N} AS total_casos, {D} AS fallecidos, {CFR} AS tasa_letalidad FROM fact GROUP BY grupo_edad",
    "demo_sex": f"SELECT sexo, {N} AS total_casos, {D} AS fallecidos, {AGE} AS edad_promedio FROM fact GROUP BY sexo",
    "demo_age_sex": f"SELECT grupo_edad, sexo, {N} AS casos FROM fact GROUP BY grupo_edad, sexo",
    "geo_department": _ROUNDED_DEPARTMENTS,
    "geo_region": _ROUNDED_REGIONS,
    "geo_municipality_top50": _MUNICIPALITIES,
    "infra_capacity": f"""SELECT nombre_departamento, CAST(SUM(n) AS BIGINT) AS total_casos, CAST(SUM(d) AS BIGINT) AS fallecidos,
       CAST(SUM(num_hospitales) AS BIGINT) AS hospitales, CAST(SUM(total_camas_uci) AS BIGINT) AS camas_uci,
       CAST(SUM(total_camas_general) AS BIGINT) AS camas_general,
       ROUND(CAST(SUM(n) AS DOUBLE) / NULLIF(SUM(total_camas_uci), 0), 6) AS casos_por_cama_uci
FROM (SELECT nombre_departamento, codigo_municipio, num_hospitales, total_camas_uci, total_camas_general,
             COUNT(*) AS n, SUM(fallecido) AS d
      FROM fact WHERE num_hospitales IS NOT NULL GROUP BY ALL)
GROUP BY nombre_departamento""",
    "by_transmission": f"SELECT tipo_contagio, {N} AS total_casos, {D} AS fallecidos, {CFR} AS tasa_letalidad FROM fact GROUP BY tipo_contagio",
    "by_location": f"SELECT ubicacion, {N} AS total_casos, {D} AS fallecidos, {AGE} AS edad_promedio FROM fact GROUP BY ubicacion",
    "by_status": f"SELECT estado, {N} AS total_casos, {AGE} AS edad_promedio FROM fact GROUP BY estado",
    "kpis": _KPIS,
    "evolution_active": f"""SELECT anio_reporte, mes_reporte, {N} AS casos_nuevos, {D} AS fallecidos, {R} AS recuperados,
       CAST(COUNT(*) - SUM(fallecido) - SUM(recuperado_flag) AS BIGINT) AS casos_activos_estimados
FROM fact GROUP BY anio_reporte, mes_reporte""",
    "top_departments": f"SELECT nombre_departamento, {N} AS casos FROM fact GROUP BY nombre_departamento ORDER BY casos DESC, nombre_departamento LIMIT 10",
    "mortality_age_sex": f"SELECT grupo_edad, sexo, {N} AS total_casos, {D} AS fallecidos, {CFR} AS tasa_mortalidad, {AGE} AS edad_promedio FROM fact GROUP BY grupo_edad, sexo",
    "time_to_diagnosis": f"""SELECT estado, ROUND(AVG({DIAGNOSIS}), 6) AS dias_promedio, CAST(MIN({DIAGNOSIS}) AS INTEGER) AS dias_minimo,
       CAST(MAX({DIAGNOSIS}) AS INTEGER) AS dias_maximo, {N} AS casos
FROM fact WHERE fecha_inicio_sintomas IS NOT NULL AND fecha_diagnostico IS NOT NULL GROUP BY estado""",
    "cfr_month_department": f"""SELECT anio_reporte, mes_reporte, nombre_departamento, {N} AS casos, {D} AS fallecidos, {CFR} AS cfr
FROM fact GROUP BY anio_reporte, mes_reporte, nombre_departamento HAVING COUNT(*) > 30""",
    "recovery_time": f"""SELECT grupo_edad, estado, ROUND(AVG({RECOVERED_IN}), 6) AS dias_promedio_recuperacion,
       ROUND(STDDEV_SAMP({RECOVERED_IN}), 6) AS desviacion_std, {N} AS casos_recuperados
FROM fact WHERE recuperado_flag = 1 AND fecha_diagnostico IS NOT NULL AND fecha_recuperacion IS NOT NULL
GROUP BY grupo_edad, estado HAVING COUNT(*) > 10""",
    "recovery_by_source": f"""SELECT tipo_contagio, ubicacion, {N} AS total_casos, {R} AS recuperados, {D} AS fallecidos,
       {RECOVERY} AS tasa_recuperacion, {CFR} AS tasa_mortalidad
FROM fact GROUP BY tipo_contagio, ubicacion""",
    "critical_municipalities": f"""SELECT nombre_municipio, nombre_departamento, poblacion_municipio, total_casos, fallecidos,
       ROUND(incidencia, 6) AS incidencia_100k, letalidad
FROM (SELECT nombre_municipio, nombre_departamento, poblacion_municipio, {N} AS total_casos, {D} AS fallecidos,
             CAST(COUNT(*) AS DOUBLE) / NULLIF(poblacion_municipio, 0) * 100000 AS incidencia, {CFR} AS letalidad
      FROM fact GROUP BY nombre_municipio, nombre_departamento, poblacion_municipio)
WHERE total_casos > 40 AND incidencia > 500""",
    "department_severity": _SEVERITY,
    "attack_rate": f"""SELECT nombre_departamento, grupo_edad, {N} AS casos, MAX(poblacion_departamento) AS poblacion,
       ROUND(CAST(COUNT(*) AS DOUBLE) / NULLIF(MAX(poblacion_departamento), 0) * 100000, 6) AS tasa_ataque
FROM fact GROUP BY nombre_departamento, grupo_edad""",
    "sex_ratio_pivot": """SELECT grupo_edad, CAST(SUM(CASE WHEN sexo = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS "F",
       CAST(SUM(CASE WHEN sexo = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS "O",
       CAST(SUM(CASE WHEN sexo IN ('F', 'O') THEN 0 ELSE 1 END) AS BIGINT) AS otros
FROM fact GROUP BY grupo_edad""",
    "sex_ratio_one_listed": """SELECT grupo_edad, CAST(SUM(CASE WHEN sexo = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS "F",
       CAST(SUM(CASE WHEN sexo = 'F' THEN 0 ELSE 1 END) AS BIGINT) AS otros
FROM fact GROUP BY grupo_edad""",
    "severity_index": f"""SELECT nombre_departamento, total_casos, fallecidos, ROUND(g, 6) AS porcentaje_graves,
       ROUND(h, 6) AS porcentaje_hospitalizados, ROUND(c, 6) AS tasa_letalidad,
       ROUND(g * CAST(0.4 AS DOUBLE) + h * CAST(0.3 AS DOUBLE) + c * CAST(0.3 AS DOUBLE), 6) AS indice_gravedad
FROM (SELECT nombre_departamento, {N} AS total_casos, {D} AS fallecidos,
             CAST({_SEVERE} AS DOUBLE) / COUNT(*) * 100 AS g, CAST({_HOSPITAL} AS DOUBLE) / COUNT(*) * 100 AS h,
             CAST(SUM(fallecido) AS DOUBLE) / COUNT(*) * 100 AS c
      FROM fact GROUP BY nombre_departamento)""",
    "rank_departments": _RANKING,
    "cfr_evolution": f"""SELECT anio_reporte, mes_reporte, {N} AS casos, {D} AS fallecidos, {CFR2} AS tasa_letalidad, {AGE} AS edad_promedio
FROM fact GROUP BY anio_reporte, mes_reporte""",
    "age_region": f"""SELECT region, grupo_edad, {N} AS casos, {D} AS fallecidos, ROUND(AVG(edad_anios), 1) AS edad_promedio,
       {CFR2} AS tasa_letalidad
FROM fact WHERE region IS NOT NULL AND grupo_edad IS NOT NULL GROUP BY region, grupo_edad""",
    "cumulative_cases": f"""SELECT nombre_departamento, anio_reporte, mes_reporte, {N} AS casos_mes,
       CAST(SUM(COUNT(*)) OVER (PARTITION BY nombre_departamento ORDER BY anio_reporte, mes_reporte
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS casos_acumulados
FROM fact WHERE nombre_departamento IN {TOP10} GROUP BY nombre_departamento, anio_reporte, mes_reporte""",
    "mortality_department_month": f"""SELECT anio_reporte, mes_reporte, nombre_departamento, {N} AS casos, {D} AS fallecidos, {CFR} AS cfr
FROM fact GROUP BY anio_reporte, mes_reporte, nombre_departamento""",
    "time_to_death": f"""SELECT grupo_edad, ROUND(AVG({DIED_IN}), 6) AS dias_promedio, CAST(MIN({DIED_IN}) AS INTEGER) AS dias_minimo,
       CAST(MAX({DIED_IN}) AS INTEGER) AS dias_maximo, ROUND(STDDEV_SAMP({DIED_IN}), 6) AS desviacion_std, {N} AS casos
FROM fact WHERE fallecido = 1 AND fecha_diagnostico IS NOT NULL AND fecha_muerte IS NOT NULL GROUP BY grupo_edad""",
    "mortality_by_recovery": f"SELECT recuperado, {N} AS total_casos, {D} AS fallecidos, {CFR} AS tasa_letalidad FROM fact GROUP BY recuperado",
    "health_status": f"SELECT estado, recuperado, {N} AS total_casos FROM fact GROUP BY estado, recuperado",
    "critical_departments": f"SELECT * FROM ({_SEVERITY}) WHERE categoria_severidad = 'ALTA'",
    "cumulative_cfr": f"""SELECT nombre_departamento, anio_reporte, mes_reporte, {N} AS casos, {D} AS fallecidos,
       CAST(SUM(COUNT(*)) OVER w AS BIGINT) AS casos_acumulados, CAST(SUM(SUM(fallecido)) OVER w AS BIGINT) AS fallecidos_acumulados,
       ROUND(CAST(SUM(SUM(fallecido)) OVER w AS DOUBLE) / SUM(COUNT(*)) OVER w * 100, 6) AS cfr_acumulado
FROM fact GROUP BY nombre_departamento, anio_reporte, mes_reporte
WINDOW w AS (PARTITION BY nombre_departamento ORDER BY anio_reporte, mes_reporte ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "national_cumulative": f"""SELECT fecha_reporte, {N} AS casos, CAST(SUM(COUNT(*)) OVER (ORDER BY fecha_reporte) AS BIGINT) AS casos_acumulados
FROM fact GROUP BY fecha_reporte""",
    "national_cumulative_municipality": f"""SELECT fecha_reporte, codigo_municipio, {N} AS casos,
       CAST(SUM(COUNT(*)) OVER (ORDER BY fecha_reporte NULLS FIRST, codigo_municipio NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
         AS casos_acumulados
FROM fact GROUP BY fecha_reporte, codigo_municipio""",
    # cases without enrichment
    "geo_department_plain": f"SELECT nombre_departamento, {N} AS total_casos, {D} AS fallecidos, {CFR} AS tasa_letalidad FROM fact GROUP BY nombre_departamento",
    "geo_municipality_top50_plain": f"""SELECT nombre_municipio, nombre_departamento, {N} AS total_casos, {D} AS fallecidos
FROM fact GROUP BY nombre_municipio, nombre_departamento
ORDER BY total_casos DESC, nombre_municipio, nombre_departamento LIMIT 50""",
    "rank_departments_plain": f"""SELECT nombre_departamento, {N} AS total_casos, {D} AS fallecidos, {CFR2} AS tasa_letalidad,
       CAST(RANK() OVER (ORDER BY COUNT(*) DESC) AS INTEGER) AS ranking
FROM fact WHERE nombre_departamento IS NOT NULL GROUP BY nombre_departamento""",
    "age_top_departments": f"""SELECT nombre_departamento, grupo_edad, {N} AS casos, {D} AS fallecidos, ROUND(AVG(edad_anios), 1) AS edad_promedio,
       {CFR2} AS tasa_letalidad
FROM fact WHERE nombre_departamento IN {TOP10} AND grupo_edad IS NOT NULL GROUP BY nombre_departamento, grupo_edad""",
    # views
    "kpis_view": _KPIS,
    "department_detail": f"SELECT * FROM ({_ROUNDED_DEPARTMENTS}) WHERE nombre_departamento = 'NATION_7'",
    "ranking_top20": f"SELECT * FROM ({_RANKING}) ORDER BY ranking, nombre_departamento, region LIMIT 20",
    "regions_view": _ROUNDED_REGIONS,
    "temporal_last": f"SELECT * FROM ({_MONTHS}) ORDER BY anio_reporte DESC, mes_reporte DESC LIMIT 24",
    "period_label": f"""SELECT *, CAST(anio_reporte AS VARCHAR) || '-' || lpad(CAST(mes_reporte AS VARCHAR), 2, '0') AS periodo
FROM ({_MONTHS})""",
    "consolidated": _consolidated("", 20),
    "consolidated_region": _consolidated("WHERE d.region = 'ASIA'", 3),
    "top_cfr": f"""SELECT nombre_departamento, region, poblacion_departamento, total_casos, fallecidos,
       ROUND(casos_por_100k, 6) AS casos_por_100k, ROUND(cfr, 6) AS tasa_letalidad
FROM (SELECT * RENAME (tasa_letalidad AS cfr) FROM ({_DEPARTMENTS}))
ORDER BY cfr DESC, nombre_departamento, region, poblacion_departamento LIMIT 20""",
    "critical_months": f"SELECT * FROM ({_MONTHS}) ORDER BY total_casos DESC, anio_reporte, mes_reporte LIMIT 20",
    "region_comparison": f"""SELECT region, {N} AS num_departamentos, CAST(SUM(total_casos) AS BIGINT) AS total_casos,
       CAST(SUM(fallecidos) AS BIGINT) AS fallecidos, ROUND(AVG(total_casos), 6) AS casos_promedio,
       ROUND(AVG(tasa_letalidad), 6) AS letalidad_promedio,
       ROUND(CAST(SUM(fallecidos) AS DOUBLE) / NULLIF(SUM(total_casos), 0) * 100, 6) AS letalidad_regional
FROM ({_DEPARTMENTS}) GROUP BY region""",
    "affected_population": f"""SELECT nombre_departamento, region, poblacion_departamento, total_casos,
       ROUND(CAST(total_casos AS DOUBLE) / NULLIF(poblacion_departamento, 0) * 100, 6) AS porcentaje_afectado
FROM ({_DEPARTMENTS})
ORDER BY CAST(total_casos AS DOUBLE) / NULLIF(poblacion_departamento, 0) * 100 DESC, nombre_departamento, region LIMIT 20""",
    "dashboard_consolidated": _DASHBOARD,
    "region_distribution": f"SELECT region, total_casos FROM ({_REGIONS}) WHERE region IS NOT NULL AND region <> 'null' AND region <> ''",
    "top10_cfr": f"SELECT * FROM ({_ALL_ROWS}) ORDER BY tasa_letalidad DESC, nombre_departamento, region LIMIT 10",
    "top10_per_100k": f"SELECT * FROM ({_ALL_ROWS}) ORDER BY casos_por_100k DESC, nombre_departamento, region LIMIT 10",
    "ranked_badges": f"""SELECT CAST(row_number() OVER (ORDER BY tasa_letalidad DESC, nombre_departamento, region) AS INTEGER) AS posicion, *,
       CASE WHEN tasa_letalidad > 34 THEN 'badge-high' WHEN tasa_letalidad > 33 THEN 'badge-medium' ELSE 'badge-low' END AS nivel
FROM ({_ALL_ROWS})""",
    "top_municipalities": _MUNICIPALITIES,
    "sql_view": f"""SELECT region, anio_reporte, {N} AS casos, {D} AS fallecidos,
       CAST(RANK() OVER (PARTITION BY anio_reporte ORDER BY COUNT(*) DESC) AS INTEGER) AS ranking
FROM fact WHERE anio_reporte >= 1997 GROUP BY region, anio_reporte""",
    # typed cases
    "code_norm": f"""SELECT lpad(CAST(codigo_departamento AS VARCHAR), 2, '0') AS departamento_2,
       lpad(CAST(codigo_municipio AS VARCHAR), 2, '0') AS municipio_2, lpad(CAST(codigo_municipio AS VARCHAR), 5, '0') AS municipio_5,
       {N} AS casos
FROM fact GROUP BY 1, 2, 3""",
    "calendar_parts": f"""SELECT fecha_reporte, anio_reporte, mes_reporte, semana_reporte,
       CAST(date_trunc('week', fecha_reporte) AS DATE) AS lunes, strftime(fecha_reporte, '%Y-%m') AS periodo, {N} AS casos
FROM fact GROUP BY ALL""",
    "flags": f"SELECT estado, recuperado, fallecido, recuperado_flag, {N} AS casos FROM fact GROUP BY ALL",
    "durations": f"""SELECT id_caso, CAST({DIAGNOSIS} AS INTEGER) AS dias_sintomas_diagnostico,
       CAST({_days('fecha_notificacion', 'fecha_diagnostico')} AS INTEGER) AS dias_notificacion_diagnostico,
       CAST({RECOVERED_IN} AS INTEGER) AS dias_recuperacion, CAST({DIED_IN} AS INTEGER) AS dias_muerte
FROM fact""",
    "coverage": f"""SELECT {N} AS registros, CAST(COUNT(poblacion_departamento) AS BIGINT) AS con_poblacion_departamento,
       CAST(COUNT(poblacion_municipio) AS BIGINT) AS con_poblacion_municipio, CAST(COUNT(num_hospitales) AS BIGINT) AS con_num_hospitales
FROM fact""",
    "enrich_full": """SELECT f.id_caso, f.codigo_departamento, f.nombre_departamento, f.codigo_municipio,
       d.poblacion AS poblacion_departamento, ROUND(d.densidad, 6) AS densidad_poblacional, d.region,
       m.poblacion AS poblacion_municipio, m.altitud AS altitud_msnm, m.categoria AS categoria_municipio,
       h.num_hospitales, h.total_camas_uci, h.total_camas_general
FROM fact f
LEFT JOIN dept d ON d.id_departamento = coalesce(
  (SELECT x.id_departamento FROM dept x WHERE x.codigo = lpad(CAST(f.codigo_departamento AS VARCHAR), 2, '0')),
  (SELECT x.id_departamento FROM dept x WHERE x.nombre = upper(trim(f.nombre_departamento))))
LEFT JOIN muni m ON m.codigo = lpad(CAST(f.codigo_municipio AS VARCHAR), 5, '0')
LEFT JOIN hosp h ON h.id_municipio = f.codigo_municipio""",
    "capacity_by_code": """SELECT f.id_caso, f.codigo_municipio, h.num_hospitales, h.total_camas_uci, h.total_camas_general
FROM fact f
LEFT JOIN (muni m JOIN hosp h ON h.id_municipio = m.id_municipio) ON m.codigo = lpad(CAST(f.codigo_municipio AS VARCHAR), 5, '0')""",
    "csv_result": f"""SELECT tipo_contagio, ubicacion, {N} AS total_casos, {R} AS recuperados, {D} AS fallecidos,
       {RECOVERY} AS tasa_recuperacion, {CFR} AS tasa_mortalidad
FROM fact GROUP BY tipo_contagio, ubicacion""",
    "publish_table": _MONTHS,
    "parquet_partitioned": f"""SELECT anio_reporte, mes_reporte, {N} AS casos, {D} AS fallecidos FROM fact
WHERE fecha_reporte >= DATE '1996-03-01' AND fecha_reporte < DATE '1997-11-01' GROUP BY anio_reporte, mes_reporte""",
    "department_cases": """SELECT id_caso, codigo_departamento, estado, anio_reporte, mes_reporte, fallecido FROM fact WHERE codigo_departamento = 7""",
    "age_ranks": """SELECT ROUND(edad_anios, 6) AS edad_anios, rows, CAST(below AS BIGINT) AS rows_below, below + (rows + 1) / 2 AS rank
FROM (SELECT edad_anios, COUNT(*) AS rows, coalesce(SUM(COUNT(*)) OVER (ORDER BY edad_anios ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM fact WHERE edad_anios IS NOT NULL GROUP BY edad_anios)""",
    "case_sample": """SELECT id_caso, fecha_reporte, nombre_departamento, nombre_municipio, ROUND(edad_anios, 6) AS edad_anios, sexo, estado,
       grupo_edad, fallecido, recuperado_flag
FROM fact ORDER BY fact.id_caso, fecha_reporte, nombre_departamento, nombre_municipio, fact.edad_anios, sexo, estado LIMIT 10""",
    # model inputs
    "ml_dataset": f"""SELECT id_caso, ROUND(edad_anios, 6) AS edad_anios, sexo, tipo_contagio, grupo_edad,
       CAST({_days('fecha_notificacion', 'fecha_diagnostico')} AS INTEGER) AS dias_notificacion_diagnostico,
       CAST(CASE estado WHEN 'A' THEN 2 WHEN 'N' THEN 1 ELSE 0 END AS DOUBLE) AS label
FROM fact WHERE edad_anios IS NOT NULL AND sexo IS NOT NULL AND nombre_departamento IS NOT NULL AND tipo_contagio IS NOT NULL""",
    "ml_split": """SELECT id_caso, bucket, CASE WHEN bucket < 80 THEN 'train' ELSE 'test' END AS parte
FROM (SELECT id_caso, CAST(CAST('0x' || substr(md5('42:' || CAST(id_caso AS VARCHAR)), 1, 8) AS BIGINT) % 100 AS INTEGER) AS bucket
      FROM fact WHERE edad_anios IS NOT NULL AND sexo IS NOT NULL AND nombre_departamento IS NOT NULL AND tipo_contagio IS NOT NULL)""",
    "label_distribution": f"""SELECT CAST(CASE WHEN ubicacion IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 1 ELSE 0 END AS DOUBLE) AS label, {N} AS casos
FROM fact
WHERE edad_anios IS NOT NULL AND sexo IS NOT NULL AND nombre_departamento IS NOT NULL AND tipo_contagio IS NOT NULL AND ubicacion IS NOT NULL
GROUP BY 1""",
    "department_features": f"""SELECT nombre_departamento, {N} AS total_casos, {AGE} AS edad_promedio, {CFR} AS tasa_letalidad,
       {RECOVERY} AS tasa_recuperacion, MAX(poblacion_departamento) AS poblacion, ROUND(MAX(densidad_poblacional), 6) AS densidad,
       ROUND(CAST(COUNT(*) AS DOUBLE) / NULLIF(MAX(poblacion_departamento), 0) * 100000, 6) AS incidencia_100k
FROM fact WHERE edad_anios IS NOT NULL AND sexo IS NOT NULL AND nombre_departamento IS NOT NULL AND tipo_contagio IS NOT NULL
GROUP BY nombre_departamento HAVING COUNT(*) > 100""",
    "group_features": f"""SELECT grupo_edad, sexo, {N} AS total_casos, {AGE} AS edad_promedio, {CFR} AS tasa_mortalidad,
       {RECOVERY} AS tasa_recuperacion, ROUND(CAST({_HOSPITAL} AS DOUBLE) / COUNT(*) * 100, 6) AS tasa_hospitalizacion
FROM fact WHERE edad_anios IS NOT NULL AND sexo IS NOT NULL AND nombre_departamento IS NOT NULL AND tipo_contagio IS NOT NULL
GROUP BY grupo_edad, sexo HAVING COUNT(*) > 100""",
}
_COMPLETE = "edad_anios IS NOT NULL AND sexo IS NOT NULL AND nombre_departamento IS NOT NULL AND tipo_contagio IS NOT NULL"
_MODEL_ROWS = f"""SELECT *, CAST('0x' || substr(md5('42:' || CAST(id_caso AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= 80 AS is_test,
       {_days('fecha_notificacion', 'fecha_diagnostico')} AS dias_notificacion_diagnostico
FROM fact WHERE {_COMPLETE}"""


def _area(label: str, score: str) -> str:
    """Area under the curve from mean ranks by window functions."""
    return f"""SELECT '{label}' AS etiqueta, '{score}' AS puntaje, CAST(SUM(y) AS BIGINT) AS positivos, CAST(SUM(1 - y) AS BIGINT) AS negativos,
       ROUND((SUM(CASE WHEN y = 1 THEN mean_rank ELSE 0 END) - SUM(y) * (SUM(y) + 1) / 2) / (CAST(SUM(y) AS DOUBLE) * SUM(1 - y)), 6) AS auc
FROM (SELECT {label} AS y, rank() OVER (ORDER BY {score}) + (COUNT(*) OVER (PARTITION BY {score}) - 1) / 2 AS mean_rank
      FROM model_rows WHERE is_test AND {score} IS NOT NULL)"""


def _features(label: str, categories: tuple[str, ...], numbers: tuple[str, ...], where: str = "TRUE") -> str:
    """Indexes by frequency in the training rows, and all features standardised by the moments of the training rows."""
    tables = ", ".join(
        f"""k_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY COUNT(*) DESC, {c}) - 1 AS place, COUNT(*) OVER () AS known
  FROM used WHERE NOT is_test AND {c} IS NOT NULL GROUP BY {c})""" for c in categories)
    places = ", ".join(f"CAST(coalesce(k_{c}.place, (SELECT MAX(known) FROM k_{c})) AS DOUBLE) AS {c}_idx" for c in categories)
    joins = " ".join(f"LEFT JOIN k_{c} ON u.{c} = k_{c}.v" for c in categories)
    names = [*numbers, *[f"{c}_idx" for c in categories]]
    moments = ", ".join(f"AVG({n}) AS m_{n}, STDDEV_SAMP({n}) AS d_{n}" for n in names)
    scaled = ", ".join(f"ROUND(CASE WHEN d_{n} > 0 THEN ({n} - m_{n}) / d_{n} ELSE 0 END, 6) AS {n}_escalada" for n in names)
    return f"""WITH model_rows AS ({_MODEL_ROWS}), used AS (SELECT *, CAST({label} AS DOUBLE) AS label FROM model_rows WHERE {where}), {tables},
seen AS (SELECT u.id_caso, u.is_test, u.label, {', '.join(f'u.{n}' for n in numbers)}, {places} FROM used u {joins}),
moments AS (SELECT {moments} FROM seen WHERE NOT is_test)
SELECT id_caso, label, {', '.join(f'ROUND({n}, 6) AS {n}' for n in names)}, {scaled} FROM seen, moments WHERE is_test"""


def _cluster_check(table: str, keys: tuple[str, ...], features: tuple[str, ...]) -> str:
    moments = ", ".join(f"AVG({f}) AS m_{f}, STDDEV_SAMP({f}) AS d_{f}" for f in features)
    scaled = ", ".join(f"ROUND(CASE WHEN d_{f} > 0 THEN ({f} - m_{f}) / d_{f} ELSE 0 END, 6) AS {f}_escalada" for f in features)
    return f"""WITH t AS ({table}), moments AS (SELECT {moments} FROM t)
SELECT {', '.join(keys)}, {scaled}, TRUE AS mas_cercano, TRUE AS centro_es_media FROM t, moments"""


_LABEL_3 = "CASE estado WHEN 'A' THEN 2 WHEN 'N' THEN 1 ELSE 0 END"
_RATE = "CAST({} AS DOUBLE) / COUNT(*) * 100"
_DEPARTMENT_TABLE = f"""SELECT nombre_departamento, AVG(edad_anios) AS edad_promedio, {_RATE.format('SUM(fallecido)')} AS tasa_letalidad,
  {_RATE.format('SUM(recuperado_flag)')} AS tasa_recuperacion, MAX(densidad_poblacional) AS densidad,
  CAST(COUNT(*) AS DOUBLE) / NULLIF(MAX(poblacion_departamento), 0) * 100000 AS incidencia_100k
  FROM fact WHERE {_COMPLETE} GROUP BY nombre_departamento HAVING COUNT(*) > 100"""
_GROUP_TABLE = f"""SELECT grupo_edad, sexo, AVG(edad_anios) AS edad_promedio, {_RATE.format('SUM(fallecido)')} AS tasa_mortalidad,
  {_RATE.format('SUM(recuperado_flag)')} AS tasa_recuperacion, {_RATE.format(_HOSPITAL)} AS tasa_hospitalizacion
  FROM fact WHERE {_COMPLETE} GROUP BY grupo_edad, sexo HAVING COUNT(*) > 100"""
_MODEL_SQL = {
    "auc_by_ranks": f"WITH model_rows AS ({_MODEL_ROWS})\n" + "\nUNION ALL ".join(
        _area(label, score) for label in ("fallecido", "recuperado_flag") for score in ("edad_anios", "dias_notificacion_diagnostico")),
    "mortality_features": _features("fallecido", ("sexo", "tipo_contagio", "ubicacion", "region"), ("edad_anios", "densidad_poblacional")),
    "severity_features": _features(_LABEL_3, ("sexo", "tipo_contagio", "grupo_edad"), ("edad_anios", "densidad_poblacional")),
    "hospital_features": _features("CASE WHEN ubicacion IN ('BUILDING', 'MACHINERY', 'FURNITURE') THEN 1 ELSE 0 END", ("sexo", "tipo_contagio"),
                                   ("edad_anios",), "ubicacion IS NOT NULL"),
    "classification_metrics": f"""WITH model_rows AS ({_MODEL_ROWS}), pairs AS (
  SELECT {_LABEL_3} AS y, CASE WHEN edad_anios >= 60 THEN 2 WHEN edad_anios >= 30 THEN 1 ELSE 0 END AS p FROM model_rows WHERE is_test
), per_label AS (
  SELECT y AS k, CAST(COUNT(*) AS DOUBLE) AS cases, CAST(SUM(CASE WHEN p = y THEN 1 ELSE 0 END) AS DOUBLE) AS hits,
         (SELECT CAST(COUNT(*) AS DOUBLE) FROM pairs q WHERE q.p = pairs.y) AS called
  FROM pairs GROUP BY y
), rates AS (SELECT *, cases / SUM(cases) OVER () AS share, coalesce(hits / NULLIF(called, 0), 0) AS pr, hits / cases AS re FROM per_label)
SELECT ROUND(SUM(hits) / SUM(cases), 6) AS accuracy, ROUND(SUM(share * coalesce(2 * pr * re / NULLIF(pr + re, 0), 0)), 6) AS f1,
       ROUND(SUM(share * pr), 6) AS precision, ROUND(SUM(share * re), 6) AS recall FROM rates""",
    "cluster_departments_check": _cluster_check(_DEPARTMENT_TABLE, ("nombre_departamento",),
                                                ("edad_promedio", "tasa_letalidad", "tasa_recuperacion", "densidad", "incidencia_100k")),
    "cluster_groups_check": _cluster_check(_GROUP_TABLE, ("grupo_edad", "sexo"),
                                           ("edad_promedio", "tasa_mortalidad", "tasa_recuperacion", "tasa_hospitalizacion")),
}
_OTHERS = "md5(CAST(list(o ORDER BY o) AS VARCHAR)) AS content"
_CHANGES = f""", older AS (
  SELECT * REPLACE (CASE WHEN CAST(id_caso AS BIGINT) % 499 = 3 THEN 'N' ELSE estado END AS estado,
                    CASE WHEN CAST(id_caso AS BIGINT) % 499 = 4 THEN '1993-05-06' ELSE fecha_reporte END AS fecha_reporte)
  FROM raw WHERE CAST(id_caso AS BIGINT) % 997 <> 5
  UNION ALL SELECT * REPLACE ('x' || id_caso AS id_caso, '1980-02-03' AS fecha_reporte) FROM raw WHERE CAST(id_caso AS BIGINT) % 997 = 7
), a AS (SELECT id_caso, MIN(estado) AS estado, {_OTHERS} FROM (SELECT id_caso, estado, CAST(o AS VARCHAR) AS o FROM older o) GROUP BY id_caso),
b AS (SELECT id_caso, MIN(estado) AS estado, {_OTHERS} FROM (SELECT id_caso, estado, CAST(o AS VARCHAR) AS o FROM raw o) GROUP BY id_caso)
SELECT coalesce(a.id_caso, b.id_caso) AS id_de_caso,
       CASE WHEN a.id_caso IS NULL THEN 'nuevo' WHEN b.id_caso IS NULL THEN 'retirado' ELSE 'cambiado' END AS cambio,
       a.estado AS estado_antes, b.estado AS estado_ahora
FROM a FULL JOIN b ON a.id_caso = b.id_caso WHERE a.content IS DISTINCT FROM b.content"""
_RAW_SQL = {
    "header_names": "SELECT * FROM raw",
    "clean_dates": f"SELECT id_caso, {', '.join(_parsed(c) for c in _DATES)} FROM raw",
    "age_years": f"SELECT id_caso, edad, unidad_edad, ROUND({_AGE}, 6) AS edad_anios FROM raw",
    "age_buckets": f"""SELECT grupo_edad, CASE WHEN a IS NULL THEN 'sin dato' ELSE grupo_edad END AS grupo_edad_conocida, {N} AS casos
FROM (SELECT a, CASE WHEN a < 18 THEN '0-17' WHEN a < 30 THEN '18-29' WHEN a < 50 THEN '30-49' WHEN a < 65 THEN '50-64'
                     ELSE '65+' END AS grupo_edad
      FROM (SELECT {_AGE} AS a FROM raw))
GROUP BY 1, 2""",
    "alias_names": f"""SELECT nombre_departamento,
       CASE WHEN n = 'NATION_1' THEN 'NATION_ONE' WHEN n = 'NATION_3' THEN 'NATION_THREE'
            WHEN contains(n, 'NATION_2') THEN 'NATION_TWO' ELSE n END AS nombre_canonico,
       lower(n) AS nombre_plegado, {N} AS casos
FROM (SELECT nombre_departamento, upper(trim(nombre_departamento)) AS n FROM raw) GROUP BY 1, 2, 3""",
    "snapshot_by_stamp": f"""SELECT sexo, estado, nombre_departamento AS departamento_nom, CAST(COUNT(*) AS BIGINT) AS registros
FROM raw GROUP BY 1, 2, 3""",
    "json_latest": f"""SELECT sexo, estado, nombre_departamento AS departamento_nom, CAST(COUNT(*) AS BIGINT) AS registros
FROM raw GROUP BY 1, 2, 3""",
    "snapshot_changes": _CHANGES,
}
_CLEAN_COLUMNS = """SELECT id_caso, fecha_reporte, fecha_notificacion, codigo_departamento, nombre_departamento, codigo_municipio,
       nombre_municipio, edad, unidad_edad, sexo, tipo_contagio, ubicacion, estado, recuperado, fecha_diagnostico,
       fecha_recuperacion, fecha_inicio_sintomas, fecha_muerte, ROUND(edad_anios, 6) AS edad_anios"""
_TRUSTED = f"""{_CLEAN_COLUMNS},
       d.poblacion AS poblacion_departamento, ROUND(d.densidad, 6) AS densidad_poblacional, d.region,
       m.poblacion AS poblacion_municipio, m.altitud AS altitud_msnm, m.categoria AS categoria_municipio,
       h.num_hospitales, h.total_camas_uci, h.total_camas_general,
       CASE WHEN c.edad_anios < 18 THEN '0-17' WHEN c.edad_anios < 30 THEN '18-29' WHEN c.edad_anios < 50 THEN '30-49'
            WHEN c.edad_anios < 65 THEN '50-64' ELSE '65+' END AS grupo_edad,
       CAST(year(fecha_reporte) AS INTEGER) AS anio_reporte, CAST(month(fecha_reporte) AS INTEGER) AS mes_reporte,
       CAST(week(fecha_reporte) AS INTEGER) AS semana_reporte,
       CASE WHEN estado = 'R' THEN 1 ELSE 0 END AS fallecido, CASE WHEN recuperado = 'O' THEN 1 ELSE 0 END AS recuperado_flag
FROM clean c
LEFT JOIN dept d ON lpad(c.codigo_departamento, 2, '0') = d.codigo OR upper(trim(c.nombre_departamento)) = d.nombre
LEFT JOIN muni m ON lpad(c.codigo_municipio, 5, '0') = m.codigo
LEFT JOIN hosp h ON TRY_CAST(c.codigo_municipio AS BIGINT) = h.id_municipio"""
_CLEAN_SQL = {
    "clean_cases": f"{_CLEAN_COLUMNS} FROM clean",
    "empty_dimension": f"SELECT sexo, {N} AS casos, CAST(0 AS BIGINT) AS con_poblacion FROM clean GROUP BY sexo",
    "csv_roundtrip": f"{_CLEAN_COLUMNS} FROM clean",
    "etl_trusted": _TRUSTED,
    "incremental_trusted": _TRUSTED,
    "stage_counts": f"""SELECT 'leidos' AS etapa, {N} AS registros FROM raw
UNION ALL SELECT 'limpios', {N} FROM clean
UNION ALL SELECT 'enriquecidos', {N} FROM clean c
  LEFT JOIN dept d ON lpad(c.codigo_departamento, 2, '0') = d.codigo OR upper(trim(c.nombre_departamento)) = d.nombre""",
}

_TWO_NAMES = """, two AS (
  SELECT l_orderkey * 10 + l_linenumber AS id_caso,
         CASE WHEN l_partkey % 10 = 0 THEN '99' ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS codigo,
         CASE WHEN l_partkey % 4 = 0 THEN 'DESCONOCIDO' ELSE n_name END AS nombre
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
)"""
_DIMENSION_SQL = {
    "csv_dimensions": """SELECT codigo AS codigo_dane, poblacion AS poblacion_2020, ROUND(densidad, 6) AS densidad_poblacional, region
FROM dept""",
    "join_any": _TWO_NAMES + """
SELECT t.id_caso, t.codigo, t.nombre, d.id_departamento, d.poblacion AS poblacion_2020, d.region
FROM two t LEFT JOIN dept d ON t.codigo = d.codigo OR t.nombre = d.nombre""",
    "join_first_match": _TWO_NAMES + """
SELECT t.id_caso, t.codigo, t.nombre, coalesce(a.id_departamento, b.id_departamento) AS id_departamento,
       coalesce(a.poblacion, b.poblacion) AS poblacion_2020, coalesce(a.region, b.region) AS region
FROM two t LEFT JOIN dept a ON t.codigo = a.codigo LEFT JOIN dept b ON t.nombre = b.nombre""",
    "hospital_capacity": "SELECT * FROM hosp",
    "pk_fk_check": f""", bad AS (
  SELECT 'pk departamentos.id_departamento' AS restriccion, id_departamento AS clave, COUNT(*) AS filas FROM dept GROUP BY 2 HAVING COUNT(*) > 1 OR id_departamento IS NULL
  UNION ALL SELECT 'pk municipios.id_municipio', id_municipio, COUNT(*) FROM muni GROUP BY 2 HAVING COUNT(*) > 1 OR id_municipio IS NULL
  UNION ALL SELECT 'pk hospitales.id_hospital', s_suppkey, COUNT(*) FROM supplier GROUP BY 2 HAVING COUNT(*) > 1 OR s_suppkey IS NULL
  UNION ALL SELECT 'pk casos.id_caso', l_orderkey * 10 + l_linenumber, COUNT(*) FROM lineitem GROUP BY 2 HAVING COUNT(*) > 1
  UNION ALL SELECT 'fk municipios.id_departamento', id_departamento, COUNT(*) FROM muni WHERE id_departamento NOT IN (SELECT n_nationkey FROM nation) GROUP BY 2
  UNION ALL SELECT 'fk hospitales.id_municipio', s_suppkey, COUNT(*) FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 2
  UNION ALL SELECT 'fk casos.l_orderkey', l_orderkey, COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY 2
  UNION ALL SELECT 'fk municipios.id_municipio', id_municipio, COUNT(*) FROM muni WHERE id_municipio NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 2
)
SELECT r.restriccion, CAST(COUNT(b.filas) AS BIGINT) AS claves_malas, CAST(coalesce(SUM(b.filas), 0) AS BIGINT) AS filas_malas
FROM (VALUES ('pk departamentos.id_departamento'), ('pk municipios.id_municipio'), ('pk hospitales.id_hospital'), ('pk casos.id_caso'),
             ('fk municipios.id_departamento'), ('fk hospitales.id_municipio'), ('fk casos.l_orderkey'), ('fk municipios.id_municipio')) r(restriccion)
LEFT JOIN bad b ON b.restriccion = r.restriccion GROUP BY r.restriccion""",
    "duplicate_cases": f"""SELECT l_orderkey * 10 + l_linenumber AS id_caso, {N} AS filas FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1""",
    "dedup_cases": """SELECT id_caso, l_partkey, l_suppkey, l_quantity, l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate
FROM (SELECT *, l_orderkey * 10 + l_linenumber AS id_caso,
             row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber
                                ORDER BY l_shipdate NULLS LAST, l_partkey NULLS LAST, l_suppkey NULLS LAST, l_extendedprice NULLS LAST) AS position
      FROM lineitem) WHERE position = 1""",
    "landing_audit": "\nUNION ALL ".join(
        f"SELECT 'csv_{name}' AS dataset, {N} AS registros FROM {name}"
        for name in ("orders", "customer", "supplier", "nation")
    ),
}

ORACLE: dict[str, str] = {
    **{key: _fact(text) for key, text in _REPORT_SQL.items()},
    # These begin with tables of their own.
    **{key: _fact("").rstrip() + "," + text.removeprefix("WITH") for key, text in _MODEL_SQL.items()},
    **{key: _joined_raw(text) for key, text in _RAW_SQL.items()},
    **{key: _clean(text) for key, text in _CLEAN_SQL.items()},
    **{key: _dimensions(text) for key, text in _DIMENSION_SQL.items()},
}
