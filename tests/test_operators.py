import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import case_rows, same_rows, table_rows
from vigia.model import CASE_COLUMNS, Thresholds
from vigia.operators.dedup import keep_first
from vigia.operators.integrity import duplicate_keys, key_report, orphan_keys
from vigia.operators.lookup import coverage, join_any, join_first_match, lookup
from vigia.operators.report import Report, pivot_counts, required_columns, rollup, run_report, within_top
from vigia.operators.split import hash_split
from vigia.plans.reports import DATASETS, EXTRA_REPORTS, REPORTS, ROLLUP_OF, dataset, find_report

PARTITIONS = (1, 4, 7)


def test_dedup_is_the_same_for_any_partitioning(spark):
    rows = [(i % 50 if i % 3 else 0, random.Random(i).randint(0, 5), f"v{i % 13}", i % 4) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, a int, b string, c int").union(
        spark.createDataFrame([(None, 1, "x", 1), (None, 0, "y", 1)], "id int, a int, b string, c int"))
    results = [table_rows(keep_first(df.repartition(n), ["id"])) for n in PARTITIONS]
    assert results[0] == results[1] == results[2]
    groups = {}
    for row in (tuple(r) for r in df.collect()):
        groups.setdefault(row[0], []).append(row)
    assert {r[0]: r for r in results[0]} == {k: min(v, key=lambda t: t[1:]) for k, v in groups.items()}


def test_dedup_cuts_groups_before_the_shuffle(spark):
    plan = keep_first(spark.range(10).selectExpr("id % 3 AS k", "id AS v"), ["k"])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.index("row_number(), 1, Final") < physical.index("Exchange") < physical.index("row_number(), 1, Partial")


@pytest.fixture(scope="module")
def ambiguous(spark):
    """Facts and a dimension with repeated codes and names, NULLs and strangers."""
    rng = random.Random(5)
    codes, names = ["05", "11", "25", "99", None], ["A", "B", "C", "Z", None]
    facts = spark.createDataFrame(
        [(i, "25" if i % 3 == 0 else rng.choice(codes), rng.choice(names)) for i in range(500)],
        "id int, code string, name string")
    dimension = spark.createDataFrame(
        [("05", "A", 1), ("11", "B", 2), ("25", "B", 3), ("25", "C", 4), (None, "A", 5), ("05", None, 6), ("05", "A", 7)],
        "d_code string, d_name string, population int")
    return facts, dimension


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_join_any_equals_the_or_condition(spark, ambiguous, threshold):
    facts, dimension = ambiguous
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    naive = facts.join(dimension, (facts.code == dimension.d_code) | (facts.name == dimension.d_name), "left").select(
        "id", "code", "name", "population")
    expected = sorted(map(str, naive.collect()))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        joined = join_any(facts, dimension, F.col("code"), F.col("name"), "d_code", "d_name")
        assert joined.columns == ["id", "code", "name", "population"]
        assert sorted(map(str, joined.collect())) == expected
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_code_and_name_of_different_departments(spark, dimensions):
    case = spark.createDataFrame([(1, "25", "BOGOTA D.C."), (2, "77", "NADIE"), (3, "77", "BOGOTA D.C.")],
                                 "id int, code string, name string")
    dimension = dimensions["departamentos"].select("codigo_dane", "nombre_departamento", "poblacion_2020")
    arguments = (case, dimension, F.col("code"), F.col("name"), "codigo_dane", "nombre_departamento")
    assert table_rows(join_any(*arguments), "id", "poblacion_2020") == [(1, 3000), (1, 7000), (2, None), (3, 7000)]
    assert table_rows(join_first_match(*arguments), "id", "poblacion_2020") == [(1, 3000), (2, None), (3, 7000)]


def test_lookup_and_coverage(spark):
    facts = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    found = lookup(facts, spark.createDataFrame([(1, "x")], "id int, label string"), F.col("k"), "id")
    assert table_rows(found) == [(None, None), (1, "x"), (2, None)]
    assert coverage(found, ["label"]).first().asDict() == {"registros": 3, "con_label": 1}


def test_integrity(spark):
    parents = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    children = spark.createDataFrame([(1,), (3,), (3,), (None,)], "parent int")
    assert table_rows(duplicate_keys(parents, ["id"])) == [(None, 1), (2, 2)]
    assert table_rows(orphan_keys(children, "parent", parents, "id")) == [(3, 2)]
    report = key_report({"p": parents, "c": children}, {"p": "id"}, [("c", "parent", "p", "id")])
    assert table_rows(report) == [("fk c.parent", 1, 2), ("pk p.id", 2, 3)]


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(2000).withColumnRenamed("id", "id_caso")
    parts = [tuple(sorted(r[0] for r in hash_split(df.repartition(n), "id_caso")[1].collect())) for n in PARTITIONS]
    assert parts[0] == parts[1] == parts[2]
    assert 330 < len(parts[0]) < 470
    train, test = hash_split(df, "id_caso")
    assert train.count() + test.count() == 2000 and train.intersect(test).isEmpty()


# --- reports ---------------------------------------------------------------------------------

LOW = Thresholds(month_cases=5, critical_cases=20, recovered_cases=3, high_cfr=20, medium_cfr=15)


@pytest.fixture(scope="module")
def cases(spark):
    return case_rows(spark).cache()


def rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@pytest.mark.parametrize("name", sorted(ROLLUP_OF))
def test_a_rollup_gives_the_same_report(cases, name):
    keys = [k for k in ROLLUP_OF[name] if k in cases.columns]
    direct = rounded(dataset(cases, name, LOW))
    assert not direct.isEmpty()
    assert same_rows(direct, rounded(dataset(rollup(cases, keys), name, LOW)))


def test_reports_do_not_depend_on_partitions(cases):
    for name in ("geografia_departamentos", "dashboard_top_departamentos", "sql_casos_acumulados", "tiempo_recuperacion"):
        results = [[tuple(r) for r in rounded(dataset(cases.repartition(n), name, LOW)).collect()] for n in PARTITIONS]
        if not find_report(name).order:
            results = [sorted(r, key=str) for r in results]
        assert results[0] and results[0] == results[1] == results[2]


def test_group_counts_add_up(cases):
    total = cases.count()
    for name in ("temporal_mensual", "demografia_edad", "geografia_departamentos", "geografia_regiones", "tipo_contagio"):
        assert dataset(cases, name).agg(F.sum("total_casos")).first()[0] == total
    kpis = dataset(cases, "dashboard_kpis").first()
    assert (kpis.total_casos, kpis.departamentos_afectados, kpis.municipios_afectados) == (total, 5, 11)


def test_all_29_datasets_have_a_plan(cases):
    assert len(DATASETS) == 29
    assert all(dataset(cases, name) is not None for name in (*DATASETS, *EXTRA_REPORTS))


def test_without_enrichment(spark, cases):
    plain = cases.drop("region", "poblacion_departamento", "densidad_poblacional", "poblacion_municipio",
                       "num_hospitales", "total_camas_uci", "total_camas_general")
    assert dataset(plain, "geografia_departamentos").columns == ["nombre_departamento", "total_casos", "fallecidos", "tasa_letalidad"]
    regions = dataset(plain, "geografia_regiones")
    assert regions.dtypes == [("region", "string"), ("total_casos", "bigint"), ("fallecidos", "bigint")] and regions.isEmpty()
    assert dataset(plain, "geografia_municipios_top50").columns[-1] == "fallecidos"
    for name in ("infraestructura_salud", "municipios_criticos", "tasa_ataque"):
        assert dataset(plain, name) is None
    assert "region" not in dataset(plain, "sql_ranking_departamentos").columns
    top = dataset(plain, "sql_edad_region", Thresholds(top_departments=2))
    assert top.columns[0] == "nombre_departamento" and top.select("nombre_departamento").distinct().count() == 2
    with pytest.raises(ValueError, match="estado"):
        dataset(plain.drop("estado", "fallecido"), "estado_casos")


def test_zero_population_gives_no_rate(spark):
    df = spark.createDataFrame([("X", "R", 0, 1)], "nombre_departamento string, region string, poblacion_departamento int, fallecido int")
    row = dataset(df, "geografia_departamentos").first()
    assert row.casos_por_100k is None and row.tasa_letalidad == 100.0


def test_single_recovery_has_no_deviation(cases):
    one = cases.filter("recuperado_flag = 1").limit(1)
    row = dataset(one, "tiempo_recuperacion", Thresholds(recovered_cases=0)).first()
    assert row.casos_recuperados == 1 and row.desviacion_std is None


def test_pivot_counts_other_values_together(spark):
    df = spark.createDataFrame([("a", "F"), ("a", None), ("b", "M"), ("c", None)], "g string, s string")
    assert table_rows(pivot_counts(df, "g", "s", ["F", "M"])) == [("a", 1, 0, 1), ("b", 0, 1, 0), ("c", 0, 0, 1)]


def test_null_takes_a_place_in_the_top_and_is_dropped(spark):
    df = spark.createDataFrame([(None, 9), ("a", 5), ("b", 5), ("c", 1), ("a", 1)], "k string, n int")
    assert table_rows(within_top(df, "k", "n", 2)) == [("a", 1), ("a", 5)]
    assert table_rows(within_top(df, "k", "n", 3)) == [("a", 1), ("a", 5), ("b", 5)]


def test_ranks_share_ties(spark):
    df = spark.createDataFrame([("a", "r", 0)] * 2 + [("b", "r", 0)] * 2 + [("c", "r", 1)] + [(None, "r", 0)] * 5,
                               "nombre_departamento string, region string, fallecido int")
    rows = dataset(df, "sql_ranking_departamentos").select("nombre_departamento", "ranking").collect()
    assert [tuple(r) for r in rows] == [("a", 1), ("b", 1), ("c", 3)]


def test_required_columns_follow_states():
    assert required_columns(find_report("estado_casos")) == ["estado", "edad_anios"]
    assert set(required_columns(find_report("indice_gravedad"))) == {"nombre_departamento", "estado", "ubicacion", "fallecido"}
    for report in (*REPORTS.values(), *EXTRA_REPORTS.values()):
        assert set(required_columns(report)) <= set(CASE_COLUMNS)


def test_report_needs_no_case_vocabulary(spark):
    """Any table will do: keys, measures and order are all a report needs."""
    report = Report("orders", ("k",), {"total": "sum(v)"}, having="total > {month_cases}", order=("-total",))
    df = spark.createDataFrame([("a", 40), ("a", 20), ("b", 10)], "k string, v int")
    assert [tuple(r) for r in run_report(df, report).collect()] == [("a", 60)]
