import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tests.conftest import case_rows
from vigia.model import Thresholds
from vigia.operators.forest import drawn
from vigia.operators.forest import grow as models_grow
from vigia.plans import models

LOW = Thresholds(cluster_cases=20)


@pytest.fixture(scope="module")
def cases(spark):
    return models.prepare_cases(case_rows(spark, 1500)).cache()


def test_incomplete_cases_are_left_out(spark):
    rows = case_rows(spark, 300)
    prepared = models.prepare_cases(rows)
    assert prepared.count() == rows.filter("edad_anios IS NOT NULL").count() < rows.count()
    assert prepared.select("dias_notificacion_diagnostico").distinct().collect() == [(-2,)]


def test_mortality(spark, cases):
    fitted = models.mortality_model(cases, trees=5, depth=4)
    assert fitted.predictions.columns == ["id_caso", "edad_anios", "sexo", "nombre_departamento", "label", "prediction"]
    assert all(0.0 <= v <= 1.0 for v in fitted.metrics.values()) and set(fitted.metrics) == {"auc", "accuracy", "f1"}
    table = models.feature_importance(fitted, spark)
    assert abs(table.agg(F.sum("importance")).first()[0] - 1.0) < 1e-9
    assert set(r.feature for r in table.collect()) == {
        "edad_anios", "sexo_idx", "tipo_contagio_idx", "ubicacion_idx", "region_idx", "densidad_poblacional"}
    without = models.mortality_model(cases.drop("region", "densidad_poblacional"), trees=2, depth=2, with_location=False)
    assert without.features == ("edad_anios", "sexo_idx", "tipo_contagio_idx")


def test_test_rows_are_the_hashed_fifth(cases):
    ids = {r.id_caso for r in models.mortality_model(cases, trees=1, depth=1).predictions.collect()}
    expected = {r.id_caso for r in models.hash_split(cases, "id_caso")[1].select("id_caso").collect()}
    assert ids == expected and 0.1 < len(ids) / cases.count() < 0.3


def test_cases_without_all_numbers_stay_undecided(cases):
    gaps = cases.withColumn("densidad_poblacional", F.when(F.col("id_caso").cast("int") % 3 != 0, F.col("densidad_poblacional")))
    found = models.mortality_model(gaps, trees=1, depth=1).predictions
    expected = models.hash_split(gaps, "id_caso")[1]
    assert {r.id_caso for r in found.select("id_caso").collect()} == {r.id_caso for r in expected.select("id_caso").collect()}
    assert {r.id_caso for r in found.filter("prediction IS NULL").collect()} == {r.id_caso for r in expected.filter("densidad_poblacional IS NULL").collect()}


def test_many_labels_get_bins(cases):
    assert models.mortality_model(cases.withColumn("tipo_contagio", F.col("id_caso")), trees=1, depth=1).predictions.count() > 0


def test_metrics_of_counts(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    counts = {(0.0, 0.0): 5, (0.0, 1.0): 2, (1.0, 1.0): 3, (1.0, 2.0): 1, (2.0, 0.0): 4}
    rows = spark.createDataFrame([k for k, n in counts.items() for _ in range(n)], "label double, prediction double")
    for name, value in models._from_counts(counts).items():
        assert abs(MulticlassClassificationEvaluator(metricName=name).evaluate(rows) - value) < 1e-12


def test_clusters_read_their_written_table(cases):
    clustered = models.cluster_groups(cases, LOW)
    for df in (clustered.members, clustered.profile):
        plan = df._jdf.queryExecution().toString()
        assert "FileScan" in plan or "Relation" in plan
        assert "InMemoryRelation" not in plan and "fecha_reporte" not in plan


def test_no_deaths_give_no_curve(cases):
    fitted = models.mortality_model(cases.filter("fallecido = 0"), trees=1, depth=1)
    assert fitted.metrics == {"auc": 0.0, "accuracy": 1.0, "f1": 1.0}


def test_severity(cases):
    fitted = models.severity_model(cases, trees=4, depth=3)
    assert {r.label for r in fitted.predictions.select("label").distinct().collect()} == {0.0, 1.0, 2.0}
    assert set(fitted.metrics) == {"accuracy", "f1", "precision", "recall"}


def test_hospitalization_and_metrics(spark, cases):
    fitted = models.hospitalization_model(cases, iterations=5)
    assert fitted.warning is None and 0.0 <= fitted.metrics["auc"] <= 1.0
    one_class = models.hospitalization_model(cases.filter("ubicacion = 'Casa'"))
    assert one_class.predictions.isEmpty() and one_class.warning and one_class.metrics == {"auc": 0.0, "accuracy": 1.0}
    assert one_class.predictions.columns == fitted.predictions.columns
    row = models.metrics_row(models.mortality_model(cases, trees=1, depth=1), models.severity_model(cases, trees=1, depth=1), one_class, spark)
    assert row.columns == list(models.METRIC_NAMES) and row.count() == 1


def test_label_sets(spark):
    df = spark.createDataFrame([("Hospital UCI", "Grave"), ("Casa", "Moderado"), (None, "Leve")], "ubicacion string, estado string")
    assert sorted(r.label for r in models.hospital_labels(df).collect()) == [0.0, 1.0]
    assert sorted(r.label for r in models.severity_labels(df).collect()) == [0.0, 1.0, 2.0]
    assert sorted(tuple(r) for r in models.label_counts(models.severity_labels(df)).collect()) == [(0.0, 1), (1.0, 1), (2.0, 1)]


def test_clusters(cases):
    departments = models.cluster_departments(cases, LOW)
    members = models.cluster_members(departments).collect()
    assert len(members) == 5 and {r.cluster for r in members} <= {0, 1, 2, 3}
    assert departments.profile.agg(F.sum("num_departamentos")).first()[0] == 5
    groups = models.cluster_groups(cases, LOW)
    assert groups.profile.columns == ["cluster", "num_grupos", "mortalidad_promedio", "hospitalizacion_promedio"]
    assert {r.cluster for r in groups.members.collect()} <= {0, 1, 2}


def test_clusters_do_not_depend_on_partitions(cases):
    results = [
        [tuple(r) for r in models.cluster_members(models.cluster_departments(cases.repartition(n), LOW)).select("cluster", "nombre_departamento").collect()]
        for n in (1, 7)
    ]
    assert results[0] == results[1]


def test_too_few_groups_or_no_dimension(cases):
    assert models.cluster_departments(cases, Thresholds(cluster_cases=10**6)) is None
    assert models.cluster_departments(cases.drop("poblacion_departamento"), LOW) is None


def test_forests_leave_nothing_per_tree_and_row_behind(spark, tmp_path):
    rows = spark.range(400).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("label"))
    rows = rows.select("label", array_to_vector(F.array("x")).alias("features"))
    context = spark.sparkContext
    before, interval = context.getCheckpointDir(), 2
    context.setCheckpointDir(str(tmp_path / "c"))
    try:
        models._forest(20, 6, 1).setCheckpointInterval(interval).fit(rows)
    finally:
        if before:
            context.setCheckpointDir(before)
    assert not list((tmp_path / "c").rglob("part-*"))
    assert not models._forest(20, 6, 1).getCacheNodeIds()


def test_forests_over_merged_rows(spark, cases, monkeypatch):
    rows = cases.unionByName(cases.withColumn("id_caso", F.concat("id_caso", F.lit("b")))).unionByName(cases.withColumn("id_caso", F.concat("id_caso", F.lit("c"))))
    plain = models.mortality_model(rows, trees=20, depth=6)
    monkeypatch.setattr(models, "MERGED_ROWS", 1000)
    monkeypatch.setattr(models, "MERGED_SHARE", 1)
    fitted = [models.mortality_model(r, trees=20, depth=6) for r in (rows, rows.repartition(5))]
    forest = fitted[0].model.stages[-1]
    assert forest.getNumTrees == 20 and forest.numClasses == 2 and max(t.depth for t in forest.trees) == 6
    assert len({t.toDebugString for t in forest.trees}) > 15
    found = [sorted(tuple(r) for r in f.predictions.collect()) for f in fitted]
    assert found[0] == found[1] and len(found[0]) == plain.predictions.count()
    assert all(abs(plain.metrics[m] - fitted[0].metrics[m]) < 0.05 for m in plain.metrics)
    weights = [f.model.stages[-1].featureImportances.toArray() for f in (plain, fitted[0])]
    assert abs(weights[0] - weights[1]).max() < 0.1
    assert set(models.severity_model(rows, trees=4, depth=3).metrics) == {"accuracy", "f1", "precision", "recall"}


def test_a_forest_visits_equal_rows_once(spark, cases, monkeypatch):
    """Rows that a tree is given, not the cases."""
    monkeypatch.setattr(models, "MERGED_ROWS", 1000)
    monkeypatch.setattr(models, "MERGED_SHARE", 1)
    seen = []
    monkeypatch.setattr(models, "grow", lambda forest, rows, classes: seen.append((rows.count(), rows.agg(F.sum("n")).first()[0])) or models_grow(forest, rows, classes))
    models.mortality_model(cases.unionByName(cases), trees=2, depth=2)
    train = models.hash_split(models.mortality_labels(cases.unionByName(cases)), "id_caso")[0]
    assert seen == [(train.select("sexo", "tipo_contagio", "ubicacion", "region", "edad_anios", "densidad_poblacional", "label").distinct().count(), train.count())]


def test_draws_are_those_of_a_bootstrap(spark):
    groups = spark.range(2000).select("id", (F.col("id") % 50 + 1).alias("n"))
    draws = drawn(groups, ["id"], 8, 7).collect()
    apart = [(r[f"draw{k}"] - r["n"]) / r["n"] ** 0.5 for r in draws for k in range(8)]
    mean = sum(apart) / len(apart)
    assert abs(mean) < 0.03 and abs(sum(a * a for a in apart) / len(apart) - 1) < 0.05
    assert {tuple(r) for r in drawn(groups.repartition(3), ["id"], 8, 7).collect()} == {tuple(r) for r in draws}
