"""Risk models and profile clusters on Spark ML.

Training and test rows come from a hash of the case id, training rows are cached while a model is
fitted, and every result is a DataFrame.  What reaches the driver is the fitted model, its metrics
and label counts, none of which grow with the cases.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigia.functions.dates import days_between
from vigia.model import CASE_COLUMNS, Thresholds, Vocabulary
from vigia.operators.forest import drawn, grow, merged
from vigia.operators.prefix import area_under_curve
from vigia.operators.report import Report, run_report
from vigia.operators.split import hash_split
from vigia.plans.reports import (
    CASES,
    CFR,
    HOSPITAL_SHARE,
    MEAN_AGE,
    PER_100K_DEPARTMENT,
    RECOVERY,
)
from vigia.sources.scratch import scratch_path

# Model settings and features.
SEED = 42
TRAIN_PERCENT = 80
MORTALITY_TREES, MORTALITY_DEPTH = 100, 10
SEVERITY_TREES, SEVERITY_DEPTH = 100, 8
HOSPITAL_ITERATIONS = 100
DEPARTMENT_CLUSTERS, GROUP_CLUSTERS = 4, 3
# From so many training rows on, and if so many of them are equal on average, a forest is grown on merged rows.
MERGED_ROWS, MERGED_SHARE = 1_000_000, 4
# Centres and means that differ by less are the same.
CLOSE = 1e-6
COMPLETE = ("edad_anios", "sexo", "nombre_departamento", "tipo_contagio")
DEPARTMENT_FEATURES = ("edad_promedio", "tasa_letalidad", "tasa_recuperacion", "densidad", "incidencia_100k")
GROUP_FEATURES = ("edad_promedio", "tasa_mortalidad", "tasa_recuperacion", "tasa_hospitalizacion")
METRIC_NAMES = (
    "mortality_auc", "mortality_accuracy", "mortality_f1",
    "severity_accuracy", "severity_f1", "severity_precision", "severity_recall",
    "hospitalization_auc", "hospitalization_accuracy",
)

DEPARTMENT_TABLE = Report(
    "caracteristicas_departamentos", ("nombre_departamento",),
    {"total_casos": CASES, "edad_promedio": MEAN_AGE, "tasa_letalidad": CFR, "tasa_recuperacion": RECOVERY,
     "poblacion": "max(poblacion_departamento)", "densidad": "max(densidad_poblacional)",
     "incidencia_100k": PER_100K_DEPARTMENT},
    having="total_casos > {cluster_cases}", optional=True,
)
GROUP_TABLE = Report(
    "caracteristicas_grupos", ("grupo_edad", "sexo"),
    {"total_casos": CASES, "edad_promedio": MEAN_AGE, "tasa_mortalidad": CFR,
     "tasa_recuperacion": RECOVERY, "tasa_hospitalizacion": HOSPITAL_SHARE},
    having="total_casos > {cluster_cases}",
)


@dataclass(frozen=True)
class Fitted:
    """A classifier's test predictions and metrics; ``model`` is ``None`` if it was not trained."""

    predictions: DataFrame
    metrics: Mapping[str, float]
    model: PipelineModel | None = None
    features: tuple[str, ...] = ()
    warning: str | None = None


@dataclass(frozen=True)
class Clustered:
    """Rows with their cluster, and the mean profile of each cluster."""

    members: DataFrame
    profile: DataFrame
    model: PipelineModel | None = field(default=None)


@contextmanager
def _cached(df: DataFrame):
    """Cache while a fit reads the rows many times; lost blocks are computed again from the plan."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def prepare_cases(df: DataFrame) -> DataFrame:
    """Cases with all of age, sex, department and transmission, and the notification delay."""
    complete = F.lit(True)
    for column in COMPLETE:
        complete = complete & F.col(column).isNotNull()
    return df.filter(complete).withColumn(
        "dias_notificacion_diagnostico",
        days_between(F.col("fecha_notificacion"), F.col("fecha_diagnostico")),
    )


def _spread(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly, in as many tasks as their size asks for.

    A fit passes over its rows some hundred times, so a few large or uneven input files would keep most cores idle in each pass.
    REBALANCE lets adaptive execution choose the number by the advisory partition size.
    """
    return df.hint("rebalance")


def label_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("casos"))


def mortality_labels(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.col("fallecido").cast("double"))


def severity_labels(df: DataFrame, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    label = (
        F.when(F.col("estado").isin(*vocabulary.severe), 2.0)
        .when(F.col("estado").isin(*vocabulary.moderate), 1.0)
        .otherwise(0.0)
    )
    return df.withColumn("label", label)


def hospital_labels(df: DataFrame, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    label = F.when(F.col("ubicacion").isin(*vocabulary.hospital_label), 1.0).otherwise(0.0)
    return df.filter(F.col("ubicacion").isNotNull()).withColumn("label", label)


def _index(columns: Sequence[str]) -> StringIndexer:
    """One indexer for all columns: their labels are counted in one job."""
    return StringIndexer(inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns],
                         handleInvalid="keep")


def _assemble(columns: Sequence[str], output: str) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="skip")


def _scale() -> StandardScaler:
    return StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)


def _forest(trees: int, depth: int, seed: int) -> RandomForestClassifier:
    """The same trees with or without cached node ids.

    The ids take 4 bytes per tree and training row, twice while a pass makes the next ones and once more in a checkpoint: far more than
    the rows themselves.  So each pass follows its trees from the root instead.
    """
    return RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees,
                                  maxDepth=depth, seed=seed, cacheNodeIds=False)


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the scratch folder and read back: what follows scans this table and not the cases."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _from_counts(counts: Mapping[tuple[float, float], int]) -> dict[str, float]:
    """Metrics of a confusion table {(label, prediction): cases}, weighted by the cases of each label."""
    total = sum(counts.values())
    if not total:
        return {"accuracy": 0.0, "f1": 0.0, "weightedPrecision": 0.0, "weightedRecall": 0.0}
    precision = recall = f1 = 0.0
    for label in {k for k, _ in counts}:
        hits = counts.get((label, label), 0)
        cases = sum(n for (k, _), n in counts.items() if k == label)
        called = sum(n for (_, k), n in counts.items() if k == label)
        p, r = (hits / called if called else 0.0), hits / cases
        precision, recall = precision + p * cases / total, recall + r * cases / total
        f1 += (2 * p * r / (p + r) if p + r else 0.0) * cases / total
    accuracy = sum(n for (label, k), n in counts.items() if label == k) / total
    return {"accuracy": accuracy, "f1": f1, "weightedPrecision": precision, "weightedRecall": recall}


def _evaluate(rows: DataFrame, metrics: Mapping[str, str]) -> dict[str, float]:
    """Metrics of written (label, prediction, score) rows: one count of pairs, and the rank sums of the scores for the area."""
    decided = rows.filter(F.col("prediction").isNotNull())
    counts = {(r["label"], r["prediction"]): r["n"] for r in
              decided.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = _from_counts(counts)
    if "areaUnderROC" in metrics.values():
        # No area without both classes.
        found["areaUnderROC"] = area_under_curve(decided, "label", "score").first()["auc"] or 0.0
    return {name: found[metric] for name, metric in metrics.items()}


def _merged(rows: DataFrame, columns: Sequence[str]) -> DataFrame | None:
    """The different ones of ``rows`` with their numbers, written; None if there are few rows or few that are equal."""
    total = rows.count()
    if total < MERGED_ROWS:
        return None
    groups = _stored(merged(rows, columns), "groups")
    return groups if groups.count() * MERGED_SHARE <= total else None


def _with_forest(model: PipelineModel, forest: RandomForestClassifier, groups: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """``model`` and a forest over all rows that ``groups`` stands for."""
    classes = int(groups.agg(F.max("label")).first()[0]) + 1
    rows = drawn(model.transform(groups), columns, forest.getNumTrees(), forest.getSeed())
    return PipelineModel(stages=[*model.stages, grow(forest, rows, classes)])


def _classify(
    df: DataFrame,
    categories: Sequence[str],
    numbers: Sequence[str],
    features: Sequence[str],
    last: Sequence,
    output: Sequence[str],
    metrics: Mapping[str, str],
    seed: int,
) -> Fitted:
    used = list(dict.fromkeys(["id_caso", *categories, *numbers, *output, "label"]))
    train, test = hash_split(df.select(*used), "id_caso", TRAIN_PERCENT, seed)
    with _cached(_spread(train.select(*categories, *numbers, "label"))) as rows:
        index = _index(categories).fit(rows)
        # A category needs a bin for each of its labels and one for others.
        bins = max(32, 1 + max(map(len, index.labelsArray)))
        for stage in last:
            if isinstance(stage, RandomForestClassifier):
                stage.setMaxBins(bins)
        groups = _merged(rows, [*categories, *numbers, "label"]) if isinstance(last[-1], RandomForestClassifier) else None
        model = Pipeline(stages=[index, *last] if groups is None else [index, *last[:-1]]).fit(rows)
    if groups is not None:
        model = _with_forest(model, last[-1], groups, [*categories, *numbers, "label"])
    score = F.coalesce(F.get(vector_to_array("probability"), F.lit(1)), F.lit(0.0)).alias("score")
    predictions = model.transform(test).select(*output, "label", "prediction", score)
    # The assembler leaves out cases without all numbers: they are part of the result, undecided.
    missing = F.lit(False)
    for number in numbers:
        missing = missing | F.col(number).isNull() | F.isnan(F.col(number).cast("double"))
    undecided = test.filter(missing).select(*output, "label", F.lit(None).cast("double").alias("prediction"), F.lit(None).cast("double").alias("score"))
    written = _stored(predictions.unionByName(undecided), "predictions")
    return Fitted(
        written.select(*output, "label", "prediction"),
        _evaluate(written, metrics),
        model,
        tuple(features),
    )


def mortality_model(
    df: DataFrame,
    trees: int = MORTALITY_TREES,
    depth: int = MORTALITY_DEPTH,
    with_location: bool = True,
    seed: int = SEED,
) -> Fitted:
    """Random forest for death.

    The location of a case may give its outcome away; ``with_location=False`` leaves it out.
    """
    categories = ["sexo", "tipo_contagio"] + (["ubicacion"] if with_location else [])
    numbers = ["edad_anios"]
    if "region" in df.columns:
        categories.append("region")
    features = ["edad_anios", *[f"{c}_idx" for c in categories]]
    if "densidad_poblacional" in df.columns:
        numbers.append("densidad_poblacional")
        features.append("densidad_poblacional")
    forest = _forest(trees, depth, seed)
    return _classify(
        mortality_labels(df), categories, numbers, features,
        [_assemble(features, "features_raw"), _scale(), forest],
        ["id_caso", "edad_anios", "sexo", "nombre_departamento"],
        {"auc": "areaUnderROC", "accuracy": "accuracy", "f1": "f1"},
        seed,
    )


def severity_model(
    df: DataFrame,
    vocabulary: Vocabulary = Vocabulary(),
    trees: int = SEVERITY_TREES,
    depth: int = SEVERITY_DEPTH,
    seed: int = SEED,
) -> Fitted:
    """Random forest for mild, moderate and severe."""
    categories = ["sexo", "tipo_contagio", "grupo_edad"]
    numbers = ["edad_anios"]
    features = ["edad_anios", *[f"{c}_idx" for c in categories]]
    if "densidad_poblacional" in df.columns:
        numbers.append("densidad_poblacional")
        features.append("densidad_poblacional")
    forest = _forest(trees, depth, seed)
    return _classify(
        severity_labels(df, vocabulary), categories, numbers, features,
        [_assemble(features, "features"), forest],
        ["id_caso", "edad_anios", "sexo", "estado"],
        {"accuracy": "accuracy", "f1": "f1", "precision": "weightedPrecision", "recall": "weightedRecall"},
        seed,
    )


def hospitalization_model(
    df: DataFrame,
    vocabulary: Vocabulary = Vocabulary(),
    iterations: int = HOSPITAL_ITERATIONS,
    seed: int = SEED,
) -> Fitted:
    """Logistic regression for a stay in hospital; not trained on data of a single class."""
    labelled = hospital_labels(df, vocabulary)
    output = ["id_caso", "edad_anios", "ubicacion"]
    classes = label_counts(labelled).count()
    if classes < 2:
        untrained = labelled.select(*output, "label", F.lit(None).cast("double").alias("prediction"))
        return Fitted(
            untrained.filter(F.lit(False)),
            {"auc": 0.0, "accuracy": float(classes)},
            warning="single class, model not trained",
        )
    features = ["edad_anios", "sexo_idx", "tipo_contagio_idx"]
    regression = LogisticRegression(labelCol="label", featuresCol="features", maxIter=iterations)
    return _classify(
        labelled, ["sexo", "tipo_contagio"], ["edad_anios"], features,
        [_assemble(features, "features"), regression],
        output, {"auc": "areaUnderROC", "accuracy": "accuracy"}, seed,
    )


def feature_importance(fitted: Fitted, spark: SparkSession) -> DataFrame:
    """(feature, importance) of a forest, most important first."""
    weights = fitted.model.stages[-1].featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(fitted.features, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def _cluster(table: DataFrame, features: Sequence[str], k: int, profile: Mapping[str, str],
             key: Sequence[str], seed: int) -> Clustered | None:
    """K-means on standardised features; ``None`` with fewer complete rows than clusters."""
    table = _stored(table, "features")
    with _cached(table) as rows:
        if rows.dropna(subset=list(features)).count() < k:
            return None
        model = Pipeline(stages=[
            _assemble(features, "features_raw"), _scale(),
            KMeans(k=k, featuresCol="features", predictionCol="cluster", seed=seed),
        ]).fit(rows.orderBy(*key))
    members = model.transform(table)
    return Clustered(members, cluster_profile(members, profile), model)


def cluster_profile(members: DataFrame, profile: Mapping[str, str]) -> DataFrame:
    aggregates = [F.expr(text).alias(name) for name, text in profile.items()]
    return members.groupBy("cluster").agg(*aggregates).orderBy("cluster")


def department_table(df: DataFrame, thresholds: Thresholds = Thresholds(),
                     vocabulary: Vocabulary = Vocabulary()) -> DataFrame | None:
    return run_report(df, DEPARTMENT_TABLE, thresholds, vocabulary)


def group_table(df: DataFrame, thresholds: Thresholds = Thresholds(),
                vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    return run_report(df, GROUP_TABLE, thresholds, vocabulary)


def cluster_departments(df: DataFrame, thresholds: Thresholds = Thresholds(),
                        vocabulary: Vocabulary = Vocabulary(), k: int = DEPARTMENT_CLUSTERS,
                        seed: int = SEED) -> Clustered | None:
    """Departments by profile; ``None`` without the department dimension."""
    table = department_table(df, thresholds, vocabulary)
    if table is None:
        return None
    profile = {
        "num_departamentos": "count(1)", "casos_promedio": "avg(total_casos)",
        "letalidad_promedio": "avg(tasa_letalidad)", "incidencia_promedio": "avg(incidencia_100k)",
    }
    return _cluster(table, DEPARTMENT_FEATURES, k, profile, ["nombre_departamento"], seed)


def cluster_groups(df: DataFrame, thresholds: Thresholds = Thresholds(),
                   vocabulary: Vocabulary = Vocabulary(), k: int = GROUP_CLUSTERS,
                   seed: int = SEED) -> Clustered | None:
    """Age and sex groups by outcome."""
    profile = {
        "num_grupos": "count(1)", "mortalidad_promedio": "avg(tasa_mortalidad)",
        "hospitalizacion_promedio": "avg(tasa_hospitalizacion)",
    }
    table = group_table(df, thresholds, vocabulary)
    return _cluster(table, GROUP_FEATURES, k, profile, ["grupo_edad", "sexo"], seed)


def check_clusters(clustered: Clustered, features: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Members with their standardised features, ``mas_cercano`` (no centre is nearer than that of their cluster) and
    ``centro_es_media`` (the centre is the mean of its members), all as column expressions.

    The centres are a handful of numbers and stand in the plan; mean and deviation of the features come from the members.
    """
    moments = clustered.members.agg(
        *[F.avg(f).alias(f"__mean_{f}") for f in features], *[F.stddev_samp(f).alias(f"__dev_{f}") for f in features]).first()
    scaled = {f"{f}_escalada": F.when(F.lit(moments[f"__dev_{f}"] > 0), (F.col(f) - moments[f"__mean_{f}"]) / moments[f"__dev_{f}"]).otherwise(0.0)
              for f in features}
    rows = clustered.members.select(*key, "cluster", *[c.cast("double").alias(n) for n, c in scaled.items()])
    centres = [[float(x) for x in centre] for centre in clustered.model.stages[-1].clusterCenters()]
    distances = F.array(*[sum((F.pow(F.col(n) - x, 2) for n, x in zip(scaled, centre, strict=True)), F.lit(0.0)) for centre in centres])
    near = F.get(distances, F.col("cluster")) <= F.array_min(distances) + CLOSE
    own = F.array(*[F.array(*[F.lit(x) for x in centre]) for centre in centres])
    means = rows.groupBy("cluster").agg(F.array(*[F.avg(n) for n in scaled]).alias("__means"))
    apart = F.aggregate(F.zip_with("__means", F.get(own, F.col("cluster")), lambda a, b: F.abs(a - b)), F.lit(0.0), lambda most, x: F.greatest(most, x))
    return rows.join(means, "cluster").select(*key, *scaled, near.alias("mas_cercano"), (apart <= CLOSE).alias("centro_es_media"))


def model_features(df: DataFrame, categories: Sequence[str], numbers: Sequence[str], seed: int = SEED) -> DataFrame:
    """Test rows as the classifiers see them: id, label, numbers, the index of each category (``<name>_idx``), and all of them standardised.

    Indexes and moments are those of the training rows: a category's index is its place by frequency there, then by name; a category
    not seen there has the number of those that were.
    """
    train, test = hash_split(df.select("id_caso", *categories, *numbers, "label"), "id_caso", TRAIN_PERCENT, seed)
    names = [*numbers, *[f"{c}_idx" for c in categories]]
    with _cached(_spread(train)) as rows:
        model = Pipeline(stages=[_index(categories), _assemble(names, "features_raw"), _scale()]).fit(rows)
    values = vector_to_array("features")
    seen = model.transform(test)
    return seen.select("id_caso", "label", *names, *[F.get(values, F.lit(k)).alias(f"{n}_escalada") for k, n in enumerate(names)])


def classification_metrics(df: DataFrame) -> DataFrame:
    """One row of accuracy, f1, precision and recall (weighted by the cases of each label) of (label, prediction) rows."""
    found = _evaluate(df, {"accuracy": "accuracy", "f1": "f1", "precision": "weightedPrecision", "recall": "weightedRecall"})
    return df.sparkSession.createDataFrame([tuple(found.values())], ", ".join(f"{n} double" for n in found))


def cluster_members(clustered: Clustered) -> DataFrame:
    """Departments listed by cluster."""
    return clustered.members.select(
        "cluster", "nombre_departamento", "total_casos", "tasa_letalidad"
    ).orderBy("cluster", F.col("nombre_departamento").asc_nulls_first())


def metrics_row(mortality: Fitted | None, severity: Fitted | None, hospitalization: Fitted | None, spark: SparkSession) -> DataFrame:
    """All metrics as one row of named numbers, NULL for a model that could not be fitted."""
    values = {
        f"{prefix}_{name}": value
        for prefix, fitted in (("mortality", mortality), ("severity", severity),
                               ("hospitalization", hospitalization))
        if fitted is not None
        for name, value in fitted.metrics.items()
    }
    schema = ", ".join(f"{name} double" for name in METRIC_NAMES)
    return spark.createDataFrame([tuple(values.get(name) for name in METRIC_NAMES)], schema)


# Case columns the models read, for bindings that build only what is asked for.
MODEL_COLUMNS = tuple(
    c for c in CASE_COLUMNS
    if c in {"id_caso", "fecha_notificacion", "fecha_diagnostico", "nombre_departamento", "sexo",
             "tipo_contagio", "ubicacion", "estado", "edad_anios", "poblacion_departamento",
             "densidad_poblacional", "region", "grupo_edad", "fallecido", "recuperado_flag"}
)
