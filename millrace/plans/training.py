"""Train, evaluate, promote and score churn models with MLlib."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from millrace import schemas
from millrace.functions.features import to_model_matrix
from millrace.operators import promotion
from millrace.operators.evaluation import accuracy, roc_auc
from millrace.operators.profiles import PROFILE, profile
from millrace.operators.ranks import stratified_split
from millrace.operators.validation import accepted, check_records
from millrace.session import stored
from millrace.settings import Settings
from millrace.sources.tables import read_or_empty


def split_matrix(
    customers: DataFrame, settings: Settings, order: Column | None = None
) -> DataFrame:
    """Model columns with id, label and an exact stratified ``split``, by a hash of the id or ``order``.

    Rows of which no model feature can be made, such as those of a tenure outside
    its buckets, or without a label are left out.

    The matrix is stored: the split takes several passes, and the null checks, pushed down
    to the source with all features' expressions in them, are too long for the JVM to compile.
    """
    matrix = to_model_matrix(customers, (settings.id_column, settings.target_column))
    matrix = stored(matrix, "matrix").dropna(subset=[*schemas.MODEL_FEATURES, settings.target_column])
    return stratified_split(
        matrix,
        settings.target_column,
        settings.id_column,
        settings.test_size,
        settings.val_size,
        settings.seed,
        order,
    )


def spread(rows: DataFrame, key: str, partitions: int) -> DataFrame:
    """Rows in a fixed number of partitions, in order of their key.

    A forest draws its rows by partition and place, so this makes the model the
    same on any cluster and for any layout of the input.
    """
    return rows.repartition(partitions, key).sortWithinPartitions(key)


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=schemas.MODEL_FEATURES, outputCol="raw_features")


def scaling_stages(n_train: int) -> list:
    """Centre each column and divide by its population deviation.

    The scaler divides by the sample deviation; the constant factor after it
    turns that into the population one.
    """
    factor = math.sqrt(n_train / (n_train - 1)) if n_train > 1 else 1.0
    return [
        _assembler(),
        StandardScaler(inputCol="raw_features", outputCol="scaled", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="scaled",
            outputCol="features",
            scalingVec=Vectors.dense([factor] * len(schemas.MODEL_FEATURES)),
        ),
    ]


def baseline_pipeline(n_train: int, settings: Settings) -> Pipeline:
    """Scaled logistic regression with an L2 penalty of 1/n per mean loss."""
    return Pipeline(
        stages=[
            *scaling_stages(n_train),
            LogisticRegression(
                labelCol=settings.target_column,
                maxIter=settings.max_iterations,
                regParam=1.0 / n_train,
                elasticNetParam=0.0,
                standardization=False,
            ),
        ]
    )


def candidate_pipeline(settings: Settings) -> Pipeline:
    """Random forest on the unscaled columns."""
    return Pipeline(
        stages=[
            _assembler(),
            RandomForestClassifier(
                featuresCol="raw_features",
                labelCol=settings.target_column,
                numTrees=settings.trees,
                maxDepth=settings.tree_depth,
                minInstancesPerNode=settings.min_leaf_rows,
                featureSubsetStrategy="sqrt",
                seed=settings.seed,
                # The same trees, but no row walks each tree from its root at every level.
                cacheNodeIds=True,
            ),
        ]
    )


#: One row per training.
REPORT = (
    "model_version string, trained_at timestamp, candidate_promoted boolean, selection_reason string, "
    "promoted boolean, reason string, incumbent_version string, incumbent_auc double, n_rows long, "
    "n_left_out long, baseline_path string, candidate_path string"
)


@dataclass(frozen=True)
class Fitted:
    baseline: PipelineModel
    candidate: PipelineModel
    metrics: dict[tuple[str, str], dict]
    n_rows: int
    n_left_out: int = 0
    #: Profile of the drift features of all rows given.
    profile: list[Row] = ()


def probability(column: str = "probability"):
    return vector_to_array(F.col(column))[1]


def evaluate(models: dict[str, PipelineModel], rows: DataFrame, settings: Settings) -> list:
    """Accuracy, ROC AUC (4 decimals) and rows per (model, split).

    Scoring is the costly part and the metrics need the scores several times,
    so the narrow scored rows are persisted for all models together.
    """
    label = settings.target_column
    scored = reduce(
        DataFrame.unionByName,
        [
            model.transform(rows).select(
                F.lit(name).alias("model"),
                "split",
                label,
                F.col("prediction").cast("int").alias("prediction"),
                probability().alias("score"),
            )
            for name, model in models.items()
        ],
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        keys = ["model", "split"]
        hits = accuracy(scored, "prediction", label, keys)
        areas = roc_auc(scored, "score", label, keys)
        return (
            hits.join(areas, keys)
            .select(
                *keys,
                F.round("accuracy", 4).alias("accuracy"),
                F.round("roc_auc", 4).alias("roc_auc"),
                "n_samples",
            )
            .collect()
        )
    finally:
        scored.unpersist()


def fit_and_evaluate(
    customers: DataFrame, settings: Settings = Settings(), *, order: Column | None = None
) -> Fitted:
    """Fit both models on the training rows and measure them on val and test.

    The matrix is persisted once for the many passes of both fits; a lost
    block is recomputed, and row membership does not change when it is.
    """
    given = profile(customers, list(settings.drift_features)).collect()
    n_given = given[0].n_rows if given else 0
    # By the rows alone, so a forest is the same on any cluster.
    partitions = max(16, math.ceil(n_given / settings.training_partition_rows))
    rows = spread(
        split_matrix(customers, settings, order), settings.id_column, partitions
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
        train = rows.where("split = 'train'")
        baseline = baseline_pipeline(sizes["train"], settings).fit(train)
        candidate = candidate_pipeline(settings).fit(train)
        models = {"baseline": baseline, "candidate": candidate}
        report = evaluate(models, rows.where("split <> 'train'"), settings)
    finally:
        rows.unpersist()
    metrics = {
        (r.model, r.split): {
            "accuracy": r.accuracy,
            "roc_auc": r.roc_auc,
            "n_samples": r.n_samples,
        }
        for r in report
    }
    used = sum(sizes.values())
    return Fitted(baseline, candidate, metrics, used, n_given - used, given)


def metrics_table(spark: SparkSession, fitted: Fitted) -> DataFrame:
    rows = [
        (model, split, m["accuracy"], m["roc_auc"], m["n_samples"])
        for (model, split), m in sorted(fitted.metrics.items())
    ]
    return spark.createDataFrame(
        rows, "model string, split string, accuracy double, roc_auc double, n_samples long"
    )


def _decision(spark: SparkSession, fitted: Fitted, incumbent, settings: Settings):
    """``incumbent`` is the production row, None if nothing is deployed; its AUC may be null."""
    auc = {key: m["roc_auc"] for key, m in fitted.metrics.items()}
    metrics = spark.createDataFrame(
        [
            (
                "all",
                auc["baseline", "val"],
                auc["candidate", "val"],
                auc["baseline", "test"],
                auc["candidate", "test"],
            )
        ],
        "segment string, baseline_val_auc double, candidate_val_auc double, "
        "baseline_test_auc double, candidate_test_auc double",
    )
    deployed = [] if incumbent is None else [("all", incumbent.test_metrics.roc_auc)]
    incumbents = spark.createDataFrame(deployed, "segment string, production_auc double")
    return promotion.decide_segments(metrics, incumbents, ["segment"], settings).first()


def _registry_row(spark, sequence, version, model_type, promoted, reason, metrics, path, at):
    row = (
        sequence,
        version,
        model_type,
        promoted,
        reason,
        at,
        schemas.MODEL_FEATURES,
        (metrics["accuracy"], metrics["roc_auc"], metrics["n_samples"]),
        path,
    )
    return spark.createDataFrame([row], promotion.REGISTRY)


class ModelStore:
    """Models, registry and evaluation reports below one folder.

    The registry only grows: "production", "archived" and "rejected" are read
    from it, and no model folder is ever overwritten.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def registry(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/registry", promotion.REGISTRY)

    def production(self):
        return promotion.production_models(self.registry()).first()

    def evaluations(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/evaluations")

    def reports(self) -> DataFrame:
        """One row per training: the decision, its reasons, the incumbent and both models."""
        return self.spark.read.parquet(f"{self.path}/reports")

    def profile(self, row) -> DataFrame:
        """The profile of the rows a model was trained on."""
        return self.spark.read.parquet(f"{self.path}/profiles/model_version={row.model_version}")

    def load(self, row) -> PipelineModel:
        return PipelineModel.load(row.model_path)

    def add(self, row: DataFrame) -> None:
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/registry")

    def next_sequence(self) -> int:
        top = self.registry().agg(F.max("sequence")).first()[0]
        return 0 if top is None else top + 1


def _store(store: ModelStore, fitted: Fitted, decision, promoted, reason, incumbent=None):
    """Save both models, the training profile, report and evaluation rows and, last, the registry row."""
    spark = store.spark
    at = datetime.now(timezone.utc)
    sequence = store.next_sequence()
    version = f"{at:v%Y%m%d_%H%M%S}_{sequence}"
    picked = "candidate" if decision.candidate_promoted else "baseline"
    paths = {name: f"{store.path}/models/{version}/{name}" for name in ("baseline", "candidate")}
    for name, path in paths.items():
        getattr(fitted, name).write().overwrite().save(path)
    path = paths[picked]
    spark.createDataFrame(fitted.profile, PROFILE).coalesce(1).write.mode("overwrite").parquet(
        f"{store.path}/profiles/model_version={version}"
    )
    report = (
        version, at, decision.candidate_promoted, decision.selection_reason, promoted, reason,
        incumbent.model_version if incumbent else None,
        incumbent.test_metrics.roc_auc if incumbent else None,
        fitted.n_rows, fitted.n_left_out, paths["baseline"], paths["candidate"],
    )
    spark.createDataFrame([report], REPORT).coalesce(1).write.mode("append").parquet(f"{store.path}/reports")
    metrics_table(spark, fitted).withColumn("model_version", F.lit(version)).coalesce(
        1
    ).write.mode("append").parquet(f"{store.path}/evaluations")
    row = _registry_row(
        spark,
        sequence,
        version,
        decision.model_type,
        promoted,
        reason,
        fitted.metrics[picked, "test"],
        path,
        at,
    )
    store.add(row)
    return row.first()


def train(
    customers: DataFrame,
    store: ModelStore,
    settings: Settings = Settings(),
    *,
    order: Column | None = None,
):
    """First training: deploy the candidate if it passes the guardrail, else the baseline."""
    fitted = fit_and_evaluate(customers, settings, order=order)
    decision = _decision(store.spark, fitted, None, settings)
    return _store(store, fitted, decision, True, decision.selection_reason)


def retrain(
    customers: DataFrame,
    store: ModelStore,
    settings: Settings = Settings(),
    *,
    order: Column | None = None,
):
    """Train again and replace production only if the guardrail allows it.

    A rejected attempt is registered too; production stays as it is.
    """
    incumbent = store.production()
    fitted = fit_and_evaluate(customers, settings, order=order)
    decision = _decision(store.spark, fitted, incumbent, settings)
    prefix = "[retrain] " if decision.promoted else ""
    return _store(
        store,
        fitted,
        decision,
        decision.promoted,
        prefix + decision.promotion_reason,
        incumbent,
    )


def score(
    model: PipelineModel,
    rows: DataFrame,
    model_version: str,
    model_type: str,
    keep: tuple[str, ...] = ("customer_id",),
) -> DataFrame:
    """Score valid customer rows, batch or stream: prediction at probability >= 0.5."""
    valid = accepted(check_records(rows))
    scored = model.transform(to_model_matrix(valid, keep))
    return scored.select(
        *keep,
        (probability() >= 0.5).cast("int").alias("churn_prediction"),
        F.round(probability(), 4).alias("churn_probability"),
        F.lit(model_version).alias("model_version"),
        F.lit(model_type).alias("model_type"),
    )
