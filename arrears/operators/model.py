"""Default-risk model on Spark ML.

The pipeline carries its own preparation -- the frozen one-hot columns (M1)
as a SQL transformer and the 17-column assembler (M2) -- so the column order
is pipeline metadata and a saved model scores raw feature rows. Training is
Spark ML's distributed random forest; evaluation reuses the exact aggregate
metrics of ``evaluate``. Nothing but the 17 importances and a handful of
metrics ever reaches the driver.
"""

from __future__ import annotations

import datetime as _dt
import random
import uuid
from dataclasses import dataclass, field, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import evaluate as ev
from ..session import discard, materialise, shuffles_dropped
from .features import (DESIGN_COLUMNS, DUMMY_COLUMNS, EMPLOYMENT_DUMMIES, NUMERIC_FEATURES,
                       class_weights, with_class_weight)

# Training rows in a partition, and the most that one fit grows all trees on.
PARTITION_ROWS = 1 << 18
# Trees grown together on more rows. A fit keeps four bytes of bootstrap count for each
# row and tree, and with cached node ids up to three times as many again, in memory or on disk.
GROUP_TREES = 25


@dataclass(frozen=True)
class ForestParams:
    """Defaults of the reference model: 200 trees, depth 8, 10 rows per leaf."""

    num_trees: int = 200
    max_depth: int = 8
    min_instances_per_node: int = 10
    feature_subset_strategy: str = "sqrt"
    seed: int = 42
    # Spark-side tuning (not model semantics): more node statistics per pass
    # means fewer passes over the data per tree level.
    max_memory_mb: int = 1024
    cache_node_ids: bool = True

    def as_rows(self) -> dict:
        # The names under which a run's parameters are recorded.
        return {"n_estimators": self.num_trees, "max_depth": self.max_depth,
                "min_samples_leaf": self.min_instances_per_node,
                "class_weight": "balanced", "random_state": self.seed}


def one_hot_stage() -> SQLTransformer:
    cols = ", ".join(f"CAST(employment_status = '{v}' AS INT) AS `{n}`"
                     for v, n in zip(EMPLOYMENT_DUMMIES, DUMMY_COLUMNS))
    return SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__")


def assembler() -> VectorAssembler:
    """M2: the design matrix in the frozen column order; NULLs are an error."""
    return VectorAssembler(inputCols=DESIGN_COLUMNS, outputCol="features", handleInvalid="error")


def forest_pipeline(params: ForestParams = ForestParams(), label: str = "is_default",
                    weight_col: str | None = "class_weight") -> Pipeline:
    rf = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=params.num_trees,
        maxDepth=params.max_depth, minInstancesPerNode=params.min_instances_per_node,
        featureSubsetStrategy=params.feature_subset_strategy, seed=params.seed,
        maxMemoryInMB=params.max_memory_mb, cacheNodeIds=params.cache_node_ids,
        probabilityCol="probability", predictionCol="prediction_d")
    if weight_col:
        rf.setWeightCol(weight_col)
    return Pipeline(stages=[one_hot_stage(), assembler(), rf])


def spread(train: DataFrame, rows: int | None = None) -> DataFrame:
    """``train`` in partitions of about PARTITION_ROWS rows; a smaller table stays as it is.

    A row's values, its key among them, give its partition and its place there, so
    the bootstrap does not depend on how the rows arrived. ``rows`` is their number, if known.
    """
    rows = train.count() if rows is None else rows
    if rows <= PARTITION_ROWS:
        return train
    parts = max(-(-rows // PARTITION_ROWS), train.sparkSession.sparkContext.defaultParallelism)
    return train.repartition(parts, *train.columns).sortWithinPartitions(*train.columns)


def groups(params: ForestParams, rows: int) -> list[ForestParams]:
    """The fits that make up the forest of ``params`` on ``rows`` training rows.

    Up to PARTITION_ROWS rows it is one. Beyond, each fit grows GROUP_TREES trees with
    a seed of its own and keeps no node ids, so a row costs the same few bytes on disk
    however many trees there are; a row finds its node by its bins again.
    """
    if rows <= PARTITION_ROWS:
        return [params]
    seeds = random.Random(params.seed)
    return [replace(params, num_trees=min(GROUP_TREES, params.num_trees - first), cache_node_ids=False,
                    seed=seeds.getrandbits(62) if first else params.seed)
            for first in range(0, params.num_trees, GROUP_TREES)]


def joined(forests: list[RandomForestClassificationModel], params: ForestParams) -> RandomForestClassificationModel:
    """One forest with the trees of all, in order. Every tree votes alike in it, as in each of them."""
    first, gateway = forests[0], SparkSession.getActiveSession().sparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml.classification
    grown = [tree for forest in forests for tree in forest._java_obj.trees()]
    trees = gateway.new_array(ml.DecisionTreeClassificationModel, len(grown))
    for k, tree in enumerate(grown):
        trees[k] = tree
    whole = first._copyValues(RandomForestClassificationModel(
        ml.RandomForestClassificationModel(first.uid, trees, first.numFeatures, first.numClasses)))
    whole._set(numTrees=len(grown), seed=params.seed, cacheNodeIds=params.cache_node_ids)._transfer_params_to_java()
    return whole


def fit(train: DataFrame, params: ForestParams = ForestParams(), label: str = "is_default",
        weight_col: str | None = "class_weight") -> PipelineModel:
    """M5: fit on the (weighted) training split.

    The copy has no training summary. That one holds the session, which no task
    can be sent once something in it was observed (``DataFrame.observe``).
    """
    rows = train.count()
    data = spread(train, rows).select(*NUMERIC_FEATURES, "employment_status", label, *([weight_col] if weight_col else [])).cache()
    try:
        fitted = [forest_pipeline(group, label, weight_col).fit(data).copy() for group in groups(params, rows)]
    finally:
        data.unpersist()
    if len(fitted) == 1:
        return fitted[0]
    return PipelineModel([*fitted[0].stages[:-1], joined([m.stages[-1] for m in fitted], params)])


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M6: predicted class and P(default) per row."""
    out = model.transform(df)  # the assembler reads decimal columns as they are
    return out.withColumn("probability_of_default",
                          vector_to_array(F.col("probability"))[1]) \
              .withColumn("prediction", F.col("prediction_d").cast("int"))


def feature_importance(model: PipelineModel, top: int | None = 10) -> DataFrame:
    """Importances with their names, largest first, rounded to 4."""
    spark = SparkSession.getActiveSession()
    imp = model.stages[-1].featureImportances.toArray().tolist()  # 17 values
    df = spark.createDataFrame(
        [(n, float(v)) for n, v in zip(DESIGN_COLUMNS, imp)], "feature string, importance double")
    df = df.select("feature", F.round("importance", 4).alias("importance"),
                   F.col("importance").alias("_raw")).orderBy(F.desc("_raw"), "feature")
    if top:
        df = df.limit(top)
    return df.drop("_raw")


def evaluate(scored: DataFrame, label: str = "is_default") -> DataFrame:
    """Accuracy, precision, recall, F1 and AUC in one row (two one-row aggregates merged)."""
    m = ev.binary_metrics(scored, label, "prediction")
    a = ev.roc_auc(scored, label, "probability_of_default")
    cols = m.columns + ["auc"]
    return m.unionByName(a, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in cols])


@dataclass
class TrainingRun:
    model: PipelineModel
    scored_test: DataFrame
    metrics: DataFrame
    params: ForestParams
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)


def run_metrics(run: TrainingRun) -> DataFrame:
    """One row per parameter and per metric of a training run."""
    spark = SparkSession.getActiveSession()
    ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    params = spark.createDataFrame(
        [(k, str(v)) for k, v in run.params.as_rows().items()], "name string, value string")
    metric_cols = run.metrics.columns
    metrics = run.metrics.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
        for c in metric_cols])).alias("m")).select("m.*")
    return (params.withColumn("kind", F.lit("param"))
            .unionByName(metrics.withColumn("kind", F.lit("metric")))
            .select(F.lit(run.run_id).alias("run_id"), F.lit(ts).alias("logged_at"),
                    "kind", "name", "value"))


def train_and_evaluate(split_df: DataFrame, params: ForestParams = ForestParams(),
                       label: str = "is_default") -> TrainingRun:
    """M3-M7: balanced weights from the training split, fit, score the test split.

    The split is written once with the columns the model needs, and so are the
    scores of its test rows, which all metrics read. Nothing else stays on disk.
    """
    with shuffles_dropped(split_df.sparkSession):
        split_df = materialise(split_df.select("loan_id", *NUMERIC_FEATURES, "employment_status", label, "split"), "split")
    weights = class_weights(split_df, label)
    train = with_class_weight(split_df.where(F.col("split") == "train"), weights, label)
    model = fit(train, params, label)
    scored = score(model, split_df.where(F.col("split") == "test"))
    scored = materialise(scored.select(*split_df.columns, "prediction", "probability_of_default"), "scored")
    discard(split_df)
    return TrainingRun(model, scored, evaluate(scored, label), params)


def append_run_metrics(run: TrainingRun, table_path: str) -> DataFrame:
    """M12 sink: append this run's rows to the run-metrics table (parquet)."""
    run_metrics(run).write.mode("append").parquet(table_path)
    return SparkSession.getActiveSession().read.parquet(table_path)


def save(model: PipelineModel, path: str) -> None:
    """The fitted pipeline (its assembler fixes the column order), plus the
    17 design columns in order as a one-column text table next to it."""
    model.write().overwrite().save(f"{path.rstrip('/')}/pipeline")
    spark = SparkSession.getActiveSession()
    (spark.createDataFrame([(c,) for c in DESIGN_COLUMNS], "value string").coalesce(1)
     .write.mode("overwrite").text(f"{path.rstrip('/')}/feature_columns"))


def load(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path.rstrip('/')}/pipeline")


def saved_feature_columns(path: str) -> list[str]:
    """The design-column order written by ``save`` (17 names)."""
    spark = SparkSession.getActiveSession()
    return [r.value for r in spark.read.text(f"{path.rstrip('/')}/feature_columns").collect()]
