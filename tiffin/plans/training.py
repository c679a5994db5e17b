"""Training, tuning and scoring of the delivery-time model."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tiffin.operators.clean import drop_null_label
from tiffin.plans.boosting import fit_trees
from tiffin.schemas import CATEGORY_FEATURES, LABEL, TRAINING_NUMERIC_FEATURES
from tiffin.session import ensure_checkpoint_dir

# Fixed values of the model.
MAX_DEPTH = 5
MAX_ITER = 40
TRAIN_PERCENT = 80
SEED = 42
GRID_DEPTHS = [5]
GRID_ITERATIONS = [20, 40]
BUCKET = "_split_bucket"


def split_bucket(*keys: str) -> Column:
    """A number from 0 to 99 that depends only on the key values of a row.

    It is the same whatever the partitioning, the run or the engine, so a row never moves
    from one side of a split to the other.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(100))


def train_test_split(df: DataFrame, keys: list[str], percent: int = TRAIN_PERCENT):
    """Two filters over one frame: the training rows and the held-out rows."""
    return _sides(df, split_bucket(*keys), percent)


def _sides(df: DataFrame, bucket: Column, percent: int = TRAIN_PERCENT):
    return df.where(bucket < percent), df.where(bucket >= percent)


def feature_stages(numeric: list[str], categories: list[str]) -> list:
    """Indexer, encoder and assembler; one stage serves all categories, so one pass fits it."""
    index = [f"{c}_idx" for c in categories]
    vector = [f"{c}_vec" for c in categories]
    return [
        StringIndexer(inputCols=categories, outputCols=index, handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=vector),
        VectorAssembler(inputCols=[*numeric, *vector], outputCol="features"),
    ]


def regressor(label: str = LABEL, max_depth: int = MAX_DEPTH, max_iter: int = MAX_ITER):
    """Boosted trees; the checkpoint interval keeps the lineage of the rounds short."""
    return GBTRegressor(
        featuresCol="features",
        labelCol=label,
        maxDepth=max_depth,
        maxIter=max_iter,
        seed=SEED,
        checkpointInterval=10,
    )


class TreePipeline(Pipeline):
    """Feature stages and boosted trees; the trees are fitted by `boosting.fit_trees`.

    The trees read the columns behind their vector, which are stored while that lasts: no vector
    is made, and a row is indexed once.
    """

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        *features, trees = self.getStages()
        prepared = Pipeline(stages=features).fit(dataset)
        model = fit_trees(trees, prepared.stages, prepared.transform(dataset))
        return PipelineModel(stages=[*prepared.stages, model])


def build_pipeline(
    numeric: list[str] | None = None,
    categories: list[str] | None = None,
    label: str = LABEL,
    max_depth: int = MAX_DEPTH,
    max_iter: int = MAX_ITER,
) -> Pipeline:
    stages = feature_stages(numeric or TRAINING_NUMERIC_FEATURES, categories or CATEGORY_FEATURES)
    return TreePipeline(stages=[*stages, regressor(label, max_depth, max_iter)])


@dataclass
class TrainingResult:
    model: PipelineModel
    n_train: int
    n_test: int
    rmse: float
    baseline_rmse: float


def check_labels(df: DataFrame, categories: list[str], max_labels: int | None = None) -> int:
    """Row count of the training rows; fails above a limit of labels per category, if any."""
    # Without a limit nobody reads the estimates, and sketching costs more than the count.
    sketched = [] if max_labels is None else categories
    labels = {c: F.hll_sketch_estimate(F.hll_sketch_agg(c)) for c in sketched}
    row = df.agg(
        F.count(F.lit(1)).alias("n"), *[estimate.alias(c) for c, estimate in labels.items()]
    ).first()
    wide = {c: row[c] for c in sketched if row[c] > max_labels}
    if wide:
        raise ValueError(f"too many labels to encode as categories: {wide}")
    if row["n"] == 0:
        raise ValueError("no training rows with a label")
    return row["n"]


def _spread_if_few_partitions(stored: DataFrame) -> DataFrame:
    """Training input with at least one partition per core.

    Every round of boosting walks all partitions, so a small input that came in a few pieces
    is spread out once. `stored` is persisted and filled, which makes the look at its
    partitions free and leaves a large input as it is.
    """
    cores = stored.sparkSession.sparkContext.defaultParallelism
    if stored.rdd.getNumPartitions() >= cores:
        return stored
    return stored.repartition(cores).persist(StorageLevel.MEMORY_AND_DISK)


def evaluate(predictions: DataFrame, label: str = LABEL) -> float:
    return RegressionEvaluator(
        labelCol=label, predictionCol="prediction", metricName="rmse"
    ).evaluate(predictions)


@contextmanager
def stored_rows(
    rows: DataFrame,
    keys: list[str],
    numeric: list[str] | None = None,
    categories: list[str] | None = None,
    label: str = LABEL,
) -> Iterator[DataFrame]:
    """Feature rows with their side of the split, stored for one or more trainings.

    Filter and split work on the stored features: cleaning and joining happen once for both
    sides, and the test of the label is not pushed down into the join as a second copy of
    everything the label is made from. The hash of the keys is stored in their place, since each
    of the many passes over the rows would compute it again.
    """
    numeric, categories = numeric or TRAINING_NUMERIC_FEATURES, categories or CATEGORY_FEATURES
    wanted = dict.fromkeys([*numeric, *categories, label])
    stored = rows.select(*wanted, split_bucket(*keys).alias(BUCKET)).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        stored.count()
        spread = _spread_if_few_partitions(stored)
        try:
            yield spread
        finally:
            spread.unpersist()
    finally:
        stored.unpersist()


def train(
    rows: DataFrame,
    keys: list[str],
    numeric: list[str] | None = None,
    categories: list[str] | None = None,
    label: str = LABEL,
    max_depth: int = MAX_DEPTH,
    max_iter: int = MAX_ITER,
    max_labels: int | None = None,
) -> TrainingResult:
    """Fit on four fifths of the rows, measure on the rest.

    `rows` are feature rows as the shared feature plan builds them; `keys` decide the split.
    """
    with stored_rows(rows, keys, numeric, categories, label) as stored:
        return train_stored(stored, numeric, categories, label, max_depth, max_iter, max_labels)


def train_stored(
    stored: DataFrame,
    numeric: list[str] | None = None,
    categories: list[str] | None = None,
    label: str = LABEL,
    max_depth: int = MAX_DEPTH,
    max_iter: int = MAX_ITER,
    max_labels: int | None = None,
) -> TrainingResult:
    """The same on rows of `stored_rows`, which several trainings can share."""
    numeric, categories = numeric or TRAINING_NUMERIC_FEATURES, categories or CATEGORY_FEATURES
    ensure_checkpoint_dir(stored.sparkSession)
    learn, held_out = _sides(drop_null_label(stored, label), F.col(BUCKET))
    n_train = check_labels(learn, categories, max_labels)
    model = build_pipeline(numeric, categories, label, max_depth, max_iter).fit(learn)
    mean = learn.agg(F.avg(label)).first()[0]
    error = F.col(label) - F.col("prediction")
    offset = F.col(label) - F.lit(mean)
    row = (
        model.transform(held_out)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.sqrt(F.avg(offset * offset)).alias("base"),
        )
        .first()
    )
    return TrainingResult(model, n_train, row["n"], row["rmse"], row["base"])


def tune(
    rows: DataFrame,
    label: str = LABEL,
    numeric: list[str] | None = None,
    categories: list[str] | None = None,
    depths: list[int] | None = None,
    iterations: list[int] | None = None,
    parallelism: int = 2,
):
    """Grid search over tree depth and number of trees on one train/validation split."""
    ensure_checkpoint_dir(rows.sparkSession)
    stages = feature_stages(numeric or TRAINING_NUMERIC_FEATURES, categories or CATEGORY_FEATURES)
    trees = regressor(label)
    grid = (
        ParamGridBuilder()
        .addGrid(trees.maxDepth, depths or GRID_DEPTHS)
        .addGrid(trees.maxIter, iterations or GRID_ITERATIONS)
        .build()
    )
    search = TrainValidationSplit(
        estimator=TreePipeline(stages=[*stages, trees]),
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(
            labelCol=label, predictionCol="prediction", metricName="rmse"
        ),
        trainRatio=TRAIN_PERCENT / 100,
        seed=SEED,
        parallelism=parallelism,
    )
    # Both sides of the split and every pass of the last fit, on all rows, read the input again.
    # On disk it takes nothing from the trees, which pass over theirs far more often.
    stored = rows.persist(StorageLevel.DISK_ONLY)
    try:
        return search.fit(stored)
    finally:
        stored.unpersist()


def score(model: PipelineModel, features: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Predictions beside the named columns; the vector columns stay behind."""
    scored = model.transform(features)
    return scored.select(*(keep or features.columns), "prediction")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_stages(model: PipelineModel, base: str) -> list[str]:
    """Every fitted stage in a folder of its own, named by kind and position."""
    paths = []
    for position, stage in enumerate(model.stages):
        path = f"{base}/{position}-{type(stage).__name__}"
        stage.write().overwrite().save(path)
        paths.append(path)
    return paths


def model_path(spark: SparkSession, fallback: str, default: str, variable: str = "MODEL_DIR") -> str:
    """Where the model lies: the environment's path or `default`, else `fallback`."""
    candidates = [os.environ.get(variable, default), fallback]
    for path in candidates:
        try:
            # Every saved model has a metadata folder; reading lazily only checks the path.
            spark.read.text(f"{path}/metadata")
            return path
        except AnalysisException:
            continue
    raise FileNotFoundError(f"no model at {' or '.join(candidates)}: train one first")
