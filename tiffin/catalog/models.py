"""Feature vectors, training and scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoderModel,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.catalog.columns import LINE, LINE_SQL
from tiffin.catalog.registry import query
from tiffin.catalog.views import sql
from tiffin.plans import training
from tiffin.plans.features import build_training_rows, canonical_fixture
from tiffin.schemas import CATEGORY_FEATURES, LABEL, NUMERIC_FEATURES, TRAINING_NUMERIC_FEATURES
from tiffin.session import work_path
from tiffin.sources import fixtures

KEYS = ["order_id", "line_no", "l_partkey"]
NOTEBOOK_ITER = 20


def training_rows(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Feature rows whose label depends on the features.

    The minutes of the derived table are a hash of its keys, which no model can learn, so
    the fee and the rush hour are added to them.
    """
    rows = build_training_rows(canonical_fixture(fixtures.delivery_orders(spark, sf_dir, heavy)))
    planted = F.col(LABEL) + F.col("delivery_fee_dbl") * 2 + F.col("es_hora_punta") * 40
    return rows.withColumn(LABEL, planted)


_models: dict[tuple[str, str], training.TrainingResult] = {}


def trained(
    spark: SparkSession, sf_dir: str, stored: DataFrame | None = None
) -> training.TrainingResult:
    """The model of this session and data folder, trained at its first use.

    `stored` are the rows of `training.stored_rows`, if the caller has them already.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        if stored is not None:
            _models[key] = training.train_stored(stored)
        else:
            _models[key] = training.train(training_rows(spark, sf_dir, heavy=True), KEYS)
    return _models[key]


# -- feature vectors --------------------------------------------------------

_INDEX_SQL = """
, labels AS (
  SELECT 'payment_method' AS c, coalesce(payment_method, 'unknown') AS label, count(*) AS n FROM delivery_orders GROUP BY 2
  UNION ALL
  SELECT 'discounts_and_offers', coalesce(discounts_and_offers, 'none'), count(*) FROM delivery_orders GROUP BY 2
  UNION ALL
  SELECT 'day_of_week', dayname(order_ts), count(*) FROM delivery_orders GROUP BY 2
  UNION ALL
  SELECT 'hour_of_day_str', CAST(hour(order_ts) AS VARCHAR), count(*) FROM delivery_orders GROUP BY 2
),
indexed AS (
  SELECT c, label, CAST(row_number() OVER (PARTITION BY c ORDER BY n DESC, label) - 1 AS DOUBLE) AS i FROM labels
)"""


def _lookup(column: str, label: str) -> str:
    return f"(SELECT i FROM indexed WHERE c = '{column}' AND label = {label})"


_LABEL_SQL = {
    "day_of_week": "dayname(order_ts)",
    "hour_of_day_str": "CAST(hour(order_ts) AS VARCHAR)",
    "payment_method": "coalesce(payment_method, 'unknown')",
    "discounts_and_offers": "coalesce(discounts_and_offers, 'none')",
}
_JOINS = " ".join(
    f"JOIN indexed {c}_i ON {c}_i.c = '{c}' AND {c}_i.label = {label}" for c, label in _LABEL_SQL.items()
)


@query(
    "string_index",
    sql("finance", _INDEX_SQL + f"""
, scoped AS (SELECT * REPLACE (nullif(payment_method, '1-URGENT') AS payment_method) FROM delivery_orders),
methods AS (
  SELECT payment_method, CAST(row_number() OVER (ORDER BY count(*) DESC, payment_method) - 1 AS DOUBLE) AS i
  FROM scoped WHERE payment_method IS NOT NULL GROUP BY 1)
SELECT {LINE_SQL}, day_of_week_i.i AS day_of_week_idx,
  coalesce(methods.i, (SELECT count(*) FROM methods)) AS payment_method_idx
FROM scoped LEFT JOIN methods USING (payment_method)
JOIN indexed day_of_week_i ON day_of_week_i.c = 'day_of_week' AND day_of_week_i.label = dayname(order_ts)"""),
)
def string_index(spark, sf_dir):
    """Most frequent label first; a missing label gets the index after the last one."""
    rows = training_rows(spark, sf_dir).withColumn(
        "payment_method", F.nullif(F.col("payment_method"), F.lit("1-URGENT"))
    )
    indexer = StringIndexer(
        inputCols=["day_of_week", "payment_method"],
        outputCols=["day_of_week_idx", "payment_method_idx"],
        handleInvalid="keep",
    )
    needed = rows.select(*LINE, "day_of_week", "payment_method")
    return indexer.fit(needed).transform(needed).drop("day_of_week", "payment_method")


@query(
    "one_hot",
    sql("finance", _INDEX_SQL + f"""
SELECT {LINE_SQL}, CAST(day_of_week_i.i + 1 AS BIGINT) AS day_slot, CAST(7 AS INTEGER) AS day_width,
  CAST(1 AS DOUBLE) AS day_sum
FROM delivery_orders
JOIN indexed day_of_week_i ON day_of_week_i.c = 'day_of_week' AND day_of_week_i.label = dayname(order_ts)"""),
)
def one_hot(spark, sf_dir):
    needed = training_rows(spark, sf_dir).select(*LINE, "day_of_week")
    indexer, encoder, _ = training.feature_stages([], ["day_of_week"])
    encoded = Pipeline(stages=[indexer, encoder]).fit(needed).transform(needed)
    slots = vector_to_array("day_of_week_vec")
    return encoded.select(
        *LINE,
        F.array_position(slots, F.lit(1.0)).alias("day_slot"),
        F.size(slots).alias("day_width"),
        F.aggregate(slots, F.lit(0.0), lambda total, slot: total + slot).alias("day_sum"),
    )


_ASSEMBLED_SQL = sql("finance", _INDEX_SQL + f"""
SELECT {LINE_SQL}, round(order_value, 4) AS x0, round(delivery_fee, 4) AS x1, round(commission_fee, 4) AS x2,
  round(payment_processing_fee, 4) AS x3, round(discount_value, 4) AS x4,
  CAST(CASE WHEN coalesce(lower(discounts_and_offers), 'none') = 'none' THEN 0 ELSE 1 END AS DOUBLE) AS x5,
  CAST(CASE WHEN refunds > 0 THEN 1 ELSE 0 END AS DOUBLE) AS x6,
  CAST(CASE WHEN isodow(order_ts) >= 6 THEN 1 ELSE 0 END AS DOUBLE) AS x7,
  CAST(CASE WHEN hour(order_ts) IN (13, 14, 15, 20, 21, 22) THEN 1 ELSE 0 END AS DOUBLE) AS x8,
  CAST(day_of_week_i.i + 10 AS BIGINT) AS first_slot,
  CAST(9 + (SELECT count(*) FROM indexed) AS INTEGER) AS width
FROM finance {_JOINS}""")


def _vector_rows(spark, sf_dir) -> DataFrame:
    return training_rows(spark, sf_dir).select(
        *LINE, *TRAINING_NUMERIC_FEATURES, *CATEGORY_FEATURES
    )


def _vector_slots(assembled: DataFrame) -> DataFrame:
    """The numbers of a vector and where its first category has its slot."""
    slots = vector_to_array("features")
    n = len(TRAINING_NUMERIC_FEATURES)
    return assembled.select(
        *LINE,
        *[F.round(F.get(slots, F.lit(i)), 4).alias(f"x{i}") for i in range(n)],
        (F.array_position(F.slice(slots, n + 1, 7), F.lit(1.0)) + n).alias("first_slot"),
        F.size(slots).alias("width"),
    )


@query("assemble_features", _ASSEMBLED_SQL)
def assemble_features(spark, sf_dir):
    """Numbers first, then one slot per label of each category in turn."""
    rows = _vector_rows(spark, sf_dir)
    stages = training.feature_stages(TRAINING_NUMERIC_FEATURES, CATEGORY_FEATURES)
    return _vector_slots(Pipeline(stages=stages).fit(rows).transform(rows))


@query("stage_save", _ASSEMBLED_SQL)
def stage_save(spark, sf_dir):
    """The fitted stages saved one by one, loaded again and put in a row: the same vectors."""
    rows = _vector_rows(spark, sf_dir)
    stages = training.feature_stages(TRAINING_NUMERIC_FEATURES, CATEGORY_FEATURES)
    paths = training.save_stages(Pipeline(stages=stages).fit(rows), work_path(spark, "stages"))
    kinds = (StringIndexerModel, OneHotEncoderModel, VectorAssembler)
    loaded = [kind.load(path) for kind, path in zip(kinds, paths)]
    return _vector_slots(PipelineModel(stages=loaded).transform(rows))


# -- training and scoring ---------------------------------------------------

_BUCKET = "CAST('0x' || substr(md5(concat_ws('|', order_id, line_no, l_partkey)), 1, 8) AS BIGINT) % 100"


@query(
    "train_test_split",
    sql("orders", f"SELECT {LINE_SQL}, {_BUCKET} < 80 AS in_training FROM delivery_orders"),
)
def train_test_split(spark, sf_dir):
    orders = fixtures.delivery_orders(spark, sf_dir).select(*LINE)
    learn, held_out = training.train_test_split(orders, KEYS)
    return learn.withColumn("in_training", F.lit(True)).unionByName(
        held_out.withColumn("in_training", F.lit(False))
    )


_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("n_train", T.LongType()),
        T.StructField("n_test", T.LongType()),
        T.StructField("n_trees", T.IntegerType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("baseline_rmse", T.DoubleType()),
        T.StructField("beats_baseline", T.BooleanType()),
    ]
)


def _result_rows(spark, *results: training.TrainingResult) -> DataFrame:
    rows = [
        (
            r.n_train, r.n_test, r.model.stages[-1].getNumTrees, r.rmse, r.baseline_rmse,
            r.rmse < r.baseline_rmse,
        )
        for r in results
    ]
    return spark.createDataFrame(rows, _RESULT_SCHEMA)


@query("gbt_train")
def gbt_train(spark, sf_dir):
    """Sizes and errors of the model beside the error of the constant mean, for 20 and 40 trees.

    The notebook trains 20 trees on ten numbers, the refunded amount among them, the Kubernetes job
    40 on nine; all other queries use the latter.
    """
    rows = training_rows(spark, sf_dir, heavy=True)
    # The ten numbers hold the nine, so one store of the rows serves both trainings.
    with training.stored_rows(rows, KEYS, NUMERIC_FEATURES) as stored:
        notebook = training.train_stored(stored, NUMERIC_FEATURES, max_iter=NOTEBOOK_ITER)
        return _result_rows(spark, notebook, trained(spark, sf_dir, stored))


@query(
    "gbt_train_sizes",
    sql("orders", f"""
SELECT count(*) FILTER (WHERE {_BUCKET} < 80) AS n_train, count(*) FILTER (WHERE {_BUCKET} >= 80) AS n_test,
  true AS beats_baseline FROM delivery_orders"""),
)
def gbt_train_sizes(spark, sf_dir):
    """The parts of a training run that SQL can check."""
    return _result_rows(spark, trained(spark, sf_dir)).select("n_train", "n_test", "beats_baseline")


@query("score_batch")
def score_batch(spark, sf_dir):
    model = trained(spark, sf_dir).model
    return training.score(model, training_rows(spark, sf_dir, heavy=True), [*LINE, LABEL])


@query(
    "actual_vs_predicted",
    sql("finance", f"""
SELECT {LINE_SQL}, delivery_minutes AS delivery_duration_min, CAST(40 AS DOUBLE) + l_partkey % 50 AS prediction
FROM finance"""),
)
def actual_vs_predicted(spark, sf_dir):
    minutes = (F.unix_timestamp("delivery_ts") - F.unix_timestamp("order_ts")) / F.lit(60.0)
    return fixtures.scores(spark, sf_dir).select(*LINE, minutes.alias(LABEL), "prediction")


@query(
    "model_save_load",
    sql("orders", f"SELECT {LINE_SQL}, true AS equal FROM delivery_orders"),
)
def model_save_load(spark, sf_dir):
    """Whether the model and its saved copy predict the same, for every row."""
    model = trained(spark, sf_dir).model
    path = work_path(spark, "model")
    training.save_model(model, path)
    rows = training_rows(spark, sf_dir, heavy=True)
    vectors = ["features", *[f"{c}_{kind}" for c in CATEGORY_FEATURES for kind in ("idx", "vec")]]
    before = model.transform(rows).withColumnRenamed("prediction", "before").drop(*vectors)
    both = training.load_model(path).transform(before)
    return both.select(*LINE, (F.col("before") == F.col("prediction")).alias("equal"))


@query(
    "model_path_fallback",
    sql("orders", f"SELECT {LINE_SQL}, true AS scored FROM delivery_orders"),
)
def model_path_fallback(spark, sf_dir):
    """Scores with the model of the fallback folder, as the first folder has none."""
    fallback = work_path(spark, "best-model")
    training.save_model(trained(spark, sf_dir).model, fallback)
    found = training.model_path(
        spark, fallback, work_path(spark, "no-model"), variable="TIFFIN_NO_SUCH_VARIABLE"
    )
    scored = training.score(
        training.load_model(found), training_rows(spark, sf_dir, heavy=True), LINE
    )
    return scored.select(*LINE, F.col("prediction").isNotNull().alias("scored"))


@query("tune_grid")
def tune_grid(spark, sf_dir):
    """Validation error per point of the whole grid."""
    rows = training_rows(spark, sf_dir).select(
        *TRAINING_NUMERIC_FEATURES, *CATEGORY_FEATURES, LABEL
    )
    found = training.tune(rows)
    regressor = found.getEstimator().getStages()[-1]
    points = [
        (grid[regressor.maxDepth], grid[regressor.maxIter], float(m))
        for grid, m in zip(found.getEstimatorParamMaps(), found.validationMetrics, strict=True)
    ]
    return spark.createDataFrame(points, "max_depth int, max_iter int, rmse double")
