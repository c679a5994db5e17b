from __future__ import annotations

import os

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoderModel,
    SQLTransformer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import functions as F

from tiffin.catalog.models import KEYS, training_rows
from tiffin.jobs import eda_report
from tiffin.jobs import train as train_job
from tiffin.plans import training
from tiffin.schemas import CATEGORY_FEATURES, LABEL, NUMERIC_FEATURES, TRAINING_NUMERIC_FEATURES


@pytest.fixture(scope="module")
def result(spark, sf_dir):
    return training.train(training_rows(spark, sf_dir), KEYS, max_iter=3)


def test_split_does_not_depend_on_partitions(spark, sf_dir):
    rows = training_rows(spark, sf_dir).select(*KEYS)
    once, _ = training.train_test_split(rows, KEYS)
    again, rest = training.train_test_split(rows.repartition(13, "l_partkey"), KEYS)
    assert once.exceptAll(again).count() == 0 and again.exceptAll(once).count() == 0
    share = again.count() / (again.count() + rest.count())
    assert 0.76 < share < 0.84


def test_model_beats_the_mean(result):
    assert result.rmse < result.baseline_rmse
    assert result.model.stages[-1].getNumTrees == 3


def test_stages_are_saved_fitted(spark, result, folder):
    paths = training.save_stages(result.model, folder)
    assert [p.rsplit("-", 1)[1] for p in paths] == [
        "StringIndexerModel", "OneHotEncoderModel", "VectorAssembler", "GBTRegressionModel",
    ]
    indexer = StringIndexerModel.load(paths[0])
    assert indexer.labelsArray == result.model.stages[0].labelsArray
    assert OneHotEncoderModel.load(paths[1]).categorySizes == result.model.stages[1].categorySizes
    assert VectorAssembler.load(paths[2]).getInputCols()[:9] == TRAINING_NUMERIC_FEATURES
    training.save_stages(result.model, folder)


def test_model_path_falls_back(spark, result, folder, monkeypatch):
    saved = f"{folder}/best"
    training.save_model(result.model, saved)
    monkeypatch.delenv("MODEL_DIR", raising=False)
    assert training.model_path(spark, saved, f"{folder}/none") == saved
    assert training.model_path(spark, f"{folder}/none", saved) == saved
    monkeypatch.setenv("MODEL_DIR", f"{folder}/elsewhere")
    assert training.model_path(spark, saved, f"{folder}/none") == saved
    with pytest.raises(FileNotFoundError, match="elsewhere"):
        training.model_path(spark, f"{folder}/none", saved)
    assert isinstance(training.load_model(saved), PipelineModel)


def test_unknown_and_missing_categories_can_be_scored(spark, result):
    row = {c: 1.0 for c in TRAINING_NUMERIC_FEATURES}
    values = [*row.values(), "Someday", None, "barter", None]
    schema = ", ".join([f"{c} double" for c in row] + [f"{c} string" for c in CATEGORY_FEATURES])
    df = spark.createDataFrame([tuple(values)], schema)
    assert training.score(result.model, df).first()["prediction"] is not None


def test_too_many_labels_stop_training(spark, sf_dir):
    with pytest.raises(ValueError, match="too many labels"):
        training.train(training_rows(spark, sf_dir), KEYS, max_iter=1, max_labels=3)


def test_evaluator_equals_the_plain_aggregate(spark):
    from tiffin.operators.profile import rmse

    df = spark.createDataFrame([(1.0, 2.0), (5.0, 2.5), (4.0, 4.0)], f"{LABEL} double, prediction double")
    assert training.evaluate(df) == pytest.approx(rmse(df, LABEL, "prediction").first()[0])


def test_no_labels_stop_training(spark, sf_dir):
    rows = training_rows(spark, sf_dir).withColumn(LABEL, F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="no training rows"):
        training.train(rows, KEYS, max_iter=1)


def test_one_indexer_serves_all_categories(result):
    kinds = [type(s).__name__ for s in result.model.stages]
    assert kinds.count("StringIndexerModel") == 1 and kinds.count("OneHotEncoderModel") == 1


def test_unknown_labels_become_empty_vectors(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    indexer, encoder, _ = training.feature_stages([], ["c"])
    model = Pipeline(stages=[indexer, encoder]).fit(df)
    out = model.transform(spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string"))
    rows = [(r["c_idx"], r["c_vec"].toArray().tolist()) for r in out.collect()]
    assert rows == [(0.0, [1, 0]), (1.0, [0, 1]), (2.0, [0, 0]), (2.0, [0, 0])]


def test_train_job_reads_any_spelling(spark, sf_dir, folder):
    from tiffin.catalog.columns import spaced_orders

    raw = spaced_orders(spark, sf_dir)
    done = train_job.run(raw, f"{folder}/model", keys=["order_id", "line_no"], max_depth=2, max_iter=1,
                         refund_amount=True)
    assert "refunds_chargebacks_dbl" in done.model.stages[2].getInputCols()
    assert done.n_train + done.n_test == raw.count()
    assert os.path.isdir(f"{folder}/model/metadata")


def test_report_job_writes_every_table(spark, sf_dir, folder):
    from tiffin.catalog import QUERIES
    from tiffin.catalog.columns import spaced_orders

    raw = spaced_orders(spark, sf_dir).withColumnRenamed("restaurant_id", "Restaurant ID")
    names = eda_report.run(eda_report.prepared_orders(raw), folder)
    assert len(names) == 9
    for name in names:
        assert spark.read.parquet(f"{folder}/{name}").count() > 0
    summary = tuple(spark.read.parquet(f"{folder}/profit_summary").first())
    assert summary == tuple(QUERIES["profit_summary"](spark, sf_dir).first())
    boxes = spark.read.parquet(f"{folder}/box_report")
    assert boxes.exceptAll(QUERIES["box_report"](spark, sf_dir)).count() == 0


def test_report_job_needs_a_restaurant(spark):
    with pytest.raises(ValueError, match="restaurant"):
        eda_report.prepared_orders(spark.createDataFrame([(1,)], "a int"))


def test_tuning_returns_a_metric_per_point(spark, sf_dir):
    rows = training_rows(spark, sf_dir).select(*TRAINING_NUMERIC_FEATURES, *CATEGORY_FEATURES, LABEL)
    found = training.tune(rows, depths=[2], iterations=[1, 2])
    assert len(found.validationMetrics) == 2
    assert found.validationMetrics[1] < found.validationMetrics[0]


def test_queries_run_the_grid_and_the_trees_of_the_reference(spark, sf_dir):
    from tiffin.catalog import QUERIES, models

    points = QUERIES["tune_grid"](spark, sf_dir).collect()
    assert [(r["max_depth"], r["max_iter"]) for r in points] == [(5, 20), (5, 40)]
    assert [r["n_trees"] for r in QUERIES["gbt_train"](spark, sf_dir).collect()] == [20, 40]
    assert models.trained(spark, sf_dir).model.stages[-1].getNumTrees == training.MAX_ITER


def _few_rows(spark, n=80):
    """Small feature rows of our own, under ids that decide the split."""
    df = spark.range(n, numPartitions=2).select(
        F.col("id").alias("order_id"), F.col("id").alias("line_no"), F.col("id").alias("l_partkey"),
        *[(F.pmod("id", F.lit(k + 2)) * 1.5).alias(c) for k, c in enumerate(NUMERIC_FEATURES)],
        *[F.pmod("id", F.lit(k + 2)).cast("string").alias(c) for k, c in enumerate(CATEGORY_FEATURES)],
        (F.pmod("id", F.lit(7)) * 10.0).alias(LABEL),
    )
    return df


def _counted(spark, values, kind):
    """`values` through a function that counts its calls."""
    calls = spark.sparkContext.accumulator(0)

    def count(value):
        calls.add(1)
        return value

    return F.udf(count, kind)(values), calls


def test_training_hashes_the_keys_of_a_row_once(spark, monkeypatch):
    rows = _few_rows(spark)
    plain = training.train(rows, KEYS, max_depth=2, max_iter=2)
    hashed, calls = _counted(spark, training.split_bucket(*KEYS), "bigint")
    monkeypatch.setattr(training, "split_bucket", lambda *keys: hashed)
    counted = training.train(rows, KEYS, max_depth=2, max_iter=2)
    assert calls.value == 80
    assert (counted.n_train, counted.n_test) == (plain.n_train, plain.n_test)
    assert counted.rmse == pytest.approx(plain.rmse)
    learn, held_out = training.train_test_split(rows, KEYS)
    assert (counted.n_train, counted.n_test) == (learn.count(), held_out.count())


def test_the_trees_read_vectors_that_are_built_once(spark, monkeypatch):
    rows = _few_rows(spark)
    plain = training.train(rows, KEYS, max_depth=2, max_iter=2)
    calls = spark.sparkContext.accumulator(0)

    def seen(value):
        calls.add(1)
        return value

    spark.udf.register("seen_by_stages", seen, "double")
    count = SQLTransformer(statement="SELECT *, seen_by_stages(order_value_dbl) AS seen FROM __THIS__")
    stages = training.feature_stages
    monkeypatch.setattr(
        training, "feature_stages",
        lambda numeric, categories: [count, *stages(["seen", *numeric[1:]], categories)],
    )
    counted = training.train(rows, KEYS, max_depth=2, max_iter=2)
    assert calls.value == 80
    assert counted.rmse == pytest.approx(plain.rmse)
    kinds = [type(s) for s in plain.model.stages[:3]]
    assert kinds == [StringIndexerModel, OneHotEncoderModel, VectorAssembler]
    whole = training.build_pipeline(max_depth=2, max_iter=2).fit(
        training.train_test_split(rows, KEYS)[0]
    )
    both = whole.transform(rows).select(*KEYS, "prediction")
    assert both.exceptAll(plain.model.transform(rows).select(*KEYS, "prediction")).count() == 0


def test_both_trainings_of_a_query_share_their_rows(spark, monkeypatch):
    from tiffin.catalog import models

    label, calls = _counted(spark, F.col(LABEL), "double")
    small = training.regressor
    monkeypatch.setattr(training, "regressor", lambda name, depth, trees: small(name, 1, 1 + trees // 40))
    monkeypatch.setattr(models, "_models", {})
    monkeypatch.setattr(models, "training_rows", lambda *_, **__: _few_rows(spark).withColumn(LABEL, label))
    first, second = models.gbt_train(spark, "few rows").collect()
    assert calls.value == 80
    assert (first["n_trees"], second["n_trees"]) == (1, 2)
    assert first["n_train"] + first["n_test"] == 80 == second["n_train"] + second["n_test"]


def test_tuning_builds_a_row_once(spark):
    rows = _few_rows(spark).select(*TRAINING_NUMERIC_FEATURES, *CATEGORY_FEATURES, LABEL)
    label, calls = _counted(spark, F.col(LABEL), "double")
    found = training.tune(rows.withColumn(LABEL, label), depths=[1], iterations=[1, 2])
    assert calls.value == 80
    assert len(found.validationMetrics) == 2 and found.bestModel.stages[-1].getNumTrees in (1, 2)


def test_stored_rows_keep_missing_keys_and_repeats(spark):
    rows = _few_rows(spark).withColumn("line_no", F.when(F.col("line_no") % 3 != 0, F.col("line_no")))
    rows = rows.unionByName(rows)
    learn, held_out = training.train_test_split(rows, KEYS)
    result = training.train(rows, KEYS, max_depth=1, max_iter=1)
    assert (result.n_train, result.n_test) == (learn.count(), held_out.count())


def _many_rows(spark, n):
    """Feature rows with numbers of many values, gaps among the labels and an effect of each kind."""
    spread = [F.pmod(F.xxhash64("id", F.lit(k)), F.lit(9973)) / 7.0 - 300 for k in range(3)]
    few = [F.pmod(F.col("id") * 31, F.lit(k + 2)) * 1.0 for k in range(6)]
    labels = [F.pmod(F.xxhash64("id", F.lit(k)), F.lit(k * k)) for k in (2, 3, 4, 5)]
    df = spark.range(n, numPartitions=3).select(
        *[c.alias(name) for name, c in zip(TRAINING_NUMERIC_FEATURES, spread + few, strict=True)],
        *[
            F.when(c > 0, F.concat(F.lit("v"), c)).alias(name)
            for name, c in zip(CATEGORY_FEATURES, labels, strict=True)
        ],
    )
    first, second = TRAINING_NUMERIC_FEATURES[:2]
    effect = F.when(F.col(CATEGORY_FEATURES[3]) == "v7", 40).otherwise(0) + F.abs(second) / 9
    return df.withColumn(LABEL, effect + F.pmod(F.col(first), F.lit(50.0)))


@pytest.mark.parametrize("n", [300, 24000])
def test_trees_are_those_of_the_trainer_of_spark(spark, n):
    rows = _many_rows(spark, n).persist()
    ours = training.build_pipeline(max_depth=4, max_iter=4)
    spark_s = Pipeline(stages=ours.getStages()).fit(rows)
    fitted = ours.fit(rows)
    for mine, theirs in zip(fitted.stages[-1].trees, spark_s.stages[-1].trees, strict=True):
        assert (mine.depth, mine.numNodes) == (theirs.depth, theirs.numNodes)
    assert fitted.stages[-1].treeWeights == spark_s.stages[-1].treeWeights
    assert fitted.stages[-1].explainParams() == spark_s.stages[-1].explainParams()
    scored = spark_s.transform(fitted.transform(rows).withColumnRenamed("prediction", "mine").drop(
        "features", *[f"{c}_{kind}" for c in CATEGORY_FEATURES for kind in ("idx", "vec")]
    ))
    assert scored.agg(F.max(F.abs(F.col("mine") - F.col("prediction")))).first()[0] < 1e-9
    rows.unpersist()


def test_training_passes_over_codes_and_not_over_vectors(spark, monkeypatch):
    """The passes of Spark's trainer over vectors took hours of core time on large tables."""
    from pyspark.ml.regression import GBTRegressor

    from tiffin.plans import boosting

    def forbidden(*_):
        raise AssertionError("fitted on vectors")

    layouts, boost = [], boosting._boost
    monkeypatch.setattr(boosting, "_boost", lambda frame, layout, *more: layouts.append(
        (layout, frame.selectExpr("sum(length(codes) + length(errors))").first()[0])
    ) or boost(frame, layout, *more))
    monkeypatch.setattr(GBTRegressor, "_fit", forbidden)
    result = training.train(_few_rows(spark), KEYS, max_depth=2, max_iter=2)
    ((layout, stored),) = layouts
    assert stored <= 20 * result.n_train
    slots = result.model.stages[-1].numFeatures
    assert len(layout.groups) < len(layout.features) < slots
    training.tune(
        _few_rows(spark).select(*TRAINING_NUMERIC_FEATURES, *CATEGORY_FEATURES, LABEL),
        depths=[1], iterations=[1],
    )


def test_plans_of_later_trees_do_not_grow(spark, monkeypatch):
    from tiffin.plans import boosting

    plans, grow = [], boosting._grow
    monkeypatch.setattr(boosting, "_grow", lambda frame, *more: plans.append(
        frame._jdf.queryExecution().optimizedPlan().toString()
    ) or grow(frame, *more))
    training.train(_few_rows(spark), KEYS, max_depth=1, max_iter=4)
    assert len({plan.count("\n") for plan in plans}) == 1 and plans[0].count("\n") < 6


def test_missing_numbers_and_labels_stop_the_trees(spark):
    rows = _few_rows(spark).select(*TRAINING_NUMERIC_FEATURES, *CATEGORY_FEATURES, LABEL)
    for gap in (TRAINING_NUMERIC_FEATURES[1], LABEL):
        holed = rows.withColumn(gap, F.when(F.col(gap) > 0, F.col(gap)))
        with pytest.raises(Exception, match="missing"):
            training.build_pipeline(max_depth=1, max_iter=1).fit(holed)
