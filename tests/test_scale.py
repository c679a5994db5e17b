"""What the plans must look like to hold at a large scale."""

from __future__ import annotations

import contextlib
import re
from collections import Counter
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from tiffin import session as session_module
from tiffin.catalog import QUERIES, aggregates, columns, messages, scalars
from tiffin.operators import boxes, matching, profile
from tiffin.plans.report import box_groupings
from tiffin.sources import fixtures
from tiffin.sources.tables import use_all_cores

PACKAGE = Path(session_module.__file__).parent


@contextlib.contextmanager
def settings(spark, **conf):
    """Session settings for one test; double underscores stand for dots."""
    before = {}
    try:
        for key, value in conf.items():
            name = "spark.sql." + key.replace("__", ".")
            before[name] = spark.conf.get(name)
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def rows_per_task(df) -> list[int]:
    """How many result rows each task of the last stage makes."""
    rows = df.withColumn("task", F.spark_partition_id()).collect()
    return list(Counter(r["task"] for r in rows).values())


def names_in(*modules):
    owned = {m.__name__ for m in modules}
    return sorted(n for n, q in QUERIES.items() if q.__module__ in owned)


@pytest.mark.parametrize("name", names_in(aggregates, columns, messages, scalars))
def test_no_pair_joins_and_no_python_rows(spark, sf_dir, name):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert costly not in plan
    # A broadcast without a size limit is only made of a top list, whose length is fixed.
    if "BroadcastExchange" in plan:
        assert "TakeOrderedAndProject" in plan


def test_no_rows_pass_through_the_driver():
    banned = re.compile(r"\.collect\(|toPandas|toLocalIterator|localCheckpoint|crossJoin|\budf\(|\.rdd\.map|foreachPartition")
    for path in PACKAGE.rglob("*.py"):
        for number, line in enumerate(path.read_text().splitlines(), 1):
            assert not banned.search(line), f"{path.name}:{number}: {line}"


def test_scans_read_only_what_they_need(spark, sf_dir):
    plan = plan_of(QUERIES["value_counts"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_discount:double>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    pending = plan_of(QUERIES["pending_requests"](spark, sf_dir))
    assert set(re.findall(r"ReadSchema: (struct<.*?>)", pending)) == {"struct<event_id:bigint>"}


def test_filters_reach_the_scan(spark, sf_dir):
    requests = fixtures.delivery_orders(spark, sf_dir).where("order_value > 50000 AND payment_method = '2-HIGH'")
    plan = plan_of(requests)
    assert "GreaterThan(l_extendedprice,50000.0)" in plan
    assert "EqualTo(o_orderpriority,2-HIGH)" in plan


def test_box_plots_read_the_rows_once(spark, sf_dir):
    orders = fixtures.delivery_orders(spark, sf_dir)
    minutes = (F.unix_timestamp("delivery_ts") - F.unix_timestamp("order_ts")) / F.lit(60.0)
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        plan = final_plan(boxes.box_report(orders, box_groupings(), minutes))
    assert len(re.findall(r"FileScan parquet", plan)) == 2  # lines and orders
    assert plan.count("ReusedExchange") >= 2


def test_aggregates_are_combined_before_the_shuffle(spark, sf_dir):
    for name in ("value_counts", "group_mean_profit", "correlation_matrix", "response_lookup"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "partial_" in plan and "SortAggregate" not in plan, name


def test_top_lists_need_no_full_sort(spark, sf_dir):
    plan = plan_of(QUERIES["top_loss_orders"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


SKEWED = {
    "autoBroadcastJoinThreshold": "-1",
    "adaptive__autoBroadcastJoinThreshold": "-1",
    "adaptive__skewJoin__skewedPartitionThresholdInBytes": "2KB",
    "adaptive__skewJoin__skewedPartitionFactor": "1.2",
    "adaptive__advisoryPartitionSizeInBytes": "2KB",
}


@pytest.fixture
def hot(spark):
    """Requests of which a third share one id, spread over many input partitions."""
    requests = spark.range(0, 9000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), "id")).alias("UUID"),
        F.col("id").alias("n"),
    )
    answers = spark.range(0, 9000, 2, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), "id")).alias("UUID"),
        F.col("id").cast("timestamp").alias("resp_ts"),
        F.col("id").cast("double").alias("prediction"),
    )
    return requests, answers


@contextlib.contextmanager
def skew_settings(spark):
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        with settings(spark, **{k: v for k, v in SKEWED.items() if "adaptive__auto" not in k}):
            yield
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("operator", ["lookup", "pending", "context"])
def test_a_hot_id_is_split(spark, hot, operator):
    requests, answers = hot
    with skew_settings(spark):
        if operator == "lookup":
            df = matching.response_lookup(requests, answers)
            expected = 9000
        elif operator == "pending":
            df = matching.pending_requests(requests, answers)
            expected = 3000
        else:
            df = matching.attach_context_left(requests, answers.dropDuplicates(["UUID"]))
            expected = 9000
        plan = final_plan(df)
        rows = df.count()
    assert "skew=true" in plan
    assert rows == expected


def test_rows_without_id_are_spread(spark):
    unknown = F.when(F.col("id") < 0, "never").alias("UUID")
    requests = spark.range(0, 4000, 1, 4).select(unknown, "id")
    answers = spark.createDataFrame([("a", "x")], "UUID string, ctx string")
    with settings(spark, autoBroadcastJoinThreshold="-1", adaptive__enabled="false"):
        sizes = rows_per_task(matching.attach_context_left(requests, answers))
    assert sum(sizes) == 4000 and len(sizes) == 8 and max(sizes) < 1000


def test_waiting_spreads_a_hot_id_over_time(spark):
    asked = spark.range(0, 6000, 1, 4).select(
        F.lit("hot").alias("UUID"), F.timestamp_seconds(F.col("id") * 10).alias("req_ts")
    )
    answers = asked.select("UUID", F.col("req_ts").alias("resp_ts"), F.lit(1.0).alias("prediction"))
    with settings(spark, adaptive__enabled="false"):
        sizes = rows_per_task(matching.response_within_timeout(asked, answers))
    assert sum(sizes) == 6000 and len(sizes) == 8 and max(sizes) < 1500


def test_box_of_a_hot_group_is_spread_before_ranking(spark):
    df = spark.range(0, 20000, 1, 4).select(
        F.lit("hot").alias("g"), (F.col("id") / 7).alias("v")
    )
    with settings(spark, adaptive__enabled="false"):
        sizes = rows_per_task(boxes.histogram(df, {"g": F.col("g")}, F.col("v")))
    assert len(sizes) == 8 and max(sizes) < 4000


def test_small_scans_are_spread_and_large_ones_left_alone(spark, sf_dir):
    scan = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert use_all_cores(scan).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 1000, 1, 64)
    assert use_all_cores(wide) is wide


def test_correlation_plan_does_not_grow_with_rows_or_pairs(spark):
    df = spark.range(100).select(*[(F.col("id") * k).alias(f"c{k}") for k in range(1, 71)])
    assert profile.correlation_matrix(df.select("c1", "c2", "c3")).count() == 9


def test_correlation_spreads_a_group_that_holds_all_rows(spark, monkeypatch):
    seen, join = [], DataFrame.join
    monkeypatch.setattr(DataFrame, "join", lambda *args: seen.append(join(*args)) or seen[-1])
    df = spark.range(0, 20000, 1, 4).selectExpr("id % 7 as a", "id % 11 + 0.5 as b")
    with settings(spark, autoBroadcastJoinThreshold="-1", adaptive__enabled="false"):
        profile.correlation_matrix(df)
        sizes = rows_per_task(seen[0])
    assert sum(sizes) == 20000 and len(sizes) == 8 and max(sizes) < 5000


def fake_cluster(master, **conf):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    values = Conf({k.replace("__", "."): v for k, v in conf.items()})
    context = SimpleNamespace(master=master, applicationId="app", getConf=lambda: values)
    return SimpleNamespace(conf=values, sparkContext=context)


def test_work_folder_is_the_one_the_cluster_names():
    cluster = fake_cluster("spark://host:7077", spark__checkpoint__dir="hdfs://shared/tmp/")
    assert session_module.work_root(cluster) == "hdfs://shared/tmp"
    assert session_module.work_path(cluster, "x").startswith("hdfs://shared/tmp/tiffin/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session_module.work_root(fake_cluster("spark://host:7077"))


def test_partitions_follow_the_cluster(spark):
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    session_module.prepare(spark)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert session_module.stream_session(spark, 3).conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
