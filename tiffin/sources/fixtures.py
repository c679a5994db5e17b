"""Delivery tables derived from the star-schema test tables.

The order lines play the delivered orders and the events play the prediction requests. Each
function is a lazy projection over the parquet files, so column pruning and filters reach
the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.sources.tables import use_all_cores


def _minutes_after(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, ts)


def _offer(discount: Column) -> Column:
    percent = F.concat(F.round(discount * 100).cast("int").cast("string"), F.lit("%"))
    return (
        F.when(discount == 0, "None")
        .when(discount < 0.045, percent)
        .when(discount < 0.075, F.concat(percent, F.lit(" on App")))
        .when(discount < 0.085, "50 off Promo")
        .when(discount < 0.095, F.lit(None).cast("string"))
        .otherwise("FREESHIP10")
    )


def delivery_orders(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Delivered orders: one row per order line.

    `heavy` is for work that costs far more per row than reading it, such as scoring: a
    table in few splits is then spread over all cores first.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines = use_all_cores(lines) if heavy else lines
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    start = F.pmod(
        F.col("l_orderkey") * 7 + F.col("l_linenumber") * 61 + F.col("l_partkey") * 13,
        F.lit(1440),
    )
    length = F.pmod(F.col("l_partkey") * 17 + F.col("l_suppkey") * 5, F.lit(100)) + 20
    order_ts = _minutes_after(F.col("o_orderdate").cast("timestamp"), start)
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        "l_partkey",
        F.concat(F.lit("c"), F.col("o_custkey")).alias("customer_id"),
        F.concat(F.lit("r"), F.col("l_suppkey")).alias("restaurant_id"),
        order_ts.alias("order_ts"),
        _minutes_after(order_ts, length).alias("delivery_ts"),
        F.col("l_extendedprice").alias("order_value"),
        (F.pmod("l_partkey", F.lit(6)) * F.lit(10.0)).alias("delivery_fee"),
        F.col("o_orderpriority").alias("payment_method"),
        _offer(F.col("l_discount")).alias("discounts_and_offers"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("commission_fee"),
        F.col("l_quantity").alias("payment_processing_fee"),
        F.when(
            F.col("l_returnflag") == "R", F.pmod("l_orderkey", F.lit(4)) * F.lit(50.0)
        ).otherwise(0.0).alias("refunds"),
    )


def requests_from_events(events: DataFrame) -> DataFrame:
    """Prediction requests read off an events table, batch or streaming."""
    number = F.col("event_id")
    k = F.get_json_object("props", "$.k")
    return events.select(
        F.concat(F.lit("e"), number).alias("UUID"),
        F.concat(F.lit("c"), F.col("user_id")).alias("customer_id"),
        F.concat(F.lit("r"), F.pmod(number, F.lit(40))).alias("restaurant_id"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("order_date_and_time"),
        F.col("value").alias("order_value"),
        (F.pmod(number, F.lit(6)) * F.lit(1.0)).alias("delivery_fee"),
        F.when(F.pmod(number, F.lit(50)) != 0, F.col("event_type")).alias("payment_method"),
        F.when(F.pmod(number, F.lit(5)) == 1, "None")
        .when(F.pmod(number, F.lit(5)) == 2, F.concat(k, F.lit("%")))
        .when(F.pmod(number, F.lit(5)) == 3, "50 off Promo")
        .when(F.pmod(number, F.lit(5)) == 4, F.concat(k, F.lit("% on App")))
        .alias("discounts_and_offers"),
        (F.col("value") * 0.125).alias("commission_fee"),
        F.lit(0.5).alias("payment_processing_fee"),
        F.when(F.col("event_type") == "error", F.col("value"))
        .otherwise(0.0)
        .alias("refunds/chargebacks"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_from_events(events(spark, sf_dir))


def event_number(uuid: Column) -> Column:
    """The event a request id was made from."""
    return F.substring(uuid, 2, 20).cast("bigint")


def with_repeats(requests_df: DataFrame) -> DataFrame:
    """Every tenth request a second time, ten minutes later, marked by `attempt`.

    The repeats are made by exploding, so the requests are read only once.
    """
    attempts = F.when(
        F.pmod(event_number(F.col("UUID")), F.lit(10)) == 0, F.array(F.lit(0), F.lit(1))
    ).otherwise(F.array(F.lit(0)))
    return requests_df.withColumn("attempt", F.explode(attempts)).withColumn(
        "order_date_and_time",
        _minutes_after(F.col("order_date_and_time"), F.col("attempt") * 10),
    )


def requests_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_repeats(requests(spark, sf_dir))


def responses_from_events(events_df: DataFrame) -> DataFrame:
    """Answers to six out of seven requests, up to a minute and a half after them."""
    number = F.col("event_id")
    sent = F.date_trunc("second", F.col("ts").cast("timestamp"))
    return events_df.where(F.pmod(number, F.lit(7)) != 0).select(
        F.concat(F.lit("e"), number).alias("UUID"),
        (F.lit(20.0) + F.pmod(number, F.lit(60))).alias("prediction"),
        F.timestamp_add("SECOND", F.pmod(number, F.lit(90)), sent).alias("resp_ts"),
    )


def responses_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses, and to the ids that asked twice a second one, ten minutes later."""
    first = responses(spark, sf_dir)
    again = first.where(F.pmod(event_number(F.col("UUID")), F.lit(10)) == 0).select(
        "UUID",
        (F.col("prediction") + 1).alias("prediction"),
        F.timestamp_add("MINUTE", F.lit(10), F.col("resp_ts")).alias("resp_ts"),
    )
    return first.unionByName(again)


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses_from_events(events(spark, sf_dir))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered orders with a prediction beside the actual minutes."""
    return delivery_orders(spark, sf_dir).withColumn(
        "prediction", F.lit(40.0) + F.pmod("l_partkey", F.lit(50))
    )
