"""Matching requests, predictions and responses by request id.

The id may be missing in many rows, and one id may occur very often. Rows without an id can
never match, yet an outer or anti join would send all of them to one task, so the join key
has a second part that spreads them. The second part also keeps the planner from reusing
the partitioning of an earlier aggregation: both sides are then shuffled for the join itself,
which is what lets adaptive execution split the partition of an id that is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.schemas import RESPONSE_WAIT_SECONDS

SPREAD = 1024
_SPREAD = "_spread"


def _join_by_id(left: DataFrame, right: DataFrame, how: str, key: str = "UUID") -> DataFrame:
    """Left-preserving join on `key` that copes with missing and with hot keys."""
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    spread = F.pmod(row_hash, F.when(F.col(key).isNull(), SPREAD).otherwise(1))
    # Where there is a key both parts are 0, but computed from the row: a literal would be
    # folded out of the join key.
    nothing = F.pmod(F.xxhash64(key), F.lit(1))
    return (
        left.withColumn(_SPREAD, spread.cast("bigint"))
        .join(right.withColumn(_SPREAD, nothing.cast("bigint")), [key, _SPREAD], how)
        .drop(_SPREAD)
    )


def first_response(responses: DataFrame) -> DataFrame:
    """The prediction of the earliest response per id.

    Partial aggregation shrinks repeated ids before the shuffle, and with fixed-width
    buffers only it stays a hash aggregation.
    """
    return (
        responses.where(F.col("UUID").isNotNull())
        .groupBy("UUID")
        .agg(F.min_by("prediction", "resp_ts").alias("prediction"))
    )


def attach_context_left(predictions: DataFrame, context: DataFrame) -> DataFrame:
    """Each prediction once, with the request context of the same id, where there is one.

    Of several contexts of an id the smallest counts, by its columns in order.
    """
    rest = [c for c in context.columns if c != "UUID"]
    single = (
        context.where(F.col("UUID").isNotNull())
        .groupBy("UUID")
        .agg(F.min(F.struct(F.lit(0).alias("_first"), *[F.col(f"`{c}`") for c in rest])).alias("_row"))
        .select("UUID", *[F.col(f"_row.`{c}`") for c in rest])
    )
    return _join_by_id(predictions, single, "left")


def response_lookup(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """For each request whether its response is there, and the response."""
    answered = first_response(responses).withColumn("_found", F.lit(True))
    return _join_by_id(requests.select("UUID"), answered, "left").select(
        F.col("UUID").alias("id"),
        F.when(F.col("_found"), "done").otherwise("pending").alias("status"),
        "prediction",
    )


def pending_requests(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests for which no response exists."""
    answered = responses.where(F.col("UUID").isNotNull()).select("UUID").distinct()
    return _join_by_id(requests, answered, "left_anti")


def response_within_timeout(
    requests: DataFrame, responses: DataFrame, seconds: int = RESPONSE_WAIT_SECONDS
) -> DataFrame:
    """The first response at or after each request, if it came within the wait limit.

    `requests` has UUID and req_ts, `responses` has UUID, resp_ts and prediction. Instead of
    joining, which would pair every request with every response of the same id, both are
    laid in one timeline per id and read backwards, carrying the nearest later response.
    The timeline is cut into stretches as long as the limit; each response is placed in its
    own stretch and the one before, so a busy id is spread over its stretches.
    """
    limit = F.lit(seconds)

    def stretch(ts: Column) -> Column:
        return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)).cast("bigint")

    # Requests without an id wait in vain; any stretch will do, so they are spread.
    spread = F.pmod(F.xxhash64(*requests.columns), F.lit(SPREAD))
    asked = requests.select(
        "UUID",
        F.when(F.col("UUID").isNull(), spread)
        .otherwise(stretch(F.col("req_ts")))
        .alias("stretch"),
        F.col("req_ts").alias("ts"),
        F.lit(1).alias("side"),
        F.lit(None).cast("double").alias("prediction"),
    )
    # Copies of one response add nothing: the first per id and time is enough.
    answers = (
        responses.where(F.col("UUID").isNotNull() & F.col("resp_ts").isNotNull())
        .groupBy("UUID", "resp_ts")
        .agg(F.min("prediction").alias("prediction"))
    )
    answered = answers.select(
        "UUID",
        F.explode(F.array(stretch(F.col("resp_ts")), stretch(F.col("resp_ts")) - 1)).alias(
            "stretch"
        ),
        F.col("resp_ts").alias("ts"),
        F.lit(0).alias("side"),
        "prediction",
    )
    nearest = F.expr(
        "last(if(side = 0, named_struct('ts', ts, 'prediction', prediction), null), true)"
        " over (partition by UUID, stretch order by ts desc, side"
        " rows between unbounded preceding and current row)"
    )
    matched = (
        asked.unionByName(answered)
        .withColumn("_next", nearest)
        .where("side = 1")
        .withColumn("in_time", F.col("_next.ts") <= F.col("ts") + F.make_dt_interval(secs=limit))
    )
    return matched.select(
        F.col("UUID").alias("key"),
        F.col("ts").alias("req_ts"),
        F.when(F.col("in_time"), "ok").otherwise("queued").alias("status"),
        F.when(F.col("in_time"), F.col("_next.prediction")).alias("prediction"),
    )
