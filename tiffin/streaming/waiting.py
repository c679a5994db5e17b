"""Waiting for responses: requests and responses as two streams, matched per id.

`await_responses` is an interval join: it tells a request as soon as a response is there.
`settle_responses` is for streams in which one id asks and is answered several times and rows
come out of order: its result is that of `operators.matching.response_within_timeout` over the
same rows. Requests and answers are gathered by Spark's own streaming aggregation, by id and a
stretch of time as long as the limit; an answer is placed in its own stretch and the one before.
So a busy id is spread over many states, each of which holds the rows of one stretch and goes when
the watermark has passed it. A stretch that is over is told: a request ends at the first answer at
or after it, if that comes within the wait limit, else at the limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.schemas import RESPONSE_WAIT_SECONDS

_OUT = "waiter string, request_micros long, status string, prediction double"


def _first_answers(seconds: int):
    """Function over Arrow batches of stretches: each request with its first answer in time."""
    limit = seconds * 1_000_000

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flat(lists: pa.ListArray, start):
            """The row each element belongs to, the elements, and one sorted number for both:
            times lie within two limits of the start of the stretch."""
            row = pc.list_parent_indices(lists).to_numpy()
            values = lists.flatten()
            micros = values.field("micros") if pa.types.is_struct(values.type) else values
            offset = micros.to_numpy() - start[row]
            return row, values, row.astype("int64") * (4 * limit) + offset

        for batch in batches:
            start = batch["stretch"].to_numpy() * limit
            row, asked, at = flat(batch["requests"], start)
            _, answers, answered = flat(batch["answers"], start)
            first = np.searchsorted(answered, at)
            wait = np.append(answered, np.iinfo("int64").max)[first] - at
            served = wait <= limit
            chosen = pa.array(first, mask=~served)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["waiter"].take(pa.array(row)),
                    asked,
                    pa.array(np.where(served, "ok", "queued"), pa.string()),
                    answers.field("prediction").take(chosen),
                ],
                names=["waiter", "request_micros", "status", "prediction"],
            )

    return match


def await_responses(
    requests: DataFrame,
    responses: DataFrame,
    seconds: int = RESPONSE_WAIT_SECONDS,
    late_limit: str = "10 minutes",
) -> DataFrame:
    """Each request with a response if that came within the wait limit, else queued.

    `requests` has UUID and req_ts, `responses` has UUID, resp_ts and prediction. Copies are
    dropped on both sides first, so no row counts twice, and of several responses in time a
    request takes one that came first. A request without a timely response comes out once the
    watermark has passed its limit.
    """
    asked = (
        requests.select("UUID", "req_ts")
        .withWatermark("req_ts", late_limit)
        .dropDuplicatesWithinWatermark(["UUID", "req_ts"])
    )
    answered = (
        responses.select(F.col("UUID").alias("answer_id"), "resp_ts", "prediction")
        .withWatermark("resp_ts", late_limit)
        .dropDuplicatesWithinWatermark(["answer_id", "resp_ts"])
    )
    in_time = F.expr(
        "UUID = answer_id AND resp_ts BETWEEN req_ts AND req_ts + interval "
        f"{seconds} seconds"
    )
    told = asked.join(answered, in_time, "left_outer").select(
        F.col("UUID").alias("key"),
        "req_ts",
        F.when(F.col("answer_id").isNotNull(), "ok").otherwise("queued").alias("status"),
        "prediction",
    )
    return told.dropDuplicatesWithinWatermark(["key", "req_ts"])


def settle_responses(
    requests: DataFrame,
    responses: DataFrame,
    seconds: int = RESPONSE_WAIT_SECONDS,
    late_limit: str = "10 minutes",
) -> DataFrame:
    """Each request with the first response within the wait limit, else queued, exactly.

    `requests` has UUID and req_ts, `responses` has UUID, resp_ts and prediction. Copies of a
    request, equal in id and time, count once. A request without an id waits in vain, each one
    for itself, so that they do not meet in one state. A request without a time cannot be told
    late or in time and is left out, as are answers without id or time.
    """
    no_id = F.concat(F.lit("n"), F.expr("uuid()"))
    asked = requests.where(F.col("req_ts").isNotNull()).select(
        F.coalesce(F.concat(F.lit("k"), F.col("UUID")), no_id).alias("waiter"),
        F.col("req_ts").alias("event_ts"),
        F.lit(True).alias("asks"),
        F.lit(None).cast("double").alias("prediction"),
    )
    answered = responses.where(F.col("UUID").isNotNull() & F.col("resp_ts").isNotNull()).select(
        F.concat(F.lit("k"), F.col("UUID")).alias("waiter"),
        F.col("resp_ts").alias("event_ts"),
        F.lit(False).alias("asks"),
        "prediction",
    )
    micros = F.unix_micros("event_ts")
    stretch = F.floor(micros / F.lit(seconds * 1_000_000)).cast("bigint")
    places = F.when(F.col("asks"), F.array(stretch)).otherwise(F.array(stretch, stretch - 1))
    # The time of a row is here the moment after which its stretch gets no more answers, at most
    # two limits after the row.
    longer = f"{late_limit} {2 * seconds} seconds"

    def placed(side: DataFrame) -> DataFrame:
        at = side.withColumn("micros", micros).withColumn("stretch", F.explode(places))
        over = F.timestamp_seconds((F.col("stretch") + 2) * seconds)
        return at.drop("event_ts").withColumn("over", over).withWatermark("over", longer)

    # Each side has a watermark of its own; the slower one counts.
    both = placed(asked).unionByName(placed(answered))
    # Of answers at one time the smallest counts, a missing one last.
    answer = F.struct("micros", F.col("prediction").isNull().alias("missing"), "prediction")
    settled = (
        both.groupBy("waiter", "over", "stretch")
        .agg(
            F.collect_set(F.when(F.col("asks"), F.col("micros"))).alias("requests"),
            F.collect_set(F.when(~F.col("asks"), answer)).alias("answers"),
        )
        .where(F.size("requests") > 0)
        .select("waiter", "stretch", "requests", F.array_sort("answers").alias("answers"))
        .mapInArrow(_first_answers(seconds), _OUT)
    )
    own = F.col("waiter").startswith("k")
    return settled.select(
        F.when(own, F.col("waiter").substr(F.lit(2), F.length("waiter"))).alias("key"),
        F.timestamp_micros("request_micros").alias("req_ts"),
        "status",
        "prediction",
    )
