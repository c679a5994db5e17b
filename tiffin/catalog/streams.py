"""Streaming queries. Each runs a stream over the tables to its end and returns what it wrote."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.catalog.models import trained
from tiffin.catalog.registry import query
from tiffin.catalog.views import sql
from tiffin.operators import columns, documents
from tiffin.session import stream_session, work_path
from tiffin.sources import fixtures
from tiffin.sources.messages import decode_requests, decode_with_source, request_source
from tiffin.streaming import dedup, ledger, scoring, sinks, waiting


def _event_stream(session: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream. The pattern also matches a folder of part files."""
    schema = session.read.parquet(f"{sf_dir}/events.parquet").schema
    return session.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")


def _request_messages(session: SparkSession, sf_dir: str, broken_every: int = 0) -> DataFrame:
    """Requests as a stream of `(key, value)` messages, some of them not JSON if so wished."""
    requests = fixtures.requests_from_events(_event_stream(session, sf_dir))
    messages = documents.request_kv_encode(requests)
    if broken_every:
        broken = F.pmod(fixtures.event_number(F.col("key")), F.lit(broken_every)) == 0
        messages = messages.withColumn(
            "value", F.when(broken, F.concat(F.lit("not json "), "key")).otherwise(F.col("value"))
        )
    return messages


def _run(df: DataFrame, out: str, checkpoint: str):
    """Append a stream to parquet until its input is used up; returns the finished stream."""
    stream = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return stream


def _collected(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Run a stream into a table of its own and read that back."""
    out = work_path(spark, label)
    _run(df, out, work_path(spark, f"{label}-checkpoint"))
    return spark.read.schema(df.schema).parquet(out)


# -- source and positions ---------------------------------------------------


@query("request_source", sql("requests", "SELECT * EXCLUDE (event_id) FROM requests"))
def request_source_query(spark, sf_dir):
    """Requests written as JSON files of messages, then read back as a stream."""
    path = work_path(spark, "messages")
    documents.request_kv_encode(fixtures.requests(spark, sf_dir)).write.json(path)
    session = stream_session(spark)
    return _collected(spark, decode_requests(request_source(session, "json", path)), "source")


@query("append_checkpointed", sql("requests", 'SELECT "UUID", event_id % 2 AS arrival FROM requests'))
def append_checkpointed(spark, sf_dir):
    """Two halves arrive one after the other; the second start reads only the new half."""
    folder = work_path(spark, "arrivals")
    out, checkpoint = work_path(spark, "appended"), work_path(spark, "appended-checkpoint")
    session = stream_session(spark)
    arrived = fixtures.requests(spark, sf_dir).withColumn(
        "arrival", F.pmod(fixtures.event_number(F.col("UUID")), F.lit(2))
    ).select("UUID", "arrival")
    for half in (0, 1):
        arrived.where(F.col("arrival") == half).write.mode("append").parquet(folder)
        _run(session.readStream.schema(arrived.schema).parquet(folder), out, checkpoint)
    return spark.read.schema(arrived.schema).parquet(out)


@query(
    "start_position",
    sql("requests", """
SELECT 'replay' AS start, "UUID" FROM requests
UNION ALL SELECT 'resumed', "UUID" FROM requests WHERE event_id % 2 = 1"""),
)
def start_position(spark, sf_dir):
    """What a new stream reads and what a resumed one reads, once the second half has come."""
    folder, checkpoint = work_path(spark, "positions"), work_path(spark, "resumed-checkpoint")
    session = stream_session(spark)
    arrived = documents.request_kv_encode(fixtures.requests(spark, sf_dir)).withColumn(
        "half", F.pmod(fixtures.event_number(F.col("key")), F.lit(2))
    )

    def stream() -> DataFrame:
        source = request_source(session, "json", folder, starting="earliest")
        return decode_requests(source).select("UUID")

    def send(half: int) -> None:
        arrived.where(F.col("half") == half).drop("half").write.mode("append").json(folder)

    send(0)
    _run(stream(), work_path(spark, "first-half"), checkpoint)
    send(1)
    resumed = work_path(spark, "resumed")
    later = (
        stream().writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(_parquet_sink(resumed))
        .trigger(availableNow=True)
        .start()
    )
    later.awaitTermination()
    replay = _collected(spark, stream(), "replay")
    read_back = spark.read.schema("UUID string").parquet(resumed).select("UUID")
    return replay.select(F.lit("replay").alias("start"), "UUID").unionByName(
        read_back.select(F.lit("resumed").alias("start"), "UUID")
    )


# -- event time and repeats -------------------------------------------------


@query(
    "watermark_1h",
    sql("requests", """
SELECT strftime(max(order_date_and_time) - to_hours(1), '%Y-%m-%dT%H:%M:%S') AS watermark, count(*) AS n_rows
FROM requests"""),
)
def watermark_1h(spark, sf_dir):
    """Where the watermark stands once all requests have been seen."""
    session = stream_session(spark)
    requests = fixtures.requests_from_events(_event_stream(session, sf_dir))
    limited = dedup.dedup_uuid_bounded(dedup.with_late_limit(requests)).select("UUID")
    out = work_path(spark, "watermark")
    stream = _run(limited, out, work_path(spark, "watermark-checkpoint"))
    reached = max(p["eventTime"]["watermark"] for p in stream.recentProgress if p["eventTime"])
    return (
        spark.read.schema(limited.schema)
        .parquet(out)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(reached[:19]).alias("watermark"), "n_rows")
    )


def _resent_stream(session: SparkSession, sf_dir: str) -> DataFrame:
    requests = fixtures.requests_from_events(_event_stream(session, sf_dir))
    return fixtures.with_repeats(requests)


@query("dedup_uuid", sql("resent", 'SELECT DISTINCT "UUID" FROM resent'))
def dedup_uuid(spark, sf_dir):
    stream = dedup.with_late_limit(_resent_stream(stream_session(spark), sf_dir))
    return _collected(spark, dedup.dedup_uuid(stream).select("UUID"), "dedup")


@query("dedup_uuid_bounded", sql("resent", 'SELECT DISTINCT "UUID" FROM resent'))
def dedup_uuid_bounded(spark, sf_dir):
    """With the copies of an id reduced in eight tasks before they meet."""
    stream = dedup.with_late_limit(_resent_stream(stream_session(spark), sf_dir))
    return _collected(spark, dedup.dedup_uuid_bounded(stream, spread=8).select("UUID"), "bounded")


_THIRD = 3


@query(
    "late_rows",
    sql("resent", f"""
, arrivals AS (SELECT *, CASE WHEN attempt = 1 THEN {_THIRD} ELSE (event_id // 8) % {_THIRD} END AS arrival FROM resent),
limits AS (
  SELECT a.arrival, max(b.order_date_and_time) - to_hours(1) AS watermark
  FROM (SELECT DISTINCT arrival FROM arrivals) a LEFT JOIN arrivals b ON b.arrival < a.arrival GROUP BY 1)
SELECT "UUID", attempt, CAST(arrival AS BIGINT) AS arrival, order_date_and_time FROM arrivals JOIN limits USING (arrival)
WHERE watermark IS NULL OR order_date_and_time > watermark"""),
)
def late_rows(spark, sf_dir):
    """Rows that pass when requests arrive in four portions that overlap in time.

    A portion meets the watermark that the portions before it have reached.
    """
    folder = work_path(spark, "portions")
    out, checkpoint = work_path(spark, "on-time"), work_path(spark, "on-time-checkpoint")
    number = fixtures.event_number(F.col("UUID"))
    third = F.pmod(F.floor(number / 8), F.lit(_THIRD))
    rows = fixtures.requests_resent(spark, sf_dir).select(
        "UUID",
        "attempt",
        F.when(F.col("attempt") == 1, _THIRD).otherwise(third).cast("bigint").alias("arrival"),
        "order_date_and_time",
    )
    session = stream_session(spark)
    for portion in range(_THIRD + 1):
        rows.where(F.col("arrival") == portion).write.mode("append").parquet(folder)
        stream = session.readStream.schema(rows.schema).parquet(folder)
        on_time = dedup.with_late_limit(stream).dropDuplicatesWithinWatermark(["UUID", "attempt"])
        _run(on_time, out, checkpoint)
    return spark.read.schema(rows.schema).parquet(out)


@query(
    "late_rows_output",
    sql("resent", f"""
, arrivals AS (SELECT *, CASE WHEN attempt = 1 THEN {_THIRD} ELSE (event_id // 8) % {_THIRD} END AS arrival FROM resent),
limits AS (
  SELECT a.arrival, max(b.order_date_and_time) - to_hours(1) AS watermark
  FROM (SELECT DISTINCT arrival FROM arrivals) a LEFT JOIN arrivals b ON b.arrival < a.arrival GROUP BY 1)
SELECT "UUID", attempt, order_date_and_time, coalesce(order_date_and_time <= watermark, false) AS late
FROM arrivals JOIN limits USING (arrival)"""),
)
def late_rows_output(spark, sf_dir):
    """The same portions, with the rows behind the limit written beside the others."""
    folder, checkpoint = work_path(spark, "portions"), work_path(spark, "split-checkpoint")
    paths = {late: work_path(spark, f"late-{late}") for late in (False, True)}
    number = fixtures.event_number(F.col("UUID"))
    third = F.pmod(F.floor(number / 8), F.lit(_THIRD))
    rows = fixtures.requests_resent(spark, sf_dir).select("UUID", "attempt", "order_date_and_time")
    arrival = F.when(F.col("attempt") == 1, _THIRD).otherwise(third)
    session = stream_session(spark)
    split = ledger.late_splitter(
        dt.timedelta(hours=1), _parquet_sink(paths[False]), _parquet_sink(paths[True]),
        work_path(spark, "reached"),
    )
    for portion in range(_THIRD + 1):
        rows.where(arrival == portion).write.mode("append").parquet(folder)
        stream = session.readStream.schema(rows.schema).parquet(folder)
        (
            stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(split)
            .trigger(availableNow=True).start().awaitTermination()
        )
    parts = [
        spark.read.schema(rows.schema).parquet(path).select(*rows.columns, F.lit(late).alias("late"))
        for late, path in paths.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "dedup_untimed",
    sql("requests", 'SELECT "UUID", event_id % 5 = 0 AS untimed FROM requests'),
)
def dedup_untimed(spark, sf_dir):
    """Every request comes again in a later run; a fifth of them has no order time."""
    folder = work_path(spark, "resent")
    out, checkpoint = work_path(spark, "once"), work_path(spark, "once-checkpoint")
    bare = F.pmod(fixtures.event_number(F.col("UUID")), F.lit(5)) == 0
    rows = fixtures.requests(spark, sf_dir).select(
        "UUID", F.when(~bare, F.col("order_date_and_time")).alias("order_date_and_time")
    )
    session = stream_session(spark)
    for _ in range(2):
        rows.write.mode("append").parquet(folder)
        stream = dedup.with_late_limit(session.readStream.schema(rows.schema).parquet(folder))
        once = dedup.dedup_requests(stream).select(
            "UUID", F.col("order_date_and_time").isNull().alias("untimed")
        )
        _run(once, out, checkpoint)
    return spark.read.schema(once.schema).parquet(out)


@query(
    "await_responses",
    sql("responses", """
SELECT r."UUID" AS key, r.order_date_and_time AS req_ts,
  CASE WHEN s."UUID" IS NULL THEN 'queued' ELSE 'ok' END AS status, prediction
FROM requests r LEFT JOIN responses s
  ON r."UUID" = s."UUID" AND s.resp_ts BETWEEN r.order_date_and_time AND r.order_date_and_time + to_seconds(60)
WHERE s."UUID" IS NOT NULL
  OR r.order_date_and_time + to_seconds(60) < (SELECT least(max(order_date_and_time), (SELECT max(resp_ts) FROM responses)) FROM requests) - to_minutes(10)"""),
)
def await_responses(spark, sf_dir):
    """Requests with a timely response, and those whose wait is over at the end of the streams."""
    session = stream_session(spark)
    requests = fixtures.requests_from_events(_event_stream(session, sf_dir)).select(
        "UUID", F.col("order_date_and_time").alias("req_ts")
    )
    responses = fixtures.responses_from_events(_event_stream(session, sf_dir))
    return _collected(spark, waiting.await_responses(requests, responses), "awaited")


_ANSWERS = """
, answers AS (
  SELECT "UUID", prediction, resp_ts FROM responses
  UNION ALL SELECT "UUID", prediction + 1, resp_ts + to_minutes(10) FROM responses
  WHERE CAST(substr("UUID", 2) AS BIGINT) % 10 = 0)"""


@query(
    "await_repeated_responses",
    sql("resent_responses", f"""{_ANSWERS}
SELECT r."UUID" AS key, r.order_date_and_time AS req_ts,
  CASE WHEN count(s."UUID") > 0 THEN 'ok' ELSE 'queued' END AS status, arg_min(s.prediction, s.resp_ts) AS prediction
FROM resent r LEFT JOIN answers s
  ON r."UUID" = s."UUID" AND s.resp_ts BETWEEN r.order_date_and_time AND r.order_date_and_time + to_seconds(60)
GROUP BY r."UUID", r.order_date_and_time"""),
)
def await_repeated_responses(spark, sf_dir):
    """Two requests and two answers of one id, all out of order: answers come in three portions,
    the last ones first, and half of the requests come after their answers.

    The limit for late rows covers the whole table, and a last row far ahead ends every wait.
    """
    asked_at, answered_at = work_path(spark, "asked"), work_path(spark, "answered")
    out, checkpoint = work_path(spark, "told"), work_path(spark, "told-checkpoint")
    number = fixtures.event_number(F.col("UUID"))
    asked = fixtures.requests_resent(spark, sf_dir).select(
        "UUID", F.col("order_date_and_time").alias("req_ts")
    )
    answered = fixtures.responses_resent(spark, sf_dir).select("UUID", "resp_ts", "prediction")
    asked_portion = F.pmod(number, F.lit(2)) * 2
    answered_portion = F.lit(2) - F.pmod(number + F.minute("resp_ts"), F.lit(3))
    ahead = F.timestamp_add("YEAR", F.lit(60), F.lit("2024-01-01").cast("timestamp"))
    session = stream_session(spark)
    for portion in range(4):
        last = portion == 3
        asks = asked.where(asked_portion == portion)
        answers = answered.where(answered_portion == portion)
        if last:
            end = spark.range(1).select(F.lit("end").alias("UUID"), ahead.alias("req_ts"))
            asks = end
            answers = end.select("UUID", F.col("req_ts").alias("resp_ts"), F.lit(0.0).alias("prediction"))
        asks.write.mode("append").parquet(asked_at)
        answers.write.mode("append").parquet(answered_at)
        told = waiting.settle_responses(
            session.readStream.schema(asked.schema).parquet(asked_at),
            session.readStream.schema(answered.schema).parquet(answered_at),
            late_limit="10000 days",
        )
        _run(told, out, checkpoint)
    return spark.read.schema(told.schema).parquet(out)


# -- scoring ----------------------------------------------------------------

_SCORED = ["UUID", "payment_method_ctx", "discounts_and_offers_ctx", "order_date_and_time_ctx"]


def _score_all(
    spark, sf_dir, sink_list, errors, rejects, broken_every=0, batch_log=None, checkpoint=None, **more
):
    session = stream_session(spark)
    stream = scoring.start_scoring(
        _request_messages(session, sf_dir, broken_every),
        trained(spark, sf_dir).model,
        sink_list,
        checkpoint=checkpoint or work_path(spark, "scoring-checkpoint"),
        errors=errors,
        rejects=rejects,
        available_now=True,
        batch_log=batch_log,
        **more,
    )
    stream.awaitTermination()


def _parquet_sink(path: str) -> sinks.Writer:
    def write(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={epoch}")

    return write


@query(
    "foreach_batch_score",
    sql("requests", """
SELECT "UUID", coalesce(payment_method, 'unknown') AS payment_method_ctx,
  coalesce(discounts_and_offers, 'none') AS discounts_and_offers_ctx,
  order_date_and_time AS order_date_and_time_ctx, true AS has_prediction, true AS has_timestamp
FROM requests WHERE event_id % 97 <> 0"""),
)
def foreach_batch_score(spark, sf_dir):
    """The whole scoring stream: decode, reject, de-duplicate, score, write per batch."""
    out = work_path(spark, "responses")
    _score_all(
        spark,
        sf_dir,
        [sinks.Sink("responses", _parquet_sink(out))],
        errors=work_path(spark, "errors"),
        rejects=work_path(spark, "rejects"),
        broken_every=97,
    )
    return spark.read.parquet(out).select(
        *_SCORED,
        F.col("prediction").isNotNull().alias("has_prediction"),
        F.col(columns.quoted("@timestamp")).isNotNull().alias("has_timestamp"),
    )


@query(
    "empty_batch_skip",
    sql("requests", 'SELECT "UUID", 1 AS batch_id FROM requests'),
)
def empty_batch_skip(spark, sf_dir):
    """An empty batch and a full one through the scorer: only the full one is written."""
    out = work_path(spark, "batches")
    process = scoring.batch_scorer(
        trained(spark, sf_dir).model,
        [sinks.Sink("responses", _parquet_sink(out))],
        errors=work_path(spark, "errors"),
    )
    messages = documents.request_kv_encode(fixtures.requests(spark, sf_dir))
    batch = decode_with_source(messages).withColumn("rejected", F.col("UUID").isNull())
    process(batch.where(F.col("UUID") == ""), 0)
    process(batch, 1)
    return spark.read.parquet(out).select("UUID", "batch_id")


@query(
    "batch_ledger",
    sql("requests", """
SELECT count(*) AS rows_in, count(*) FILTER (WHERE event_id % 97 <> 0) AS rows_scored,
  count(*) FILTER (WHERE event_id % 97 = 0) AS rows_rejected
FROM requests"""),
)
def batch_ledger(spark, sf_dir):
    """Row counts of a real scored stream, read back from its ledger of batches."""
    counted = ledger.BatchLedger(spark, work_path(spark, "batches"))
    _score_all(
        spark, sf_dir, [], errors=work_path(spark, "errors"), rejects=work_path(spark, "rejects"),
        broken_every=97, batch_log=counted,
    )
    names = ("rows_in", "rows_scored", "rows_rejected")
    return counted.counts().agg(*[F.sum(n).alias(n) for n in names])


def _failing(times: int, write: sinks.Writer) -> sinks.Writer:
    """A writer that fails a number of times before it works."""
    left = [times]

    def run(df: DataFrame, epoch: int) -> None:
        if left[0] > 0:
            left[0] -= 1
            raise OSError("down")
        write(df, epoch)

    return run


def _failed_twice(spark, sf_dir) -> tuple[sinks.Sink, str, str, str]:
    """A scored stream in which `search` fails in both runs of a batch, `messages` in the first."""
    paths = {n: work_path(spark, n) for n in ("search", "messages", "errors", "held", "failed-checkpoint")}
    search = sinks.Sink("search", _failing(2, _parquet_sink(paths["search"])), on_error="continue")
    required = sinks.Sink("messages", _failing(1, _parquet_sink(paths["messages"])))
    for _ in range(2):
        try:
            _score_all(
                spark, sf_dir, [search, required], errors=paths["errors"],
                rejects=work_path(spark, "rejects"), broken_every=97,
                checkpoint=paths["failed-checkpoint"], held=paths["held"],
            )
        except StreamingQueryException:
            continue  # the required sink was down: the next run repeats the batch
    return search, paths["search"], paths["errors"], paths["held"]


@query(
    "failure_ledger",
    sql("requests", """
, good AS (SELECT count(*) AS n FROM requests WHERE event_id % 97 <> 0)
SELECT 'search' AS sink, 'sink search' AS note, 'down' AS error, CAST(1 AS BIGINT) AS n_records, n AS n_held FROM good
UNION ALL SELECT 'messages', 'sink messages', 'down', 1, 0"""),
)
def failure_ledger(spark, sf_dir):
    """One record for each sink that failed, however often, and the rows that wait for it."""
    _, _, errors, held = _failed_twice(spark, sf_dir)
    waiting_rows = spark.read.parquet(held).groupBy("sink").agg(F.count(F.lit(1)).alias("n_held"))
    records = sinks.failures(spark, errors).groupBy("sink", "note", "error").agg(
        F.count(F.lit(1)).alias("n_records")
    )
    return records.join(waiting_rows, "sink", "left").select(
        "sink", "note", "error", "n_records", F.coalesce("n_held", F.lit(0)).cast("long").alias("n_held")
    )


@query(
    "failure_replay",
    sql("requests", """SELECT "UUID", CAST(0 AS BIGINT) AS open_records FROM requests WHERE event_id % 97 <> 0"""),
)
def failure_replay(spark, sf_dir):
    """What the sink has once its held batches were replayed, and no record of it is left."""
    search, path, errors, held = _failed_twice(spark, sf_dir)
    sinks.replay(spark, held, errors, [search])
    still_open = sinks.failures(spark, errors).where("sink = 'search'").count()
    return spark.read.parquet(path).select("UUID", F.lit(still_open).cast("long").alias("open_records"))


@query(
    "committed_batches",
    sql("requests", 'SELECT "UUID", CAST(0 AS BIGINT) AS batch_id FROM requests WHERE event_id % 2 = 0'),
)
def committed_batches(spark, sf_dir):
    """Two batches, the second of which stops between its two sinks: only the first is seen."""
    out, other = work_path(spark, "first-sink"), work_path(spark, "second-sink")
    commits = work_path(spark, "commits")
    second = sinks.Sink("second", _parquet_sink(other))
    process = scoring.batch_scorer(
        trained(spark, sf_dir).model, [sinks.Sink("first", _parquet_sink(out)), second],
        errors=work_path(spark, "errors"), commits=commits,
    )
    messages = documents.request_kv_encode(fixtures.requests(spark, sf_dir))
    batch = decode_with_source(messages).withColumn("rejected", F.col("UUID").isNull())
    half = F.pmod(fixtures.event_number(F.col("UUID")), F.lit(2))
    process(batch.where(half == 0), 0)
    second.write = _failing(1, second.write)
    try:
        process(batch.where(half == 1), 1)
    except sinks.SinkFailed:
        pass  # the stream would stop here
    rows = spark.read.parquet(out).select("UUID", F.col("batch_id").cast("long").alias("batch_id"))
    return ledger.committed(rows, ledger.notes(spark, commits, ledger.COMMIT))


@query("stream_score_plain")
def stream_score_plain(spark, sf_dir):
    """Scores the stream itself, without a function per batch or any de-duplication."""
    session = stream_session(spark)
    requests = decode_requests(_request_messages(session, sf_dir))
    scored = scoring.score_stream(trained(spark, sf_dir).model, requests)
    return _collected(spark, scoring.response_document(scored), "plain")


@query("stream_equals_batch", sql("requests", 'SELECT "UUID", true AS equal FROM requests'))
def stream_equals_batch(spark, sf_dir):
    """Whether each request is answered by the stream as the batch form of the same plan answers it.

    Requests of which one form has no answer show as not equal.
    """
    streamed = stream_score_plain(spark, sf_dir).select("UUID", "prediction")
    messages = documents.request_kv_encode(fixtures.requests(spark, sf_dir))
    batch = scoring.score_stream(trained(spark, sf_dir).model, decode_requests(messages))
    both = streamed.join(
        batch.select("UUID", F.col("prediction").alias("expected")), "UUID", "full"
    )
    equal = F.coalesce(F.col("prediction") == F.col("expected"), F.lit(False))
    return both.select("UUID", equal.alias("equal"))


@query(
    "fan_out",
    sql("requests", """
, good AS (SELECT * FROM requests WHERE event_id % 97 <> 0)
SELECT 'messages' AS sink, count(*) AS n_rows, min("UUID") AS first_id, max("UUID") AS last_id FROM good
UNION ALL SELECT 'documents', count(*), min("UUID"), max("UUID") FROM good
UNION ALL SELECT 'search', count(*), min("UUID"), max("UUID") FROM good
UNION ALL SELECT 'rejects', count(*), min("UUID"), max("UUID") FROM requests WHERE event_id % 97 = 0"""),
)
def fan_out(spark, sf_dir):
    """One scored batch to three sinks, with rejected messages beside them."""
    paths = {name: work_path(spark, name) for name in ("search", "messages", "documents", "rejects")}
    _score_all(
        spark,
        sf_dir,
        [
            sinks.Sink("search", sinks.search_sink(paths["search"]), on_error="continue"),
            sinks.Sink("messages", sinks.message_sink("parquet", paths["messages"])),
            sinks.Sink("documents", sinks.document_sink(paths["documents"])),
        ],
        errors=work_path(spark, "errors"),
        rejects=paths["rejects"],
        broken_every=97,
    )
    lines = spark.read.text(paths["search"])
    ids = {
        "messages": spark.read.parquet(paths["messages"]).select(F.col("key").alias("id")),
        "documents": spark.read.schema("UUID string").json(paths["documents"]).select(
            F.col("UUID").alias("id")
        ),
        "search": lines.select(
            F.get_json_object("value", "$.index._id").alias("id")
        ).where(F.col("id").isNotNull()),
        "rejects": spark.read.schema("note string").json(paths["rejects"]).select(
            F.regexp_extract("note", r"not json (\w+)", 1).alias("id")
        ),
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
        .withColumn("sink", F.lit(name))
        for name, df in ids.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "kafka_sink",
    sql("requests", """
SELECT "UUID" AS key, CAST(20 AS DOUBLE) + event_id % 60 AS prediction, coalesce(payment_method, '-') AS payment_method
FROM requests"""),
)
def kafka_sink(spark, sf_dir):
    """Responses written as keyed messages to the file stand-in, read back and decoded."""
    path = work_path(spark, "topic")
    number = fixtures.event_number(F.col("UUID"))
    responses = fixtures.requests(spark, sf_dir).select(
        "UUID", (F.lit(20.0) + F.pmod(number, F.lit(60))).alias("prediction"), "payment_method"
    )
    sinks.message_sink("parquet", path)(responses, 0)
    value = F.from_json("value", "prediction double, payment_method string")
    return (
        spark.read.schema("key string, value string")
        .parquet(f"{path}/batch_id=0")
        .select("key", value.alias("v"))
        .select("key", "v.prediction", F.coalesce("v.payment_method", F.lit("-")).alias("payment_method"))
    )


@query(
    "document_sink",
    sql("requests", """
SELECT "UUID", strftime(order_date_and_time, '%Y-%m-%dT%H:%M:%S') AS order_date_and_time, event_id % 2 AS batch
FROM requests"""),
)
def document_sink(spark, sf_dir):
    """Two batches, the first of them written twice as after a restart: no row is doubled."""
    path = work_path(spark, "collection")
    write = sinks.document_sink(path)
    requests = fixtures.requests(spark, sf_dir).select("UUID", "order_date_and_time").withColumn(
        "batch", F.pmod(fixtures.event_number(F.col("UUID")), F.lit(2))
    )
    for epoch in (0, 0, 1):
        write(requests.where(F.col("batch") == epoch), epoch)
    return (
        spark.read.schema("UUID string, order_date_and_time string, batch bigint")
        .json(path)
        .select("UUID", "order_date_and_time", "batch")
    )


@query(
    "dead_letter",
    sql("requests", """
SELECT CAST(0 AS BIGINT) AS epoch_id, 'message is not a request with an id' AS error, 'not json ' || "UUID" AS note
FROM requests WHERE event_id % 10 = 3"""),
)
def dead_letter(spark, sf_dir):
    """Messages that are no requests, with their raw text, as the stream sets them aside."""
    session = stream_session(spark)
    requests = fixtures.requests_from_events(_event_stream(session, sf_dir))
    broken = F.pmod(fixtures.event_number(F.col("key")), F.lit(10)) == 3
    messages = documents.request_kv_encode(requests).withColumn(
        "value", F.when(broken, F.concat(F.lit("not json "), "key")).otherwise(F.col("value"))
    )
    rejects = work_path(spark, "rejects")
    scoring.start_scoring(
        messages,
        trained(spark, sf_dir).model,
        [],
        checkpoint=work_path(spark, "rejects-checkpoint"),
        errors=work_path(spark, "errors"),
        rejects=rejects,
        available_now=True,
    ).awaitTermination()
    return (
        spark.read.schema("epoch_id bigint, error string, note string")
        .json(rejects)
        .select("epoch_id", "error", "note")
    )
