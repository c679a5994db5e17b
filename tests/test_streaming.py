from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tiffin.catalog.models import KEYS, training_rows
from tiffin.operators.matching import response_within_timeout
from tiffin.plans import training
from tiffin.session import stream_session
from tiffin.sources.messages import decode_requests, request_source
from tiffin.streaming import dedup, ledger, scoring, sinks, waiting

DAY = dt.datetime(2024, 1, 1)


def message(uuid, hour=15, minute=0, second=0, **more):
    time = DAY.replace(hour=hour, minute=minute, second=second)
    body = {"UUID": uuid, "order_date_and_time": time.isoformat() + "Z", "order_value": 10.0, **more}
    return uuid or "", json.dumps(body)


@pytest.fixture(scope="module")
def session(spark):
    return stream_session(spark, state_partitions=2)


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return training.train(training_rows(spark, sf_dir), KEYS, max_depth=2, max_iter=2).model


def send(spark, path, messages):
    """Put one more file of messages into the topic stand-in."""
    df = spark.createDataFrame(messages, "key string, value string")
    df.coalesce(1).write.mode("append").json(path)


def run(df, out, checkpoint):
    query = (
        df.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def dropped_late(query):
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def state_rows(query):
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1]


def test_late_rows_are_dropped_and_counted(spark, session, folder):
    topic, out, checkpoint = f"{folder}/topic", f"{folder}/out", f"{folder}/checkpoint"

    def stream():
        requests = decode_requests(request_source(session, "json", topic, maxFilesPerTrigger="1"))
        return dedup.dedup_uuid_bounded(dedup.with_late_limit(requests)).select("UUID")

    send(spark, topic, [message("a", 15)])
    send(spark, topic, [message("b", 20)])
    run(stream(), out, checkpoint)
    without_time = ("n", '{"UUID":"n"}')
    send(spark, topic, [message("c", 9), message("d", 19, 0, 0), message("e", 19, 0, 1), without_time])
    query = run(stream(), out, checkpoint)
    assert dropped_late(query) == 2
    got = {r[0] for r in spark.read.parquet(out).collect()}
    assert got == {"a", "b", "e", "n"}


def test_restart_goes_on_without_repeats(spark, session, folder):
    topic, out, checkpoint = f"{folder}/topic", f"{folder}/out", f"{folder}/checkpoint"
    send(spark, topic, [message("a"), message("a"), message("b")])

    def stream():
        requests = decode_requests(request_source(session, "json", topic))
        return dedup.dedup_uuid(dedup.with_late_limit(requests)).select("UUID")

    run(stream(), out, checkpoint)
    run(stream(), out, checkpoint)
    send(spark, topic, [message("b", 15, 30), message("c", 15, 30)])
    run(stream(), out, checkpoint)
    assert sorted(r[0] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


@pytest.mark.parametrize("spread", [1, 4])
def test_bounded_state_is_let_go(spark, session, folder, spread):
    topic, out, checkpoint = f"{folder}/topic", f"{folder}/out", f"{folder}/checkpoint"

    def stream(step):
        requests = decode_requests(request_source(session, "json", topic))
        return step(dedup.with_late_limit(requests), spread=spread).select("UUID")

    send(spark, topic, [message(f"a{i}", 1) for i in range(20)] * 3)
    run(stream(dedup.dedup_uuid_bounded), out, checkpoint)
    send(spark, topic, [message("z", 20)])
    run(stream(dedup.dedup_uuid_bounded), out, checkpoint)
    query = run(stream(dedup.dedup_uuid_bounded), out, checkpoint)
    send(spark, topic, [message("y", 20)])
    query = run(stream(dedup.dedup_uuid_bounded), out, checkpoint)
    assert state_rows(query) <= 2
    assert spark.read.parquet(out).count() == 22


def test_far_future_does_not_move_the_watermark(spark):
    df = spark.createDataFrame([(DAY,), (dt.datetime(9999, 1, 1),), (None,)], "order_date_and_time timestamp")
    got = [r["event_ts"] for r in dedup.guarded_event_time(df).collect()]
    assert got == [DAY, None, None]


def scored_run(spark, session, model, folder, sink_list, batch_log=None, shape=scoring.response_with_context):
    query = scoring.start_scoring(
        request_source(session, "json", f"{folder}/topic"),
        model,
        sink_list,
        checkpoint=f"{folder}/checkpoint",
        errors=f"{folder}/errors",
        rejects=f"{folder}/rejects",
        available_now=True,
        shape=shape,
        batch_log=batch_log,
    )
    query.awaitTermination()


def all_sinks(folder):
    return [
        sinks.Sink("search", sinks.search_sink(f"{folder}/search"), on_error="continue"),
        sinks.Sink("messages", sinks.message_sink("json", f"{folder}/messages")),
        sinks.Sink("documents", sinks.document_sink(f"{folder}/documents")),
    ]


MIXED = [
    message("a", discounts_and_offers="10%"), message("a", discounts_and_offers="10%"),
    message("b", payment_method="card"), ("x", "not json"), ("x", "not json"), message(None), message(" "),
]


def test_scoring_writes_all_sinks_and_sets_rejects_aside(spark, session, model, folder):
    send(spark, f"{folder}/topic", MIXED)
    log = scoring.BatchLog()
    scored_run(spark, session, model, folder, all_sinks(folder), log)
    documents = spark.read.json(f"{folder}/documents").collect()
    assert sorted(d["UUID"] for d in documents) == ["a", "b"]
    assert {d["UUID"]: d["payment_method_ctx"] for d in documents} == {"a": "unknown", "b": "card"}
    assert all(d["prediction"] is not None and d["@timestamp"] for d in documents)
    assert sorted(r[0] for r in spark.read.json(f"{folder}/messages").select("key").collect()) == ["a", "b"]
    assert spark.read.text(f"{folder}/search").count() == 4
    rejects = spark.read.json(f"{folder}/rejects").collect()
    assert len(rejects) == 4 and [r["note"] for r in rejects].count("not json") == 2
    assert log.counts[0] == {"batch_id": 0, "rows_in": 6, "rows_scored": 2, "rows_rejected": 4}


def test_document_shape(spark, session, model, folder):
    send(spark, f"{folder}/topic", [message("a", 21)])
    scored_run(spark, session, model, folder, all_sinks(folder)[2:], shape=scoring.response_document)
    row = spark.read.json(f"{folder}/documents").first()
    assert (row["day_of_week"], row["hour_of_day"], row["es_fin_de_semana"], row["es_hora_punta"]) == (2, 21, 0, 1)
    assert row["order_date_and_time"] == "2024-01-01T21:00:00" and row["@ingest_ts"]


def test_a_failing_search_sink_does_not_stop_the_others(spark, session, model, folder):
    def broken(df, epoch):
        raise OSError("search is down")

    send(spark, f"{folder}/topic", MIXED)
    sink_list = all_sinks(folder)
    sink_list[0].write = broken
    scored_run(spark, session, model, folder, sink_list)
    assert spark.read.json(f"{folder}/documents").where("UUID IS NOT NULL").count() == 2
    error = spark.read.json(f"{folder}/errors").first()
    assert (error["epoch_id"], error["error"], error["note"]) == (0, "search is down", "sink search")


def test_a_failing_required_sink_stops_the_batch_and_a_restart_repeats_it(spark, session, model, folder):
    def broken(df, epoch):
        raise OSError("topic is down")

    send(spark, f"{folder}/topic", MIXED)
    sink_list = all_sinks(folder)
    good = sink_list[1].write
    sink_list[1].write = broken
    with pytest.raises(Exception, match="topic is down"):
        scored_run(spark, session, model, folder, sink_list)
    errors = spark.read.json(f"{folder}/errors").collect()
    assert [e["note"] for e in errors] == ["sink messages"]
    sink_list[1].write = good
    scored_run(spark, session, model, folder, sink_list)
    assert spark.read.json(f"{folder}/documents").count() == 2
    assert spark.read.json(f"{folder}/messages").count() == 2
    assert spark.read.text(f"{folder}/search").count() == 4


def test_empty_batches_write_nothing(spark, session, model, folder):
    written = []
    process = scoring.batch_scorer(
        model, [sinks.Sink("any", lambda df, epoch: written.append(epoch))], f"{folder}/errors", f"{folder}/rejects"
    )
    empty = spark.createDataFrame([("k", "v")], "key string, value string").where("false")
    from tiffin.sources.messages import decode_with_source

    process(decode_with_source(empty).withColumn("rejected", F.lit(False)), 0)
    assert written == []


def test_batch_and_stream_give_the_same_predictions(spark, session, model, folder, sf_dir):
    from tiffin.operators.documents import request_kv_encode
    from tiffin.sources import fixtures

    requests = fixtures.requests(spark, sf_dir)
    request_kv_encode(requests).write.json(f"{folder}/topic")
    scored_run(spark, session, model, folder, all_sinks(folder)[1:2])
    streamed = spark.read.json(f"{folder}/messages").select(
        F.col("key").alias("UUID"), F.get_json_object("value", "$.prediction").cast("double").alias("prediction")
    )
    batch = scoring.score_stream(model, requests).select("UUID", "prediction")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_waiting_streams(spark, session, folder):
    asked, answers = f"{folder}/asked", f"{folder}/answers"
    out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
    base = DAY.replace(hour=10)

    def add(path, rows, schema):
        rows = [(k, base + dt.timedelta(seconds=s), *rest) for k, s, *rest in rows]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    requests, responses = "UUID string, req_ts timestamp", "UUID string, resp_ts timestamp, prediction double"

    def go():
        joined = waiting.await_responses(
            session.readStream.schema(requests).parquet(asked),
            session.readStream.schema(responses).parquet(answers),
        )
        run(joined, out, checkpoint)

    add(asked, [("quick", 0), ("quick", 0), ("slow", 0), ("never", 0)], requests)
    add(answers, [("quick", 5, 1.0), ("quick", 6, 2.0), ("slow", 61, 3.0)], responses)
    go()
    add(asked, [("later", 7200)], requests)
    add(answers, [("later", 7205, 4.0)], responses)
    go()
    go()
    got = {(r["key"], r["status"]) for r in spark.read.parquet(out).collect()}
    assert {("quick", "ok"), ("slow", "queued"), ("never", "queued"), ("later", "ok")} == got
    assert spark.read.parquet(out).where("key = 'quick'").count() == 1


def test_replayed_documents_replace_their_batch(spark, folder):
    write = sinks.document_sink(folder)
    df = spark.createDataFrame([("a", "internal")], "UUID string, _id string")
    write(df, 7)
    write(df, 7)
    rows = spark.read.json(folder)
    assert rows.count() == 1 and "_id" not in rows.columns


def test_kafka_sink_asks_for_its_connector(spark):
    write = sinks.message_sink("kafka", servers="nowhere:1")
    with pytest.raises(Exception, match="(?i)kafka"):
        write(spark.createDataFrame([("a",)], "UUID string"), 0)


def test_scoring_job_end_to_end(spark, model, folder):
    from tiffin.jobs import score_stream

    send(spark, f"{folder}/topic", MIXED)
    training.save_model(model, f"{folder}/model")
    score_stream.main(
        [
            "--source", "json", "--input", f"{folder}/topic", "--model", f"{folder}/none",
            "--fallback-model", f"{folder}/model", "--out", f"{folder}/out",
            "--checkpoint", f"{folder}/checkpoint", "--available-now", "--state-partitions", "2",
            "--option", "maxFilesPerTrigger=10", "--dedup-spread", "2", "--files-per-batch", "1",
        ]
    )
    assert spark.read.json(f"{folder}/out/documents").count() == 2
    assert spark.read.json(f"{folder}/out/rejects").count() == 4
    assert spark.read.json(f"{folder}/out/messages").select(F.input_file_name()).distinct().count() == 1


def test_two_answers_of_one_id_out_of_order_equal_the_batch_form(spark, session, folder):
    requests, responses = "UUID string, req_ts timestamp", "UUID string, resp_ts timestamp, prediction double"
    asks = [("x", 0), ("x", 100), ("x", 100), ("y", 5), (None, 6), (None, 6), ("w", 200), ("v", 59), ("v", 61)]
    answers = [("x", 130, 2.0), ("x", 20, 1.0), ("x", 20, 0.5), ("x", 40, 7.0), ("y", 70, 3.0), ("z", 1, 9.0),
               ("w", 190, 4.0), ("w", 255, 5.0), ("v", 60, 6.0), ("v", 121, None), (None, 7, 1.0)]
    end = 100_000

    def frame(rows, schema):
        return spark.createDataFrame([(k, DAY + dt.timedelta(seconds=s), *rest) for k, s, *rest in rows], schema)

    for portion in range(4):
        last = portion == 3
        asked = [("end", end)] if last else asks[portion::3]
        answered = [("end", end, 0.0)] if last else answers[2 - portion :: 3]
        frame(asked, requests).write.mode("append").parquet(f"{folder}/asked")
        frame(answered, responses).write.mode("append").parquet(f"{folder}/answers")
        told = waiting.settle_responses(
            session.readStream.schema(requests).parquet(f"{folder}/asked"),
            session.readStream.schema(responses).parquet(f"{folder}/answers"),
        )
        query = run(told, f"{folder}/out", f"{folder}/checkpoint")
    got = sorted(map(str, spark.read.parquet(f"{folder}/out").collect()))
    batch = response_within_timeout(frame(asks, requests), frame(answers, responses))
    known = batch.where("key IS NOT NULL").distinct().unionByName(batch.where("key IS NULL"))
    assert got == sorted(map(str, known.collect()))
    # All that is left are the two rows of the last portion.
    assert state_rows(query) <= 6


def test_waits_are_gathered_without_a_call_per_id(spark, session, folder):
    """Many ids, a busy one among them; the state is Spark's own, in few rows."""
    key = "if(id % 2 = 0, 'busy', concat('u', id))"
    asks = spark.range(0, 400, 1, 3).selectExpr(f"{key} as UUID", "timestamp_millis(id * 700) as req_ts")
    answers = spark.range(0, 400, 1, 3).selectExpr(
        f"{key} as UUID", "timestamp_millis(id * 700 + id % 130 * 1000) as resp_ts",
        "if(id % 3 = 0, null, id * 1.0D) as prediction",
    )
    end = spark.range(1).selectExpr("'end' as UUID", "timestamp_seconds(100000) as at", "0.0D as prediction")
    for asked, answered in ((asks, answers.limit(0)), (asks.limit(0), answers),
                            (end.select("UUID", F.col("at").alias("req_ts")),
                             end.select("UUID", F.col("at").alias("resp_ts"), "prediction"))):
        asked.write.mode("append").parquet(f"{folder}/asked")
        answered.write.mode("append").parquet(f"{folder}/answers")
        told = waiting.settle_responses(
            session.readStream.schema(asks.schema).parquet(f"{folder}/asked"),
            session.readStream.schema(answers.schema).parquet(f"{folder}/answers"),
        )
        query = run(told, f"{folder}/out", f"{folder}/checkpoint")
    got = sorted(map(str, spark.read.parquet(f"{folder}/out").collect()))
    assert got == sorted(map(str, response_within_timeout(asks, answers).collect()))
    assert [s["operatorName"] for s in query.recentProgress[-1]["stateOperators"]] == ["stateStoreSave"]


def test_untimed_copies_are_dropped_until_their_mark_expires(spark, session, folder):
    schema = "UUID string, order_date_and_time timestamp, value long"

    def go(rows, hold):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = dedup.with_late_limit(session.readStream.schema(schema).parquet(f"{folder}/in"))
        return run(dedup.dedup_requests(stream, hold_seconds=hold), f"{folder}/out", f"{folder}/checkpoint")

    later = DAY + dt.timedelta(hours=9)
    go([("a", None, 1), ("a", None, 2), ("b", DAY, 3)], 3600)
    go([("a", None, 4), ("c", None, 5)], 3600)
    got = sorted(r["UUID"] for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == ["a", "b", "c"]
    query = go([("d", later, 6)], 3600)
    assert min(s["numRowsTotal"] for s in query.recentProgress[-1]["stateOperators"]) <= 1
    go([("a", None, 7)], 3600)
    got = sorted(r["UUID"] for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == ["a", "a", "b", "c", "d"]


def test_untimed_copies_reduced_in_several_tasks(spark, session, folder):
    schema = "UUID string, order_date_and_time timestamp"
    rows = [(f"u{i % 3}", None) for i in range(60)]
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{folder}/in")
    stream = dedup.with_late_limit(session.readStream.schema(schema).parquet(f"{folder}/in"))
    run(dedup.dedup_requests(stream, spread=3), f"{folder}/out", f"{folder}/checkpoint")
    assert sorted(r["UUID"] for r in spark.read.parquet(f"{folder}/out").collect()) == ["u0", "u1", "u2"]


def test_untimed_marks_share_states(spark, session, folder, monkeypatch):
    monkeypatch.setattr(dedup, "MARK_BUCKETS", 4)
    schema = "UUID string, order_date_and_time timestamp"
    rows = [(f"u{i}", None) for i in range(50)] + [(None, None)]

    def go(more=()):
        spark.createDataFrame([*rows, *more], schema).write.mode("append").parquet(f"{folder}/in")
        stream = dedup.with_late_limit(session.readStream.schema(schema).parquet(f"{folder}/in"))
        return run(dedup.dedup_requests(stream), f"{folder}/out", f"{folder}/checkpoint")

    def of_marks(query):
        last = query.recentProgress[-1]["stateOperators"]
        return sum(s["numRowsTotal"] for s in last if s["operatorName"].startswith("transformWithState"))

    for number in range(2):
        query = go()
        assert sorted(str(r["UUID"]) for r in spark.read.parquet(f"{folder}/out").collect()) == sorted(
            str(r[0]) for r in rows)
        assert 4 <= of_marks(query) <= 12  # four states, each with a timer
    query = go([("t", DAY)])
    go([("t2", DAY + dt.timedelta(hours=9))])
    go()
    assert spark.read.parquet(f"{folder}/out").where("UUID = 'u7'").count() == 2


def test_late_rows_are_written_once_after_a_restart(spark, folder):
    def writer(path):
        return lambda df, epoch: df.write.mode("overwrite").parquet(f"{path}/batch_id={epoch}")

    split = ledger.late_splitter(
        dt.timedelta(hours=1), writer(f"{folder}/on-time"), writer(f"{folder}/late"), f"{folder}/reached")
    schema = "UUID string, order_date_and_time timestamp"
    batches = [
        [("a", DAY + dt.timedelta(hours=5)), ("b", DAY)], [("c", DAY + dt.timedelta(hours=4)), ("n", None)],
        [("d", DAY + dt.timedelta(hours=4, seconds=1)), ("e", DAY)],
    ]
    for epoch in (0, 1, 1, 2, 1, 2):
        split(spark.createDataFrame(batches[epoch], schema), epoch)
    assert sorted(r[0] for r in spark.read.parquet(f"{folder}/late").select("UUID").collect()) == ["c", "e"]
    on_time = sorted(r[0] for r in spark.read.parquet(f"{folder}/on-time").select("UUID").collect())
    assert on_time == ["a", "b", "d", "n"]


def test_the_ledger_keeps_every_batch_once(spark, folder):
    counted = ledger.BatchLedger(spark, f"{folder}/batches")
    assert counted.counts().count() == 0
    for epoch, n in ((0, 5), (1, 6), (1, 7)):
        counted.add(epoch, {"rows_in": n, "rows_scored": n, "rows_rejected": 0})
    assert {(r["batch_id"], r["rows_in"]) for r in counted.counts().collect()} == {(0, 5), (1, 7)}


def test_a_committed_batch_is_not_written_again(spark, model, folder):
    from tiffin.sources.messages import decode_with_source

    written = []
    process = scoring.batch_scorer(
        model, [sinks.Sink("any", lambda df, epoch: written.append(epoch))], f"{folder}/errors",
        commits=f"{folder}/commits")
    batch = decode_with_source(spark.createDataFrame(MIXED[:1], "key string, value string"))
    for epoch in (0, 0, 1):
        process(batch.withColumn("rejected", F.lit(False)), epoch)
    assert written == [0, 1]


def test_failed_rows_wait_for_replay(spark, folder):
    df = spark.createDataFrame([("a", 1.0)], "UUID string, prediction double")
    good = sinks.document_sink(f"{folder}/documents")

    def broken(df, epoch):
        raise OSError("down")

    paths = (f"{folder}/held", f"{folder}/errors")
    for _ in range(2):
        sinks.fan_out(df, 3, [sinks.Sink("a sink", broken, "continue")], paths[1], paths[0])
    assert sinks.failures(spark, paths[1]).count() == 1
    assert sinks.replay(spark, *paths, [sinks.Sink("a sink", broken)]) == {}
    assert sinks.failures(spark, paths[1]).count() == 1
    assert sinks.replay(spark, *paths, [sinks.Sink("a sink", good)]) == {"a sink": [3]}
    assert spark.read.json(f"{folder}/documents").count() == 1
    assert sinks.failures(spark, paths[1]).count() == 0
    assert sinks.replay(spark, *paths, [sinks.Sink("a sink", good)]) == {}
