from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tiffin.operators import documents, matching
from tiffin.sources.messages import decode_requests, decode_with_source, request_source

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def after(seconds):
    return T0 + dt.timedelta(seconds=seconds)


# -- messages ---------------------------------------------------------------


def test_broken_json_gives_empty_rows(spark):
    texts = ["not json", "", "{}", '{"uuid":"x"}', '{"UUID":7,"order_value":"1.5"}', '{"UUID":"a"}{"UUID":"b"}', None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = decode_requests(df).select("UUID", "order_value").collect()
    assert [r["UUID"] for r in rows] == [None, None, None, None, "7", "a", None]
    assert all(r["order_value"] is None for r in rows)
    assert decode_with_source(df).select("raw_value").collect()[0][0] == "not json"


def test_strict_and_tolerant_decoding(spark):
    value = '{"UUID":"u","order_date_and_time":"2024-05-10T12:34:00.000Z"}'
    df = spark.createDataFrame([(bytearray(value.encode()),)], "value binary")
    assert decode_requests(df).first()["order_date_and_time"] == dt.datetime(2024, 5, 10, 12, 34)
    assert decode_requests(df, strict_time=True).first()["order_date_and_time"] is None


def test_sources_say_what_they_need(spark):
    with pytest.raises(ValueError, match="bootstrap"):
        request_source(spark, "kafka")
    with pytest.raises(ValueError, match="path"):
        request_source(spark, "json")


def test_bulk_lines_are_json(spark):
    df = spark.createDataFrame(
        [("u1", None, after(0.5)), (None, 'say "hi"\nbye', None), ("", "x", after(0))],
        "UUID string, note string, t timestamp",
    )
    values = [r[0] for r in documents.search_bulk(df, "idx").collect()]
    pairs = [tuple(json.loads(line) for line in v.split("\n")) for v in values]
    assert pairs[0][0] == {"index": {"_index": "idx", "_id": "u1"}}
    assert pairs[0][1] == {"UUID": "u1", "note": None, "t": after(0.5).isoformat()}
    assert pairs[1][1]["note"] == 'say "hi"\nbye'
    made = {p[0]["index"]["_id"] for p in pairs[1:]}
    assert len(made) == 2 and all(len(i) == 36 for i in made)


def test_document_rules(spark):
    df = spark.createDataFrame([("u", "CARD", "i")], "UUID string, payment_method string, _id string")
    row = documents.document_normalise(df).first().asDict()
    assert set(row) == {"UUID", "payment_method", "@ingest_ts"}
    assert row["payment_method"] == "card" and row["@ingest_ts"] is not None


def test_mapped_types(spark):
    df = spark.createDataFrame(
        [("9007199254740993", "7.9", "300", 1715344440000, "extra")],
        "order_id string, day_of_week string, es_hora_punta string, order_date_and_time long, other string",
    )
    out = documents.document_schema_cast(df)
    assert out.columns == ["order_id", "order_date_and_time", "day_of_week", "es_hora_punta"]
    assert tuple(out.first()) == (9007199254740993, dt.datetime(2024, 5, 10, 12, 34), 7, None)


def test_sample_as_json(spark):
    from tiffin.sources.tables import sample_json

    df = spark.createDataFrame([(2, None), (1, "x"), (3, "y"), (4, "z")], "a int, b string")
    assert [r[0] for r in sample_json(df, ["a", "b"], ["a"]).collect()] == [
        '{"a":1,"b":"x"}', '{"a":2}', '{"a":3,"b":"y"}',
    ]


def test_audit_row(spark):
    row = documents.request_audit_log(spark.createDataFrame([("u", 1)], "UUID string, a int")).first()
    assert row["request"].asDict() == {"UUID": "u", "a": 1}
    assert row["status"] == "submitted" and row["ts"] is not None


# -- matching ---------------------------------------------------------------


def test_context_join_keeps_rows_without_id(spark):
    left = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 2.0), ("b", 3.0)], "UUID string, prediction double")
    right = spark.createDataFrame([("a", "x"), (None, "y")], "UUID string, ctx string")
    got = sorted((tuple(r) for r in matching.attach_context_left(left, right).collect()), key=str)
    assert got == sorted([("a", 1.0, "x"), (None, 2.0, None), (None, 2.0, None), ("b", 3.0, None)], key=str)


def test_repeated_context_leaves_each_prediction_once(spark):
    left = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "UUID string, prediction double")
    right = spark.createDataFrame(
        [("a", "y", 1), ("a", "x", 2), ("a", "x", 3), ("c", "z", 4)], "UUID string, ctx string, `n.o` int"
    )
    joined = matching.attach_context_left(left, right)
    assert joined.columns == ["UUID", "prediction", "ctx", "n.o"]
    assert sorted(tuple(r) for r in joined.collect()) == [
        ("a", 1.0, "x", 2), ("a", 2.0, "x", 2), ("b", 3.0, None, None)]


def test_lookup_takes_the_first_of_several_responses(spark):
    asked = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "UUID string")
    answers = spark.createDataFrame(
        [("a", after(5), 2.0), ("a", after(1), 1.0), (None, after(0), 9.0)],
        "UUID string, resp_ts timestamp, prediction double",
    )
    got = sorted((tuple(r) for r in matching.response_lookup(asked, answers).collect()), key=str)
    assert got == sorted([("a", "done", 1.0), ("a", "done", 1.0), (None, "pending", None), ("z", "pending", None)], key=str)
    pending = sorted((r[0] for r in matching.pending_requests(asked, answers).collect()), key=str)
    assert pending == sorted([None, "z"], key=str)


def brute_wait(asked, answers, seconds):
    out = []
    for key, ts in asked:
        hits = [
            (rts, p) for k, rts, p in answers
            if key is not None and k == key and ts is not None and ts <= rts <= ts + dt.timedelta(seconds=seconds)
        ]
        out.append((key, ts, "ok" if hits else "queued", min(hits)[1] if hits else None))
    return sorted(out, key=str)


def test_wait_equals_brute_force(spark):
    random.seed(11)
    keys = ["hot"] * 6 + ["a", "b", "c", "", None]
    asked = [(random.choice(keys), after(random.randrange(0, 2400) / 4)) for _ in range(400)]
    asked += [("a", None)]
    answers = [(random.choice(keys), after(random.randrange(0, 2400) / 4), float(i)) for i in range(200)]
    answers = list({(k, t): (k, t, p) for k, t, p in answers}.values())
    got = matching.response_within_timeout(
        spark.createDataFrame(asked, "UUID string, req_ts timestamp"),
        spark.createDataFrame(answers, "UUID string, resp_ts timestamp, prediction double"),
        60,
    )
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_wait(asked, answers, 60)


@pytest.mark.parametrize("gap, status", [(-1, "queued"), (0, "ok"), (60, "ok"), (60.25, "queued"), (61, "queued")])
def test_wait_limits_are_inclusive(spark, gap, status):
    asked = spark.createDataFrame([("a", after(59.5))], "UUID string, req_ts timestamp")
    answers = spark.createDataFrame(
        [("a", after(59.5 + gap), 1.0)], "UUID string, resp_ts timestamp, prediction double"
    )
    assert matching.response_within_timeout(asked, answers).first()["status"] == status
