"""Files, messages, documents and request/response matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from tiffin.catalog.columns import LINE, LINE_SQL
from tiffin.catalog.registry import query
from tiffin.catalog.views import sql
from tiffin.functions.ledger import quoted
from tiffin.operators import columns, documents, matching
from tiffin.schemas import DEFAULT_TIMESTAMP_FORMAT, RESPONSE_INDEX
from tiffin.sources import fixtures, tables
from tiffin.sources.messages import decode_requests
from tiffin.session import work_path

# -- files ------------------------------------------------------------------

_CSV_COLUMNS = {
    "order_id": "Order ID",
    "line_no": "Line",
    "l_partkey": "Part",
    "restaurant_id": "Restaurant ID",
    "order_ts": "Order Date and Time",
    "delivery_ts": "Delivery Date and Time",
    "order_value": "Order Value",
    "payment_method": "Payment Method",
    "discounts_and_offers": "Discounts and Offers",
    "refunds": "Refunds/Chargebacks",
}


@query(
    "csv_scan_infer",
    sql("orders", """
SELECT CAST(order_id AS INTEGER) AS order_id, line_no, CAST(l_partkey AS INTEGER) AS l_partkey, restaurant_id,
  order_ts, delivery_ts, order_value, payment_method, discounts_and_offers, refunds FROM delivery_orders"""),
)
def csv_scan_infer(spark, sf_dir):
    path = work_path(spark, "orders-csv")
    orders = fixtures.delivery_orders(spark, sf_dir)
    (
        orders.select(*[F.col(c).alias(header) for c, header in _CSV_COLUMNS.items()])
        .write.option("header", True)
        .option("timestampFormat", DEFAULT_TIMESTAMP_FORMAT)
        .csv(path)
    )
    scanned = tables.read_orders_csv(spark, path)
    return scanned.select(*[F.col(quoted(h)).alias(c) for c, h in _CSV_COLUMNS.items()])


_ORDER_TYPES = [
    ("order_id", "bigint"), ("line_no", "int"), ("l_partkey", "bigint"), ("customer_id", "string"),
    ("restaurant_id", "string"), ("order_ts", "timestamp"), ("delivery_ts", "timestamp"),
    ("order_value", "double"), ("delivery_fee", "double"), ("payment_method", "string"),
    ("discounts_and_offers", "string"), ("commission_fee", "double"),
    ("payment_processing_fee", "double"), ("refunds", "double"),
]


@query(
    "schema_shape",
    sql("orders", f"""
SELECT "position", column_name, data_type, (SELECT count(*) FROM delivery_orders) AS n_rows,
  {len(_ORDER_TYPES)} AS n_columns
FROM (VALUES {', '.join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(_ORDER_TYPES, 1))})
  AS t("position", column_name, data_type)"""),
)
def schema_shape(spark, sf_dir):
    return tables.schema_shape(fixtures.delivery_orders(spark, sf_dir))


@query(
    "sample_rows",
    sql("requests", """
SELECT "UUID", order_date_and_time, payment_method, discounts_and_offers FROM requests
ORDER BY order_date_and_time, "UUID" LIMIT 10"""),
)
def sample_rows(spark, sf_dir):
    names = ["UUID", "order_date_and_time", "payment_method", "discounts_and_offers"]
    requests = fixtures.requests(spark, sf_dir)
    return tables.sample_rows(requests, names, ["order_date_and_time", "UUID"], 10)


# -- messages ---------------------------------------------------------------


@query(
    "json_decode_requests",
    sql("requests", """
, kept AS (SELECT * FROM requests WHERE event_id % 97 <> 0)
SELECT * EXCLUDE (event_id) FROM kept
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM requests WHERE event_id % 97 = 0"""),
)
def json_decode_requests(spark, sf_dir):
    requests = fixtures.requests(spark, sf_dir)
    broken = F.pmod(fixtures.event_number(F.col("key")), F.lit(97)) == 0
    wire = documents.request_kv_encode(requests).withColumn(
        "value", F.when(broken, "not json").otherwise(F.col("value"))
    )
    return decode_requests(wire)


def _responses_with_context(spark, sf_dir):
    """A response row per request, built without a join."""
    number = fixtures.event_number(F.col("UUID"))
    return fixtures.requests(spark, sf_dir).select(
        "UUID",
        (F.lit(20.0) + F.pmod(number, F.lit(60))).alias("prediction"),
        "payment_method",
        F.col("order_date_and_time"),
    )


@query(
    "response_kv_encode",
    sql("requests", """
SELECT "UUID" AS key, '{"UUID":"' || "UUID" || '","prediction":' || CAST(CAST(20 AS DOUBLE) + event_id % 60 AS VARCHAR)
  || CASE WHEN payment_method IS NULL THEN '' ELSE ',"payment_method":"' || payment_method || '"' END
  || ',"order_date_and_time":"' || strftime(order_date_and_time, '%Y-%m-%dT%H:%M:%S') || '.000Z"}' AS value
FROM requests"""),
)
def response_kv_encode(spark, sf_dir):
    return documents.response_kv_encode(_responses_with_context(spark, sf_dir))


@query(
    "request_kv_encode",
    sql("requests", """
SELECT CASE WHEN event_id % 20 = 0 THEN '' ELSE "UUID" END AS key,
  '{' || CASE WHEN event_id % 20 = 0 THEN '' ELSE '"UUID":"' || "UUID" || '",' END
  || '"customer_id":"' || customer_id || '","order_value":' || CAST(order_value AS VARCHAR)
  || CASE WHEN discounts_and_offers IS NULL THEN '' ELSE ',"discounts_and_offers":"' || discounts_and_offers || '"' END
  || ',"refunds/chargebacks":' || CAST("refunds/chargebacks" AS VARCHAR) || '}' AS value
FROM requests"""),
)
def request_kv_encode(spark, sf_dir):
    number = fixtures.event_number(F.col("UUID"))
    requests = fixtures.requests(spark, sf_dir).select(
        F.when(F.pmod(number, F.lit(20)) != 0, F.col("UUID")).alias("UUID"),
        "customer_id", "order_value", "discounts_and_offers", "refunds/chargebacks",
    )
    return documents.request_kv_encode(requests)


@query(
    "search_bulk_ndjson",
    sql("requests", f"""
SELECT '{{"index":{{"_index":"{RESPONSE_INDEX}","_id":"' || "UUID" || '"}}}}' || chr(10)
  || '{{"UUID":"' || "UUID" || '","prediction":' || CAST(CAST(20 AS DOUBLE) + event_id % 60 AS VARCHAR)
  || ',"payment_method":' || coalesce('"' || payment_method || '"', 'null')
  || ',"order_date_and_time":"' || strftime(order_date_and_time, '%Y-%m-%dT%H:%M:%S') || '"}}' AS value
FROM requests"""),
)
def search_bulk_ndjson(spark, sf_dir):
    rows = _responses_with_context(spark, sf_dir).withColumn("_id", F.lit("internal"))
    return documents.search_bulk(rows)


@query(
    "document_normalise",
    sql("requests", """
SELECT "UUID", lower(payment_method) AS payment_method,
  CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE order_date_and_time END AS "@ingest_ts"
FROM requests"""),
)
def document_normalise(spark, sf_dir):
    number = fixtures.event_number(F.col("UUID"))
    rows = fixtures.requests(spark, sf_dir).select(
        "UUID",
        F.upper("payment_method").alias("payment_method"),
        F.when(F.pmod(number, F.lit(3)) != 0, F.col("order_date_and_time")).alias("@ingest_ts"),
        F.lit("internal").alias("_id"),
    )
    fixed_clock = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return documents.document_normalise(rows, now=fixed_clock)


@query(
    "document_schema_cast",
    sql("requests", """
SELECT "UUID", event_id AS order_id, CAST(20 AS DOUBLE) + event_id % 60 AS prediction,
  CASE WHEN event_id % 4 = 3 THEN NULL ELSE order_date_and_time END AS order_date_and_time,
  payment_method, discounts_and_offers,
  CAST(dayofweek(order_date_and_time) + 1 AS INTEGER) AS day_of_week,
  CAST(hour(order_date_and_time) AS INTEGER) AS hour_of_day,
  CAST(CASE WHEN isodow(order_date_and_time) >= 6 THEN 1 ELSE 0 END AS TINYINT) AS es_fin_de_semana
FROM requests"""),
)
def document_schema_cast(spark, sf_dir):
    number = fixtures.event_number(F.col("UUID"))
    ts = F.col("order_date_and_time")
    kind = F.pmod(number, F.lit(4))
    time_text = (
        F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 2, F.unix_millis(ts).cast("string"))
        .otherwise("bad")
    )
    raw = fixtures.requests(spark, sf_dir).select(
        "UUID",
        number.cast("string").alias("order_id"),
        (F.lit(20) + F.pmod(number, F.lit(60))).cast("string").alias("prediction"),
        time_text.alias("order_date_and_time"),
        "payment_method",
        "discounts_and_offers",
        F.concat(F.dayofweek(ts).cast("string"), F.lit(".7")).alias("day_of_week"),
        F.hour(ts).cast("string").alias("hour_of_day"),
        F.when(F.dayofweek(ts).isin(1, 7), 1).otherwise(0).alias("es_fin_de_semana"),
        F.lit("not mapped").alias("customer_note"),
    )
    return documents.document_schema_cast(raw)


@query(
    "iso_timestamps",
    """
SELECT event_id, CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts,
  strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS whole, value
FROM events""",
)
def iso_timestamps(spark, sf_dir):
    events = fixtures.events(spark, sf_dir)
    return documents.iso_timestamps(
        events.select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            F.date_trunc("second", "ts").alias("whole"),
            "value",
        )
    )


@query(
    "request_audit_log",
    sql("requests", """
SELECT "UUID", 'submitted' AS status, "UUID" AS request_uuid, customer_id, order_value, payment_method
FROM requests"""),
)
def request_audit_log(spark, sf_dir):
    log = documents.request_audit_log(fixtures.requests(spark, sf_dir))
    return log.select(
        "UUID", "status", F.col("request.UUID").alias("request_uuid"),
        "request.customer_id", "request.order_value", "request.payment_method",
    )


# -- matching ---------------------------------------------------------------


@query(
    "attach_context_left",
    sql("requests", """
, preds AS (
  SELECT CASE WHEN event_id % 50 = 0 THEN NULL ELSE "UUID" END AS "UUID", CAST(20 AS DOUBLE) + event_id % 60 AS prediction
  FROM requests)
SELECT preds."UUID", prediction, payment_method AS payment_method_ctx,
  discounts_and_offers AS discounts_and_offers_ctx, order_date_and_time AS order_date_and_time_ctx
FROM preds LEFT JOIN requests ON preds."UUID" = requests."UUID" AND event_id % 7 <> 0"""),
)
def attach_context_left(spark, sf_dir):
    number = fixtures.event_number(F.col("UUID"))
    requests = fixtures.requests(spark, sf_dir)
    predictions = requests.select(
        F.when(F.pmod(number, F.lit(50)) != 0, F.col("UUID")).alias("UUID"),
        (F.lit(20.0) + F.pmod(number, F.lit(60))).alias("prediction"),
    )
    context = columns.context_alias(requests.where(F.pmod(number, F.lit(7)) != 0))
    return matching.attach_context_left(predictions, context)


def _asked(spark, sf_dir):
    return fixtures.requests_resent(spark, sf_dir)


@query(
    "response_lookup",
    sql("resent_responses", """
SELECT r."UUID" AS id, CASE WHEN s."UUID" IS NULL THEN 'pending' ELSE 'done' END AS status, prediction
FROM resent r LEFT JOIN responses s USING ("UUID")"""),
)
def response_lookup(spark, sf_dir):
    return matching.response_lookup(_asked(spark, sf_dir), fixtures.responses(spark, sf_dir))


@query(
    "pending_requests",
    sql("resent_responses", """
SELECT "UUID", attempt FROM resent WHERE "UUID" NOT IN (SELECT "UUID" FROM responses)"""),
)
def pending_requests(spark, sf_dir):
    asked = _asked(spark, sf_dir).select("UUID", "attempt")
    return matching.pending_requests(asked, fixtures.responses(spark, sf_dir))


@query(
    "response_within_timeout",
    sql("resent_responses", """
SELECT r."UUID" AS key, r.order_date_and_time AS req_ts,
  CASE WHEN count(s."UUID") > 0 THEN 'ok' ELSE 'queued' END AS status, arg_min(s.prediction, s.resp_ts) AS prediction
FROM resent r LEFT JOIN responses s
  ON r."UUID" = s."UUID" AND s.resp_ts BETWEEN r.order_date_and_time AND r.order_date_and_time + to_seconds(60)
GROUP BY r."UUID", r.attempt, r.order_date_and_time"""),
)
def response_within_timeout(spark, sf_dir):
    asked = _asked(spark, sf_dir).select("UUID", F.col("order_date_and_time").alias("req_ts"))
    return matching.response_within_timeout(asked, fixtures.responses(spark, sf_dir))
