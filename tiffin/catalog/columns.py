"""Column resolution, projection, filtering and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tiffin.catalog.registry import query
from tiffin.catalog.views import sql
from tiffin.operators import clean, columns
from tiffin.plans.features import build_features, build_training_rows, canonical_fixture
from tiffin.schemas import COLUMN_SPELLINGS, NUMERIC_FEATURES
from tiffin.sources import fixtures

LINE = ["order_id", "line_no", "l_partkey", "restaurant_id"]
LINE_SQL = ", ".join(LINE)

SPACED_NAMES = {
    "order_ts": "ORDER DATE AND TIME",
    "delivery_ts": "Delivery Date and Time",
    "order_value": "Order Value",
    "delivery_fee": "delivery_fee",
    "payment_method": "Payment Method",
    "discounts_and_offers": "discounts_offers",
    "commission_fee": "Commission Fee",
    "payment_processing_fee": "Payment Processing Fee",
    "refunds": "Refunds/Chargebacks",
}


def spaced_orders(spark, sf_dir):
    """The delivered orders under the mixed spellings that raw files use."""
    return fixtures.delivery_orders(spark, sf_dir).withColumnsRenamed(SPACED_NAMES)


@query(
    "resolve_columns",
    sql("orders", f"""
SELECT {LINE_SQL}, order_ts AS order_date_and_time, delivery_ts AS delivery_date_and_time, order_value,
  delivery_fee, payment_method, discounts_and_offers, commission_fee, payment_processing_fee,
  refunds AS "refunds/chargebacks" FROM delivery_orders"""),
)
def resolve_columns(spark, sf_dir):
    return columns.canonical_columns(spaced_orders(spark, sf_dir), keep=LINE)


@query(
    "ensure_or_default",
    sql("orders", f"""
SELECT {LINE_SQL}, order_value, CAST(0 AS DOUBLE) AS "refunds/chargebacks" FROM delivery_orders"""),
)
def ensure_or_default(spark, sf_dir):
    orders = spaced_orders(spark, sf_dir).select(*LINE, F.col("`Order Value`"))
    for name, default in (("order_value", 0.0), ("refunds/chargebacks", 0.0)):
        orders = columns.ensure_or_default(orders, name, COLUMN_SPELLINGS[name], default)
    return orders


@query(
    "require_columns",
    sql("orders", "SELECT 9 AS found, 0 AS missing, count(*) AS n_rows FROM delivery_orders"),
)
def require_columns(spark, sf_dir):
    orders = spaced_orders(spark, sf_dir)
    found = columns.require_columns(orders, COLUMN_SPELLINGS)
    return orders.select(*[F.col(columns.quoted(c)) for c in found.values()]).agg(
        F.lit(len(found)).alias("found"),
        F.lit(len(COLUMN_SPELLINGS) - len(found)).alias("missing"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@query(
    "quoted_column",
    sql("orders", f"""
SELECT {LINE_SQL}, refunds AS with_slash, order_value AS with_space, delivery_fee AS with_brackets,
  commission_fee AS with_tick FROM delivery_orders"""),
)
def quoted_column(spark, sf_dir):
    orders = fixtures.delivery_orders(spark, sf_dir).withColumnsRenamed(
        {
            "refunds": "refunds/chargebacks",
            "order_value": "order value",
            "delivery_fee": "fee (local).x",
            "commission_fee": "a`b",
        }
    )
    return orders.select(
        *LINE,
        F.col(columns.quoted("refunds/chargebacks")).alias("with_slash"),
        F.col(columns.quoted("order value")).alias("with_space"),
        F.col(columns.quoted("fee (local).x")).alias("with_brackets"),
        F.col(columns.quoted("a`b")).alias("with_tick"),
    )


@query(
    "normalise_column_names",
    sql("finance", f"""
SELECT order_id, line_no, l_partkey, restaurant_id, order_value, refunds > 0 AS refunded,
  refunds AS "refunds/chargebacks", refunds > 0 AS refunded_1, delivery_minutes AS "delivery_duration_(min)"
FROM finance"""),
)
def normalise_column_names(spark, sf_dir):
    orders = fixtures.delivery_orders(spark, sf_dir)
    minutes = (F.unix_timestamp("delivery_ts") - F.unix_timestamp("order_ts")) / F.lit(60.0)
    raw = orders.select(
        *LINE,
        F.col("order_value").alias(" Order Value "),
        (F.col("refunds") > 0).alias("refunded"),
        F.col("refunds").alias("Refunds/Chargebacks"),
        (F.col("refunds") > 0).alias("Refunded"),
        minutes.alias("Delivery Duration (min)"),
    )
    return columns.normalise_names(raw)


_FEATURE_SQL = """
round(order_value, 4) AS order_value_dbl, round(delivery_fee, 4) AS delivery_fee_dbl,
round(commission_fee, 4) AS commission_fee_dbl, round(payment_processing_fee, 4) AS payment_processing_fee_dbl,
round(refunds, 4) AS refunds_chargebacks_dbl,
dayname(order_ts) AS day_of_week, CAST(hour(order_ts) AS VARCHAR) AS hour_of_day_str,
CASE WHEN isodow(order_ts) >= 6 THEN 1 ELSE 0 END AS es_fin_de_semana,
CASE WHEN hour(order_ts) IN (13, 14, 15, 20, 21, 22) THEN 1 ELSE 0 END AS es_hora_punta,
CASE WHEN coalesce(trim(lower(discounts_and_offers)), '') IN ('', 'none', 'no discount', 'no discounts')
  THEN 0 ELSE 1 END AS has_discount,
round(discount_value, 4) AS discount_value, CASE WHEN refunds > 0 THEN 1 ELSE 0 END AS refunded,
coalesce(payment_method, 'unknown') AS payment_method, coalesce(discounts_and_offers, 'none') AS discounts_and_offers"""

_AMOUNTS = [
    "order_value_dbl", "delivery_fee_dbl", "commission_fee_dbl", "payment_processing_fee_dbl",
    "refunds_chargebacks_dbl", "discount_value",
]
_FEATURES = [
    *NUMERIC_FEATURES, "day_of_week", "hour_of_day_str", "payment_method", "discounts_and_offers",
]


@query(
    "derive_columns",
    sql("finance", f"SELECT {LINE_SQL}, delivery_minutes AS delivery_duration_min, {_FEATURE_SQL} FROM finance"),
)
def derive_columns(spark, sf_dir):
    rows = build_training_rows(canonical_fixture(fixtures.delivery_orders(spark, sf_dir)))
    return rows.select(*LINE, "delivery_duration_min", *_FEATURES).withColumns(
        {c: F.round(c, 4) for c in _AMOUNTS}
    )


@query(
    "drop_columns",
    sql("orders", "SELECT * EXCLUDE (delivery_ts, refunds, order_ts) FROM delivery_orders"),
)
def drop_columns(spark, sf_dir):
    return fixtures.delivery_orders(spark, sf_dir).drop("delivery_ts", "refunds", "order_ts")


_REQUEST_FEATURE_SQL = """
CASE WHEN isodow(order_date_and_time) >= 6 THEN 1 ELSE 0 END AS es_fin_de_semana,
CASE WHEN hour(order_date_and_time) IN (13, 14, 15, 20, 21, 22) THEN 1 ELSE 0 END AS es_hora_punta,
CASE WHEN coalesce(discounts_and_offers, 'None') = 'None' THEN 0 ELSE 1 END AS has_discount,
round(coalesce(CASE WHEN contains(discounts_and_offers, '%')
  THEN order_value * (CAST(split_part(discounts_and_offers, '%', 1) AS DOUBLE) / 100)
  WHEN contains(discounts_and_offers, 'off') THEN 50 END, 0), 4) AS discount_value,
CASE WHEN "refunds/chargebacks" > 0 THEN 1 ELSE 0 END AS refunded,
coalesce(payment_method, 'unknown') AS payment_method,
coalesce(discounts_and_offers, 'none') AS discounts_and_offers"""


@query(
    "project_features",
    sql("requests", f"""
SELECT "UUID", order_date_and_time, order_value AS order_value_dbl, delivery_fee AS delivery_fee_dbl,
  commission_fee AS commission_fee_dbl, payment_processing_fee AS payment_processing_fee_dbl,
  "refunds/chargebacks" AS refunds_chargebacks_dbl, dayname(order_date_and_time) AS day_of_week,
  CAST(hour(order_date_and_time) AS VARCHAR) AS hour_of_day_str, {_REQUEST_FEATURE_SQL}
FROM requests"""),
)
def project_features(spark, sf_dir):
    features = build_features(fixtures.requests(spark, sf_dir))
    context = ["UUID", "order_date_and_time", "payment_method", "discounts_and_offers"]
    projected = columns.project_features(features, NUMERIC_FEATURES, context)
    return projected.withColumn("discount_value", F.round("discount_value", 4))


@query(
    "context_alias",
    sql("requests", """
SELECT "UUID", payment_method AS payment_method_ctx, discounts_and_offers AS discounts_and_offers_ctx,
  order_date_and_time AS order_date_and_time_ctx FROM requests"""),
)
def context_alias(spark, sf_dir):
    return columns.context_alias(fixtures.requests(spark, sf_dir))


@query(
    "drop_null_label",
    sql("finance", f"""
SELECT {LINE_SQL}, delivery_minutes AS delivery_duration_min FROM finance WHERE l_partkey % 11 <> 0"""),
)
def drop_null_label(spark, sf_dir):
    orders = fixtures.delivery_orders(spark, sf_dir)
    minutes = (F.unix_timestamp("delivery_ts") - F.unix_timestamp("order_ts")) / F.lit(60.0)
    label = F.when(F.pmod("l_partkey", F.lit(11)) != 0, minutes)
    return clean.drop_null_label(orders.select(*LINE, label.alias("delivery_duration_min")))


@query(
    "fill_null_defaults",
    sql("requests", """
SELECT "UUID", coalesce(payment_method, 'unknown') AS payment_method,
  coalesce(discounts_and_offers, 'none') AS discounts_and_offers,
  CASE WHEN event_id % 3 = 0 THEN 'unknown' ELSE dayname(order_date_and_time) END AS day_of_week,
  CASE WHEN event_id % 3 = 0 THEN '0' ELSE CAST(hour(order_date_and_time) AS VARCHAR) END AS hour_of_day_str,
  CASE WHEN event_id % 4 = 0 THEN 0 ELSE order_value END AS order_value_dbl
FROM requests"""),
)
def fill_null_defaults(spark, sf_dir):
    number = fixtures.event_number(F.col("UUID"))
    timed = F.pmod(number, F.lit(3)) != 0
    ts = F.when(timed, F.col("order_date_and_time"))
    rows = fixtures.requests(spark, sf_dir).select(
        "UUID",
        "payment_method",
        "discounts_and_offers",
        F.date_format(ts, "EEEE").alias("day_of_week"),
        F.hour(ts).cast("string").alias("hour_of_day_str"),
        F.when(F.pmod(number, F.lit(4)) != 0, F.col("order_value")).alias("order_value_dbl"),
    )
    return clean.fill_null_defaults(rows)


@query(
    "normalise_requests",
    sql("requests", """
SELECT customer_id, restaurant_id, payment_method, discounts_and_offers,
  strftime(order_date_and_time, '%Y-%m-%dT%H:%M:%S') AS order_date_and_time,
  CASE WHEN event_id % 6 = 5 THEN NULL ELSE event_id % 6 END AS delivery_fee,
  CASE WHEN event_id % 8 = 0 THEN NULL ELSE order_value END AS order_value,
  CAST(trunc(commission_fee) AS BIGINT) AS commission_fee,
  event_id % 8 = 0 OR event_id % 6 = 5 AS invalid
FROM requests"""),
)
def normalise_requests(spark, sf_dir):
    number = fixtures.event_number(F.col("UUID"))
    fee = F.pmod(number, F.lit(6))
    raw = fixtures.requests(spark, sf_dir).select(
        "UUID",
        "customer_id",
        "restaurant_id",
        "payment_method",
        "discounts_and_offers",
        F.date_format("order_date_and_time", "yyyy-MM-dd'T'HH:mm:ss").alias("order_date_and_time"),
        F.when(fee == 5, "3.5").otherwise(fee.cast("string")).alias("delivery_fee"),
        F.when(F.pmod(number, F.lit(8)) == 0, "twelve")
        .otherwise(F.col("order_value").cast("string"))
        .alias("order_value"),
        "commission_fee",
    )
    return clean.normalise_requests(raw).drop("UUID")


@query(
    "normalise_form",
    sql("requests", """
SELECT "UUID", customer_id, CASE WHEN event_id % 4 = 0 THEN '' ELSE restaurant_id END AS restaurant_id,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE strftime(order_date_and_time, '%Y-%m-%dT%H:%M:%S') END
    AS order_date_and_time,
  payment_method, discounts_and_offers,
  CASE WHEN event_id % 8 = 0 THEN 0 ELSE order_value END AS order_value,
  delivery_fee, commission_fee, payment_processing_fee, "refunds/chargebacks"
FROM requests"""),
)
def normalise_form(spark, sf_dir):
    number = fixtures.event_number(F.col("UUID"))
    iso = F.date_format("order_date_and_time", "yyyy-MM-dd'T'HH:mm:ss")
    form = fixtures.requests(spark, sf_dir).select(
        "UUID",
        "customer_id",
        F.when(F.pmod(number, F.lit(4)) != 0, F.col("restaurant_id")).alias("restaurant_id"),
        F.when(F.pmod(number, F.lit(6)) == 0, "").otherwise(iso).alias("order_date_and_time"),
        F.coalesce("payment_method", F.lit("")).alias("payment_method"),
        F.coalesce("discounts_and_offers", F.lit("")).alias("discounts_and_offers"),
        F.when(F.pmod(number, F.lit(8)) == 0, "7f")
        .otherwise(F.col("order_value").cast("string"))
        .alias("order_value"),
        *[
            F.col(c).cast("string").alias(c.strip("`"))
            for c in ("delivery_fee", "commission_fee", "payment_processing_fee", "`refunds/chargebacks`")
        ],
    )
    return clean.normalise_form(form)
