"""Names, schemas and fixed values shared by all jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. They define the data contract, so results only match if these do.
# ---------------------------------------------------------------------------

# Request message, all fields nullable.
REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("UUID", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("restaurant_id", T.StringType()),
        T.StructField("order_date_and_time", T.TimestampType()),
        T.StructField("order_value", T.DoubleType()),
        T.StructField("delivery_fee", T.DoubleType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("discounts_and_offers", T.StringType()),
        T.StructField("commission_fee", T.DoubleType()),
        T.StructField("payment_processing_fee", T.DoubleType()),
        T.StructField("refunds/chargebacks", T.DoubleType()),
    ]
)

# Accepted spellings of each input column, best first.
COLUMN_SPELLINGS = {
    "order_date_and_time": [
        "Order Date and Time", "order_date_and_time", "order_datetime", "order_date",
    ],
    "delivery_date_and_time": [
        "Delivery Date and Time", "delivery_date_and_time", "delivery_datetime", "delivery_date",
    ],
    "discounts_and_offers": [
        "Discounts and Offers", "discounts_and_offers", "discounts_offers",
    ],
    "payment_method": ["Payment Method", "payment_method"],
    "order_value": ["Order Value", "order_value"],
    "delivery_fee": ["Delivery Fee", "delivery_fee"],
    "commission_fee": ["Commission Fee", "commission_fee"],
    "payment_processing_fee": ["Payment Processing Fee", "payment_processing_fee"],
    "refunds/chargebacks": [
        "Refunds/Chargebacks", "refunds/chargebacks", "refunds_chargebacks",
    ],
}
OPTIONAL_DEFAULTS = {"refunds/chargebacks": 0.0}

DEFAULT_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
STRICT_JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[XXX][XX][X]"

NOT_A_NUMBER_CHARACTERS = r"[^0-9\\.-]"
PERCENT_DIGITS = r"(\d+)%"
DIGIT_RUN = r"(\d+)"
NO_DISCOUNT_TEXTS = ["", "none", "no discount", "no discounts"]
FLAT_DISCOUNT_RATE = 0.1

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
WEEKEND_NUMBERS = [1, 7]
RUSH_HOURS = [(13, 15), (20, 22)]

TEXT_DEFAULTS = {
    "day_of_week": "unknown",
    "hour_of_day_str": "0",
    "payment_method": "unknown",
    "discounts_and_offers": "none",
}
MONEY_DEFAULTS = {
    "order_value_dbl": 0.0,
    "delivery_fee_dbl": 0.0,
    "commission_fee_dbl": 0.0,
    "payment_processing_fee_dbl": 0.0,
    "refunds_chargebacks_dbl": 0.0,
}

CONTEXT_NAMES = {
    "payment_method": "payment_method_ctx",
    "discounts_and_offers": "discounts_and_offers_ctx",
    "order_date_and_time": "order_date_and_time_ctx",
}

NUMERIC_FEATURES = [
    "order_value_dbl", "delivery_fee_dbl", "commission_fee_dbl", "payment_processing_fee_dbl",
    "refunds_chargebacks_dbl", "discount_value", "has_discount", "refunded",
    "es_fin_de_semana", "es_hora_punta",
]
CATEGORY_FEATURES = ["day_of_week", "hour_of_day_str", "payment_method", "discounts_and_offers"]
# The batch trainer leaves the refunded amount out of its vector and keeps the flag.
TRAINING_NUMERIC_FEATURES = [c for c in NUMERIC_FEATURES if c != "refunds_chargebacks_dbl"]
LABEL = "delivery_duration_min"

# Fields of a search document and their types there.
DOCUMENT_FIELDS = {
    "UUID": "keyword",
    "order_id": "long",
    "prediction": "double",
    "order_date_and_time": "date",
    "@ingest_ts": "date",
    "payment_method": "keyword",
    "discounts_and_offers": "keyword",
    "day_of_week": "integer",
    "hour_of_day": "integer",
    "es_fin_de_semana": "byte",
    "es_hora_punta": "byte",
}
RESPONSE_INDEX = "mydata_prediction_response"
REQUEST_TOPIC = "mydata_prediction_request"
RESPONSE_TOPIC = "mydata_prediction_response"
RESPONSE_WAIT_SECONDS = 60
LATE_LIMIT = "1 hour"
# ---------------------------------------------------------------------------

# One row of the wire form, whichever connector carries it.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
