"""The one feature definition that training and serving share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.functions import clock, ledger, offers
from tiffin.operators.clean import fill_null_defaults
from tiffin.schemas import DEFAULT_TIMESTAMP_FORMAT, LABEL

AMOUNTS = {
    "order_value": "order_value_dbl",
    "delivery_fee": "delivery_fee_dbl",
    "commission_fee": "commission_fee_dbl",
    "payment_processing_fee": "payment_processing_fee_dbl",
    "refunds/chargebacks": "refunds_chargebacks_dbl",
}


def as_timestamp(df: DataFrame, name: str, fmt: str = DEFAULT_TIMESTAMP_FORMAT) -> Column:
    """A time column as it comes: parsed if it is text, else only brought to one type."""
    column = F.col(ledger.quoted(name))
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.coalesce(clock.parse_timestamp(column, fmt), clock.parse_iso_timestamp(column))
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return column
    return column.cast("timestamp")


def build_features(df: DataFrame, fmt: str = DEFAULT_TIMESTAMP_FORMAT) -> DataFrame:
    """Feature columns for rows with the canonical request columns.

    Two projections: the first types the inputs, the second derives from them. Batch and
    streaming frames go through the very same expressions. The time column stays as it is
    (typed), so that a watermark set on it still holds.
    """
    typed = df.withColumns(
        {
            "order_date_and_time": as_timestamp(df, "order_date_and_time", fmt),
            **{target: ledger.money(df, source) for source, target in AMOUNTS.items()},
        }
    )
    ts, offer = F.col("order_date_and_time"), F.col("discounts_and_offers")
    hour = clock.hour_of_day(ts)
    derived = typed.withColumns(
        {
            "day_of_week": clock.weekday_name(ts),
            "hour_of_day": hour,
            "hour_of_day_str": hour.cast("string"),
            "es_fin_de_semana": clock.weekend_flag(ts),
            "es_hora_punta": clock.rush_hour_flag(hour),
            "has_discount": offers.has_discount(offer),
            "discount_value": F.coalesce(
                offers.discount_value_regex(offer, F.col("order_value_dbl")), F.lit(0.0)
            ),
            "refunded": ledger.refunded_flag(F.col("refunds_chargebacks_dbl")),
        }
    )
    return fill_null_defaults(derived)


def build_training_rows(df: DataFrame, fmt: str = DEFAULT_TIMESTAMP_FORMAT) -> DataFrame:
    """Features of delivered orders with the delivery minutes as label."""
    label = clock.duration_minutes(
        as_timestamp(df, "order_date_and_time", fmt), as_timestamp(df, "delivery_date_and_time", fmt)
    )
    return build_features(df.withColumn(LABEL, label), fmt)


def canonical_fixture(orders: DataFrame) -> DataFrame:
    """The derived delivery table under the canonical names of the request columns."""
    return orders.withColumnsRenamed(
        {
            "order_ts": "order_date_and_time",
            "delivery_ts": "delivery_date_and_time",
            "refunds": "refunds/chargebacks",
        }
    )


def with_finance(orders: DataFrame) -> DataFrame:
    """Delivered orders with discount value, cost, profit and the analysis columns."""
    offer, refund = F.col("discounts_and_offers"), F.col("refunds")
    return orders.withColumns(
        {
            "delivery_minutes": clock.duration_minutes_exact(F.col("order_ts"), F.col("delivery_ts")),
            "day_of_week": clock.weekday_name(F.col("order_ts")),
            "hour_of_day": clock.hour_of_day(F.col("order_ts")),
            "has_discount": offers.has_discount_not_none(offer),
            "refunded": ledger.is_refunded(refund),
            "discount_value": offers.discount_value_token(offer, F.col("order_value")),
        }
    ).withColumns(
        {
            "total_cost": ledger.total_cost(
                F.col("delivery_fee"), F.col("discount_value"), F.col("payment_processing_fee"), refund
            ),
        }
    ).withColumns({"profit": ledger.profit(F.col("commission_fee"), F.col("total_cost"))})
