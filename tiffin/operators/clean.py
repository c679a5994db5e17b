"""Cleaning of requests and feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.functions.ledger import DECIMAL_TEXT, quoted
from tiffin.schemas import LABEL, MONEY_DEFAULTS, TEXT_DEFAULTS

WHOLE_AMOUNTS = ["delivery_fee", "commission_fee", "payment_processing_fee"]
DECIMAL_AMOUNTS = ["order_value", "refunds/chargebacks"]
FORM_AMOUNTS = [
    "order_value", "delivery_fee", "commission_fee", "payment_processing_fee",
    "refunds/chargebacks",
]


def present(df: DataFrame, name: str) -> Column:
    """True where a column has a value; not-a-number counts as missing.

    Plain null tests reach the scan, which the test behind `na.drop` does not; that one also
    keeps a second copy of a computed column inside the join below it.
    """
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNotNull() & ~F.isnan(column)
    return column.isNotNull()


def drop_null_label(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.where(present(df, label))


def fill_null_defaults(df: DataFrame) -> DataFrame:
    """Defaults for missing categories and amounts, where those columns are present."""
    defaults = {**TEXT_DEFAULTS, **MONEY_DEFAULTS}
    return df.na.fill({name: value for name, value in defaults.items() if name in df.columns})


def _whole(df: DataFrame, name: str) -> Column:
    """A whole amount: numbers lose their fraction, text must spell a whole number."""
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, T.NumericType):
        return column.try_cast("bigint")
    return F.when(column.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(column).try_cast("bigint"))


def _decimal(df: DataFrame, name: str) -> Column:
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, T.NumericType):
        return column.cast("double")
    return F.when(column.rlike(DECIMAL_TEXT), F.trim(column).try_cast("double"))


def normalise_requests(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Requests of the first web form: typed amounts, a fresh id, a time if none was given.

    Blank amounts stay missing. A filled amount that cannot be read makes the request
    invalid, which the column `invalid` says; such a request was never accepted.
    """
    now = F.current_timestamp() if now is None else now
    typed = {name: _whole(df, name) for name in WHOLE_AMOUNTS if name in df.columns}
    typed |= {name: _decimal(df, name) for name in DECIMAL_AMOUNTS if name in df.columns}
    invalid = F.lit(False)
    for name, column in typed.items():
        filled = F.coalesce(F.col(quoted(name)).cast("string"), F.lit("")) != ""
        invalid = invalid | (filled & column.isNull())
    ordered = F.col("order_date_and_time")
    blank = F.coalesce(ordered.cast("string"), F.lit("")) == ""
    now_text = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss")
    return df.select(
        F.expr("uuid()").alias("UUID"),
        *[F.col(quoted(c)) for c in df.columns if c not in {*typed, "UUID", "order_date_and_time"}],
        F.when(blank, now_text).otherwise(ordered.cast("string")).alias("order_date_and_time"),
        *[column.alias(name) for name, column in typed.items()],
        invalid.alias("invalid"),
    )


def _form_number(name: str) -> Column:
    """A number as a form script reads it: anything that is not one counts as 0."""
    text = F.col(quoted(name)).cast("string")
    return F.coalesce(
        F.when(text.rlike(DECIMAL_TEXT), F.trim(text).try_cast("double")), F.lit(0.0)
    )


def normalise_form(df: DataFrame) -> DataFrame:
    """Requests of the second web form: blanks to NULL, amounts to 0, the id kept if given."""

    def filled(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(""))

    return df.select(
        F.coalesce(filled("UUID"), F.concat(F.lit("req-"), F.expr("uuid()"))).alias("UUID"),
        F.coalesce("customer_id", F.lit("")).alias("customer_id"),
        F.coalesce("restaurant_id", F.lit("")).alias("restaurant_id"),
        filled("order_date_and_time").alias("order_date_and_time"),
        filled("payment_method").alias("payment_method"),
        filled("discounts_and_offers").alias("discounts_and_offers"),
        *[_form_number(name).alias(name) for name in FORM_AMOUNTS],
    )
