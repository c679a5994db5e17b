"""Money: cleaning, cost and profit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.schemas import NOT_A_NUMBER_CHARACTERS

# A decimal number as a form field or JSON text may spell it.
DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def clean_money_text(text: Column) -> Column:
    """Drop currency signs and the like; what is left must be a number, else NULL."""
    kept = F.trim(F.regexp_replace(text, NOT_A_NUMBER_CHARACTERS, ""))
    return F.nullif(kept, F.lit("")).try_cast("double")


def money(df: DataFrame, name: str) -> Column:
    """A money column as double.

    Only text is cleaned: writing a double out first would turn 1.0E7 into 1.07.
    """
    column = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, T.NumericType):
        return column.cast("double")
    return clean_money_text(column.cast("string"))


def quoted(name: str) -> str:
    """Back-quoted column name, safe for spaces, slashes, dots and back-quotes."""
    return "`" + name.replace("`", "``") + "`"


def is_refunded(refund: Column) -> Column:
    """Whether money went back; a missing amount is no refund."""
    return F.coalesce(refund > 0, F.lit(False))


def refunded_flag(refund: Column) -> Column:
    return F.when(refund > 0, 1).otherwise(0)


def total_cost(fee: Column, discount: Column, processing: Column, refund: Column) -> Column:
    return fee + discount + processing + refund


def profit(commission: Column, cost: Column) -> Column:
    return commission - cost


def loss_flag(profit_column: Column) -> Column:
    return profit_column < 0


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Scale, round to the even neighbour, scale back: the rounding of array libraries."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def stringify(value: Column) -> Column:
    """Text of a category, with `nan` for a missing one so that it forms a group."""
    return F.coalesce(value.cast("string"), F.lit("nan"))
