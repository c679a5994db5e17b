"""Reading the free-text offer column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiffin.schemas import DIGIT_RUN, FLAT_DISCOUNT_RATE, NO_DISCOUNT_TEXTS, PERCENT_DIGITS

# What a decimal literal looks like once lower-cased. Spark's own cast is wider (it takes
# `10d` and `7f`), so text is matched against this before it is cast.
NUMBER = (
    r"[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:e[+-]?\d+(?:_\d+)*)?"
    r"|inf(?:inity)?|nan)"
)
# White space in the Unicode sense, spelled out since the regex flag for it is slow.
SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
WHOLE_NUMBER_TEXT = rf"^{SPACE}*({NUMBER}){SPACE}*$"
FIRST_NUMBER_WORD = rf"(?:^|{SPACE})({NUMBER})(?={SPACE}|$)"


def _number(text: Column, pattern: str) -> Column:
    """The double that `pattern` finds in a text, NULL if it finds none."""
    found = F.replace(F.regexp_extract(text, pattern, 1), F.lit("_"), F.lit(""))
    return F.when(found.endswith("nan"), F.lit(float("nan"))).otherwise(found.try_cast("double"))


def discount_percent(offer: Column) -> Column:
    """Digits that stand right before a percent sign."""
    return F.regexp_extract(F.lower(offer), PERCENT_DIGITS, 1).try_cast("double")


def discount_absolute(offer: Column) -> Column:
    """First run of digits anywhere in the text."""
    return F.regexp_extract(F.lower(offer), DIGIT_RUN, 1).try_cast("double")


def discount_value_regex(offer: Column, order_value: Column) -> Column:
    """Share of the order value if a percentage is named, else the amount taken `off`."""
    percent, amount = discount_percent(offer), discount_absolute(offer)
    return (
        F.when(percent.isNotNull(), order_value * (percent / 100.0))
        .when(F.contains(F.lower(offer), F.lit("off")) & amount.isNotNull(), amount)
        .otherwise(F.lit(0.0))
    )


def discount_value_token(offer: Column, order_value: Column) -> Column:
    """Stricter reading: the whole text before `%`, or a whole word, must be a number."""
    text = F.lower(offer)
    before_sign = _number(F.substring_index(text, "%", 1), WHOLE_NUMBER_TEXT)
    first_number = _number(text, FIRST_NUMBER_WORD)
    zero = F.lit(0.0)
    return (
        F.when(
            F.contains(text, F.lit("%")),
            F.when(before_sign.isNull(), zero).otherwise(order_value * (before_sign / 100.0)),
        )
        .when(F.contains(text, F.lit("off")), F.coalesce(first_number, zero))
        .otherwise(zero)
    )


def discount_value_flat(offer: Column, order_value: Column) -> Column:
    """A flat share of the order value whenever an offer is present at all."""
    return F.when(offer.isNotNull(), order_value * FLAT_DISCOUNT_RATE).otherwise(F.lit(0.0))


def has_discount_text(offer: Column) -> Column:
    """0 for the texts that say there is no offer; a missing text counts as an offer."""
    return F.when(F.trim(F.lower(offer)).isin(NO_DISCOUNT_TEXTS), 0).otherwise(1)


def has_discount_not_none(offer: Column) -> Column:
    """Everything but the word `none`, missing text included."""
    return F.coalesce(F.lower(offer) != "none", F.lit(True))


def has_discount_present(offer: Column) -> Column:
    """1 whenever the field is filled, even with `None` or a blank."""
    return F.when(offer.isNotNull(), 1).otherwise(0)


def has_discount(offer: Column) -> Column:
    """The rule of our own jobs: the text rule, with a missing text meaning no offer."""
    return F.when(offer.isNull(), 0).otherwise(has_discount_text(offer))
