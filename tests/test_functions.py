"""Column functions on edge values."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tiffin.functions import clock, ledger, offers

# text, regex rule, token rule, training flag, serving flag; the order value is 1000
OFFERS = [
    ("10%", 100.0, 100.0, 1, 1),
    ("5% on App", 50.0, 50.0, 1, 1),
    ("50 off Promo", 50.0, 50.0, 1, 1),
    ("12.5%", 50.0, 125.0, 1, 1),
    ("Get 20% off", 200.0, 0.0, 1, 1),
    ("Code7 off", 7.0, 0.0, 1, 1),
    ("None", 0.0, 0.0, 0, 1),
    ("", 0.0, 0.0, 0, 1),
    (" No Discounts ", 0.0, 0.0, 0, 1),
    (None, 0.0, 0.0, 1, 0),
    ("SUMMER10", 0.0, 0.0, 1, 1),
    ("OFF 3", 3.0, 3.0, 1, 1),
    ("7f off 10d 4", 7.0, 4.0, 1, 1),
    ("1_000 off", 1.0, 1000.0, 1, 1),
    ("-5%", 50.0, -50.0, 1, 1),
    (" 5 %", 0.0, 50.0, 1, 1),
    ("off .5e1", 5.0, 5.0, 1, 1),
    ("%5%", 50.0, 0.0, 1, 1),
    ("10d%", 0.0, 0.0, 1, 1),
    ("off 8", 8.0, 8.0, 1, 1),
]


def python_token_rule(text, value):
    """The stricter offer rule, one row at a time."""
    text = "nan" if text is None else text.lower()
    if "%" in text:
        try:
            return value * (float(text[: text.index("%")]) / 100)
        except ValueError:
            return 0.0
    if "off" in text:
        numbers = []
        for word in text.split():
            try:
                numbers.append(float(word))
            except ValueError:
                pass
        return numbers[0] if numbers else 0.0
    return 0.0


def test_offer_rules(spark):
    df = spark.createDataFrame([(i, o[0]) for i, o in enumerate(OFFERS)], "i int, offer string")
    offer, value = F.col("offer"), F.lit(1000.0)
    rows = (
        df.select(
            "i",
            offers.discount_value_regex(offer, value),
            offers.discount_value_token(offer, value),
            offers.has_discount_text(offer),
            offers.has_discount_present(offer),
        )
        .orderBy("i")
        .collect()
    )
    for row, expected in zip(rows, OFFERS):
        assert tuple(row)[1:] == expected[1:], expected[0]
        assert row[2] == python_token_rule(expected[0], 1000.0), expected[0]


def test_token_rule_keeps_infinite_and_not_a_number(spark):
    df = spark.createDataFrame([("inf%",), ("-Infinity off",), ("nan off",)], "o string")
    got = [r[0] for r in df.select(offers.discount_value_token(F.col("o"), F.lit(2.0))).collect()]
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2])


def test_discount_of_an_order_without_value(spark):
    df = spark.createDataFrame([("10%",), ("x%",), ("3 off",), (None,)], "o string")
    none = F.lit(None).cast("double")
    token = [r[0] for r in df.select(offers.discount_value_token(F.col("o"), none)).collect()]
    regex = [r[0] for r in df.select(offers.discount_value_regex(F.col("o"), none)).collect()]
    assert token == [None, 0.0, 3.0, 0.0]
    assert regex == [None, 0.0, 3.0, 0.0]


def test_job_flag_and_flat_rule(spark):
    df = spark.createDataFrame([("None",), (None,), ("x",), ("",)], "o string")
    got = df.select(
        offers.has_discount(F.col("o")),
        offers.has_discount_not_none(F.col("o")),
        offers.discount_value_flat(F.col("o"), F.lit(50.0)),
    ).collect()
    assert [tuple(r) for r in got] == [
        (0, False, 5.0), (0, True, 0.0), (1, True, 5.0), (0, True, 5.0),
    ]


@pytest.mark.parametrize(
    "text, value",
    [
        ("$1,234.50", 1234.5), ("N/A", None), ("", None), ("(5.0)", 5.0), (None, None),
        ("1-2", None), ("-", None), ("1.2.3", None), ("-7 EUR", -7.0), ("1\\2", None), (" 3 ", 3.0),
    ],
)
def test_money_text(spark, text, value):
    df = spark.createDataFrame([(text,)], "m string")
    assert df.select(ledger.money(df, "m")).first()[0] == value


def test_money_numbers_are_not_rewritten(spark):
    df = spark.createDataFrame([(1e7, 5)], "`a/b.c` double, i int")
    assert tuple(df.select(ledger.money(df, "a/b.c"), ledger.money(df, "i")).first()) == (1e7, 5.0)


def test_rounding_is_that_of_array_libraries(spark):
    numpy = pytest.importorskip("numpy")
    values = [0.125, 0.135, 2.675, -0.125, 1.005, 12345.678, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(ledger.round_half_even(F.col("v"))).collect()]
    assert got == [float(numpy.round(v, 2)) for v in values]


def test_refund_and_loss_flags(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,)], "r double")
    got = df.select(ledger.refunded_flag(F.col("r")), ledger.loss_flag(F.col("r"))).collect()
    assert [tuple(r) for r in got] == [(1, False), (0, False), (0, True), (0, None)]


def test_rush_hours(spark):
    df = spark.createDataFrame([(h,) for h in (12, 13, 15, 16, 19, 20, 22, 23)], "h int")
    got = [r[0] for r in df.select(clock.rush_hour_flag(F.col("h"))).collect()]
    assert got == [0, 1, 1, 0, 0, 1, 1, 0]


def test_calendar(spark):
    df = spark.sql("SELECT explode(sequence(timestamp'2024-01-01', timestamp'2024-01-07', interval 1 day)) t")
    ts = F.col("t")
    rows = df.select(
        clock.weekday_name(ts), clock.weekday_number(ts), clock.weekend_flag(ts),
        clock.weekday_position(clock.weekday_name(ts)),
    ).collect()
    assert [r[0] for r in rows][0] == "Monday" and [r[0] for r in rows][-1] == "Sunday"
    assert [r[1] for r in rows] == [2, 3, 4, 5, 6, 7, 1]
    assert [r[2] for r in rows] == [0, 0, 0, 0, 0, 1, 1]
    assert [r[3] for r in rows] == [1, 2, 3, 4, 5, 6, 7]


UTC_NOON = dt.datetime(2024, 5, 10, 12, 34)


@pytest.mark.parametrize(
    "text, tolerant, strict",
    [
        ("2024-05-10T12:34:00Z", UTC_NOON, UTC_NOON),
        ("2024-05-10T12:34:00.000Z", UTC_NOON, None),
        ("2024-05-10T14:34:00+0200", UTC_NOON, UTC_NOON),
        ("2024-05-10T14:34:00+02:00", UTC_NOON, UTC_NOON),
        ("2024-05-10T12:34:00", UTC_NOON, UTC_NOON),
        ("2024-05-10T12:34", UTC_NOON, None),
        ("2024-05-10 12:34:00", UTC_NOON, None),
        ("yesterday", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_iso_times(spark, text, tolerant, strict):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(
        clock.parse_iso_timestamp(F.col("t")), clock.parse_iso_timestamp_strict(F.col("t"))
    ).first()
    assert tuple(row) == (tolerant, strict)


def test_mixed_times_and_iso_text(spark):
    texts = ["1715344440000", "2024-05-10 12:34:00", "bad", "2024-05-10 12:34:00.000000", "2024", "123", "-1000"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(clock.parse_mixed_timestamp(F.col("t"))).collect()]
    assert got == [
        UTC_NOON, UTC_NOON, None, UTC_NOON, dt.datetime(2024, 1, 1),
        dt.datetime(1970, 1, 1, 0, 0, 0, 123000), dt.datetime(1969, 12, 31, 23, 59, 59),
    ]
    times = [UTC_NOON, UTC_NOON.replace(microsecond=250), dt.datetime(1969, 12, 31, 23, 59, 59, 500000)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp")
    assert [r[0] for r in df.select(clock.iso_text(F.col("t"))).collect()] == [
        t.isoformat() for t in times
    ]


def test_durations(spark):
    df = spark.createDataFrame(
        [(UTC_NOON, UTC_NOON + dt.timedelta(minutes=1, milliseconds=1500))], "a timestamp, b timestamp"
    )
    whole, exact = df.select(
        clock.duration_minutes(F.col("a"), F.col("b")),
        clock.duration_minutes_exact(F.col("a"), F.col("b")),
    ).first()
    assert whole == 61 / 60 and exact == 61.5 / 60
