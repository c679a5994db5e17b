from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tiffin.operators import clean, columns
from tiffin.schemas import COLUMN_SPELLINGS


def test_missing_columns_are_all_named(spark):
    df = spark.createDataFrame([(1.0, "x")], "`Order Value` double, other string")
    with pytest.raises(ValueError) as error:
        columns.canonical_columns(df)
    text = str(error.value)
    assert "Delivery Fee" in text and "payment_method" in text
    assert "other" in text and "Order Value / order_value" not in text


def test_spelling_order_decides(spark):
    df = spark.createDataFrame([(1, 2)], "order_date int, ORDER_DATETIME int")
    found = columns.resolve_columns(df, COLUMN_SPELLINGS)
    assert found["order_date_and_time"] == "ORDER_DATETIME"
    assert found["refunds/chargebacks"] is None


def test_optional_column_gets_its_default(spark):
    names = [s[0] for w, s in COLUMN_SPELLINGS.items() if w != "refunds/chargebacks"]
    df = spark.range(1).select(*[F.lit("1").alias(n) for n in names])
    row = columns.canonical_columns(df).first()
    assert row["refunds/chargebacks"] == 0.0


def test_repeated_names_are_numbered(spark):
    df = spark.range(1).select(
        F.lit(1).alias("refunded"), F.lit(2).alias(" Refunded "), F.lit(3).alias("REFUNDED"),
        F.lit(4).alias("Discount Value"),
    )
    out = columns.normalise_names(df)
    assert out.columns == ["refunded", "refunded_1", "refunded_2", "discount_value"]
    assert tuple(out.first()) == (1, 2, 3, 4)


def test_projection_has_no_column_twice(spark):
    df = spark.range(1).select(
        F.lit("u").alias("UUID"), F.lit(1).alias("a"), F.lit("p").alias("payment_method"),
        F.lit("d").alias("discounts_and_offers"),
    )
    out = columns.project_features(
        df, ["a"], ["UUID", "payment_method", "discounts_and_offers"],
        ["payment_method", "discounts_and_offers"],
    )
    assert out.columns == ["UUID", "payment_method", "discounts_and_offers", "a"]


def test_defaults_only_fill_what_is_there(spark):
    df = spark.createDataFrame([(None, None, None)], "payment_method string, order_value_dbl double, x string")
    assert tuple(clean.fill_null_defaults(df).first()) == ("unknown", 0.0, None)


def test_first_form_rules(spark):
    now = F.lit("2024-03-01 10:00:00").cast("timestamp")
    df = spark.createDataFrame(
        [("7", "2.5", "", ""), ("3.5", "abc", None, "2024-01-01T00:00:00"), ("", None, "9", None)],
        "delivery_fee string, order_value string, commission_fee string, order_date_and_time string",
    )
    rows = clean.normalise_requests(df, now).collect()
    assert [r["delivery_fee"] for r in rows] == [7, None, None]
    assert [r["order_value"] for r in rows] == [2.5, None, None]
    assert [r["commission_fee"] for r in rows] == [None, None, 9]
    assert [r["invalid"] for r in rows] == [False, True, False]
    assert [r["order_date_and_time"] for r in rows] == [
        "2024-03-01T10:00:00", "2024-01-01T00:00:00", "2024-03-01T10:00:00",
    ]
    assert len({r["UUID"] for r in rows}) == 3


def test_first_form_truncates_numbers(spark):
    df = spark.createDataFrame([(3.9, -3.9)], "delivery_fee double, commission_fee double")
    df = df.withColumn("order_date_and_time", F.lit("x"))
    row = clean.normalise_requests(df).first()
    assert (row["delivery_fee"], row["commission_fee"]) == (3, -3)


def test_second_form_rules(spark):
    fields = [
        "UUID", "customer_id", "restaurant_id", "order_date_and_time", "order_value", "delivery_fee",
        "payment_method", "discounts_and_offers", "commission_fee", "payment_processing_fee",
        "refunds/chargebacks",
    ]
    schema = ", ".join(f"`{f}` string" for f in fields)
    df = spark.createDataFrame(
        [("u1", None, "r", "", " 1e2 ", "10d", "", "x", "", None, ".5"), ("", "c", "r", "t", "1", "1", "a", "b", "1", "1", "1")],
        schema,
    )
    first, second = clean.normalise_form(df).collect()
    assert first["UUID"] == "u1" and second["UUID"].startswith("req-")
    assert first["customer_id"] == "" and first["order_date_and_time"] is None
    assert first["payment_method"] is None and first["discounts_and_offers"] == "x"
    assert [first[c] for c in clean.FORM_AMOUNTS] == [100.0, 0.0, 0.0, 0.0, 0.5]


def test_null_labels_are_dropped(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "delivery_duration_min double")
    assert clean.drop_null_label(df).count() == 1


def test_training_and_serving_features_agree(spark, sf_dir):
    """The same order gives the same features, as a CSV row and as a JSON request."""
    from tiffin.operators.documents import request_kv_encode
    from tiffin.plans.features import build_features, build_training_rows, canonical_fixture
    from tiffin.schemas import CATEGORY_FEATURES, NUMERIC_FEATURES, REQUEST_SCHEMA
    from tiffin.sources import fixtures
    from tiffin.sources.messages import decode_requests

    orders = canonical_fixture(fixtures.delivery_orders(spark, sf_dir)).withColumn(
        "UUID", F.concat_ws("-", "order_id", "line_no", "l_partkey", "restaurant_id", "order_value")
    )
    names = ["UUID", *NUMERIC_FEATURES, *CATEGORY_FEATURES]
    text = orders.withColumns(
        {
            "order_date_and_time": F.date_format("order_date_and_time", "yyyy-MM-dd HH:mm:ss"),
            "delivery_date_and_time": F.date_format("delivery_date_and_time", "yyyy-MM-dd HH:mm:ss"),
            "order_value": F.concat(F.lit("$"), F.col("order_value").cast("decimal(18,2)")),
        }
    )
    trained = build_training_rows(text).select(*names)
    requests = orders.select(*[F.col(f"`{f.name}`") for f in REQUEST_SCHEMA.fields])
    served = build_features(decode_requests(request_kv_encode(requests))).select(*names)
    assert trained.exceptAll(served).count() == 0
    assert served.exceptAll(trained).count() == 0


def test_features_of_an_empty_request(spark):
    from tiffin.plans.features import build_features
    from tiffin.schemas import REQUEST_SCHEMA

    df = spark.createDataFrame([tuple(["u"] + [None] * 10)], REQUEST_SCHEMA)
    row = build_features(df).first()
    assert (row["day_of_week"], row["hour_of_day_str"]) == ("unknown", "0")
    assert (row["payment_method"], row["discounts_and_offers"]) == ("unknown", "none")
    assert (row["has_discount"], row["discount_value"], row["refunded"]) == (0, 0.0, 0)
    assert row["order_value_dbl"] == 0.0 and row["refunds_chargebacks_dbl"] == 0.0
    assert isinstance(row["order_date_and_time"], (dt.datetime, type(None)))
