"""Scalar functions over orders and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.catalog.registry import query
from tiffin.catalog.views import sql
from tiffin.functions import clock, ledger, offers
from tiffin.plans.features import with_finance
from tiffin.sources import fixtures

LINE = ["order_id", "line_no", "l_partkey", "restaurant_id"]
LINE_SQL = ", ".join(LINE)


def _orders(spark, sf_dir, **columns) -> DataFrame:
    return fixtures.delivery_orders(spark, sf_dir).select(
        *LINE, *[column.alias(name) for name, column in columns.items()]
    )


def _orders_sql(expressions: str, views: str = "orders", table: str = "delivery_orders") -> str:
    return sql(views, f"SELECT {LINE_SQL}, {expressions} FROM {table}")


def _requests(spark, sf_dir, **columns) -> DataFrame:
    return fixtures.requests(spark, sf_dir).select(
        "UUID", *[column.alias(name) for name, column in columns.items()]
    )


def _requests_sql(expressions: str) -> str:
    return sql("requests", f'SELECT "UUID", {expressions} FROM requests')


# -- numbers in text --------------------------------------------------------

_DIRTY = {
    0: "N/A", 1: "", 2: "1-2", 3: "-", 4: "1.2.3", 5: "(5.0)",
}


@query(
    "money_clean",
    sql("orders", f"""
, texts AS (
  SELECT {LINE_SQL}, order_value, CASE l_partkey % 13
    {' '.join(f"WHEN {k} THEN '{v}'" for k, v in _DIRTY.items())}
    ELSE format('${{:,.2f}}', order_value) END AS money_text
  FROM delivery_orders
)
SELECT {LINE_SQL}, money_text, TRY_CAST(nullif(trim(regexp_replace(money_text, '[^0-9.\\-]', '', 'g')), '') AS DOUBLE)
  AS money, order_value AS money_of_number
FROM texts"""),
)
def money_clean(spark, sf_dir):
    kind = F.pmod("l_partkey", F.lit(13))
    text = F.when(kind == 0, _DIRTY[0])
    for remainder, dirty in list(_DIRTY.items())[1:]:
        text = text.when(kind == remainder, dirty)
    text = text.otherwise(F.concat(F.lit("$"), F.format_number("order_value", 2)))
    orders = fixtures.delivery_orders(spark, sf_dir).withColumn("money_text", text)
    return orders.select(
        *LINE,
        "money_text",
        ledger.money(orders, "money_text").alias("money"),
        ledger.money(orders, "order_value").alias("money_of_number"),
    )


@query(
    "discount_percent",
    _orders_sql(
        "discounts_and_offers,"
        " TRY_CAST(nullif(regexp_extract(lower(discounts_and_offers), '(\\d+)%', 1), '') AS DOUBLE)"
        " AS discount_percent"
    ),
)
def discount_percent(spark, sf_dir):
    offer = F.col("discounts_and_offers")
    return _orders(
        spark, sf_dir, discounts_and_offers=offer, discount_percent=offers.discount_percent(offer)
    )


@query(
    "discount_absolute",
    _orders_sql(
        "TRY_CAST(nullif(regexp_extract(lower(discounts_and_offers), '(\\d+)', 1), '') AS DOUBLE)"
        " AS discount_absolute"
    ),
)
def discount_absolute(spark, sf_dir):
    offer = F.col("discounts_and_offers")
    return _orders(spark, sf_dir, discount_absolute=offers.discount_absolute(offer))


@query(
    "discount_value_regex",
    _orders_sql("""
round(CAST(CASE WHEN regexp_matches(discounts_and_offers, '\\d+%')
  THEN order_value * (CAST(regexp_extract(discounts_and_offers, '(\\d+)%', 1) AS DOUBLE) / 100)
  WHEN contains(lower(discounts_and_offers), 'off') AND regexp_matches(discounts_and_offers, '\\d')
  THEN CAST(regexp_extract(discounts_and_offers, '(\\d+)', 1) AS DOUBLE) ELSE 0 END AS DOUBLE), 4) AS discount_value"""),
)
def discount_value_regex(spark, sf_dir):
    value = offers.discount_value_regex(F.col("discounts_and_offers"), F.col("order_value"))
    return _orders(spark, sf_dir, discount_value=F.round(value, 4))


@query(
    "discount_value_token",
    _orders_sql("""
round(CAST(CASE WHEN contains(discounts_and_offers, '%')
  THEN coalesce(order_value * (TRY_CAST(split_part(discounts_and_offers, '%', 1) AS DOUBLE) / 100), 0)
  WHEN contains(lower(discounts_and_offers), 'off')
  THEN coalesce(list_filter(list_transform(string_split(discounts_and_offers, ' '), lambda w: TRY_CAST(w AS DOUBLE)),
                            lambda x: x IS NOT NULL)[1], 0)
  ELSE 0 END AS DOUBLE), 4) AS discount_value"""),
)
def discount_value_token(spark, sf_dir):
    value = offers.discount_value_token(F.col("discounts_and_offers"), F.col("order_value"))
    return _orders(spark, sf_dir, discount_value=F.round(value, 4))


@query(
    "discount_value_flat",
    _requests_sql("""
round(CASE WHEN discounts_and_offers IS NOT NULL THEN order_value * CAST(0.1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END, 6)
  AS discount_value"""),
)
def discount_value_flat(spark, sf_dir):
    value = offers.discount_value_flat(F.col("discounts_and_offers"), F.col("order_value"))
    return _requests(spark, sf_dir, discount_value=F.round(value, 6))


# -- flags ------------------------------------------------------------------


@query(
    "has_discount_text",
    _orders_sql("""
CASE WHEN trim(lower(discounts_and_offers)) IN ('', 'none', 'no discount', 'no discounts') THEN 0 ELSE 1 END
  AS has_discount"""),
)
def has_discount_text(spark, sf_dir):
    flag = offers.has_discount_text(F.col("discounts_and_offers"))
    return _orders(spark, sf_dir, has_discount=flag)


@query(
    "has_discount_not_none",
    _orders_sql("coalesce(lower(discounts_and_offers) <> 'none', true) AS has_discount"),
)
def has_discount_not_none(spark, sf_dir):
    flag = offers.has_discount_not_none(F.col("discounts_and_offers"))
    return _orders(spark, sf_dir, has_discount=flag)


@query(
    "has_discount_present",
    _requests_sql("CASE WHEN discounts_and_offers IS NULL THEN 0 ELSE 1 END AS has_discount"),
)
def has_discount_present(spark, sf_dir):
    flag = offers.has_discount_present(F.col("discounts_and_offers"))
    return _requests(spark, sf_dir, has_discount=flag)


@query(
    "refunded_flag",
    _orders_sql(
        "CASE WHEN nullif(refunds, CAST(50 AS DOUBLE)) > 0 THEN 1 ELSE 0 END AS refunded_or_missing,"
        " CASE WHEN refunds > 0 THEN 1 ELSE 0 END AS refunded"
    ),
)
def refunded_flag(spark, sf_dir):
    gaps = F.nullif(F.col("refunds"), F.lit(50.0))
    return _orders(
        spark,
        sf_dir,
        refunded_or_missing=ledger.refunded_flag(gaps),
        refunded=ledger.refunded_flag(F.col("refunds")),
    )


@query(
    "weekend_flag",
    _orders_sql("CASE WHEN isodow(order_ts) >= 6 THEN 1 ELSE 0 END AS es_fin_de_semana"),
)
def weekend_flag(spark, sf_dir):
    return _orders(spark, sf_dir, es_fin_de_semana=clock.weekend_flag(F.col("order_ts")))


@query(
    "rush_hour_flag",
    _orders_sql(
        "CASE WHEN hour(order_ts) IN (13, 14, 15, 20, 21, 22) THEN 1 ELSE 0 END AS es_hora_punta"
    ),
)
def rush_hour_flag(spark, sf_dir):
    return _orders(spark, sf_dir, es_hora_punta=clock.rush_hour_flag(F.hour("order_ts")))


# -- time -------------------------------------------------------------------


@query("weekday_name", _orders_sql("dayname(order_ts) AS day_of_week"))
def weekday_name(spark, sf_dir):
    return _orders(spark, sf_dir, day_of_week=clock.weekday_name(F.col("order_ts")))


@query("weekday_number", _orders_sql("CAST(dayofweek(order_ts) + 1 AS INTEGER) AS day_of_week_num"))
def weekday_number(spark, sf_dir):
    return _orders(spark, sf_dir, day_of_week_num=clock.weekday_number(F.col("order_ts")))


@query(
    "hour_of_day",
    _orders_sql(
        "CAST(hour(order_ts) AS INTEGER) AS hour_of_day, CAST(hour(order_ts) AS VARCHAR) AS hour_of_day_str"
    ),
)
def hour_of_day(spark, sf_dir):
    hour = clock.hour_of_day(F.col("order_ts"))
    return _orders(spark, sf_dir, hour_of_day=hour, hour_of_day_str=hour.cast("string"))


@query(
    "duration_minutes",
    sql("orders", f"""
SELECT {LINE_SQL}, CAST(epoch(delivery_ts) - epoch(order_ts) AS DOUBLE) / 60 AS whole_seconds,
  round((epoch_us(delivery_ts) + l_partkey % 7 * 250000 - epoch_us(order_ts)) / CAST(60000000 AS DOUBLE), 6)
    AS with_fractions
FROM delivery_orders"""),
)
def duration_minutes(spark, sf_dir):
    start, end = F.col("order_ts"), F.col("delivery_ts")
    quarter = F.make_dt_interval(secs=(F.pmod("l_partkey", F.lit(7)) * F.lit(0.25)).cast("decimal(18,6)"))
    return _orders(
        spark,
        sf_dir,
        whole_seconds=clock.duration_minutes(start, end),
        with_fractions=F.round(clock.duration_minutes_exact(start, end + quarter), 6),
    )


@query(
    "parse_timestamp",
    _orders_sql("""
CASE l_partkey % 5 WHEN 0 THEN NULL ELSE order_ts END AS parsed"""),
)
def parse_timestamp(spark, sf_dir):
    plain = F.date_format("order_ts", "yyyy-MM-dd HH:mm:ss")
    other = F.date_format("order_ts", "dd/MM/yyyy HH:mm")
    text = F.when(F.pmod("l_partkey", F.lit(5)) == 0, other).otherwise(plain)
    return _orders(spark, sf_dir, parsed=clock.parse_timestamp(text))


_ISO_FORMS = {
    0: "yyyy-MM-dd'T'HH:mm:ss'Z'",
    1: "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
    2: "yyyy-MM-dd'T'HH:mm:ss",
    3: "yyyy-MM-dd HH:mm:ss",
    4: "yyyy-MM-dd'T'HH:mm",
    5: "yyyy-MM-dd'T'HH:mm:ss'+0200'",
    6: "'not a time'",
}


def _iso_text(number, ts):
    kind = F.pmod(number, F.lit(7))
    text = F.when(kind == 0, F.date_format(ts, _ISO_FORMS[0]))
    for remainder, form in list(_ISO_FORMS.items())[1:]:
        text = text.when(kind == remainder, F.date_format(ts, form))
    return text


@query(
    "parse_iso_timestamp",
    _requests_sql("""
CASE event_id % 7 WHEN 4 THEN date_trunc('minute', order_date_and_time)
  WHEN 5 THEN order_date_and_time - to_hours(2) WHEN 6 THEN NULL ELSE order_date_and_time END AS tolerant,
CASE event_id % 7 WHEN 0 THEN order_date_and_time WHEN 2 THEN order_date_and_time
  WHEN 5 THEN order_date_and_time - to_hours(2) END AS strict"""),
)
def parse_iso_timestamp(spark, sf_dir):
    number = fixtures.event_number(F.col("UUID"))
    text = _iso_text(number, F.col("order_date_and_time"))
    return _requests(
        spark,
        sf_dir,
        tolerant=clock.parse_iso_timestamp(text),
        strict=clock.parse_iso_timestamp_strict(text),
    )


# -- money ------------------------------------------------------------------


@query("total_cost", _orders_sql("round(total_cost, 4) AS total_cost", "finance", "finance"))
def total_cost(spark, sf_dir):
    orders = with_finance(fixtures.delivery_orders(spark, sf_dir))
    return orders.select(*LINE, F.round("total_cost", 4).alias("total_cost"))


@query("profit", _orders_sql("round(profit, 4) AS profit", "finance", "finance"))
def profit(spark, sf_dir):
    orders = with_finance(fixtures.delivery_orders(spark, sf_dir))
    return orders.select(*LINE, F.round("profit", 4).alias("profit"))


@query("loss_flag", _orders_sql("profit < 0 AS loss", "finance", "finance"))
def loss_flag(spark, sf_dir):
    orders = with_finance(fixtures.delivery_orders(spark, sf_dir))
    return orders.select(*LINE, ledger.loss_flag(F.col("profit")).alias("loss"))


@query(
    "round_half_even",
    _orders_sql(
        "round_even((l_partkey + CAST(0.125 AS DOUBLE)) * 100, 0) / 100 AS tie,"
        " round_even(order_value / 7 * 100, 0) / 100 AS plain"
    ),
)
def round_half_even(spark, sf_dir):
    return _orders(
        spark,
        sf_dir,
        tie=ledger.round_half_even(F.col("l_partkey") + F.lit(0.125)),
        plain=ledger.round_half_even(F.col("order_value") / 7),
    )


@query(
    "processing_time",
    _requests_sql("true AS stamped"),
)
def processing_time(spark, sf_dir):
    """The stamp itself differs from run to run; what holds is that it is later than the data."""
    stamped = fixtures.requests(spark, sf_dir).withColumn("@timestamp", F.current_timestamp())
    return stamped.select(
        "UUID", (F.col("@timestamp") > F.col("order_date_and_time")).alias("stamped")
    )


@query(
    "numeric_cast",
    _requests_sql("""
CASE WHEN event_id % 9 = 0 THEN NULL ELSE order_value END AS order_value_dbl,
delivery_fee AS delivery_fee_dbl"""),
)
def numeric_cast(spark, sf_dir):
    number = fixtures.event_number(F.col("UUID"))
    text = F.when(F.pmod(number, F.lit(9)) == 0, "n/a").otherwise(F.col("order_value").cast("string"))
    return _requests(
        spark,
        sf_dir,
        order_value_dbl=text.try_cast("double"),
        delivery_fee_dbl=F.col("delivery_fee").cast("int").try_cast("double"),
    )


@query(
    "stringify_category",
    _orders_sql("coalesce(discounts_and_offers, 'nan') AS discounts_and_offers, CAST(l_partkey AS VARCHAR) AS part"),
)
def stringify_category(spark, sf_dir):
    return _orders(
        spark,
        sf_dir,
        discounts_and_offers=ledger.stringify(F.col("discounts_and_offers")),
        part=ledger.stringify(F.col("l_partkey")),
    )
