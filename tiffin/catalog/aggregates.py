"""Aggregations, box statistics, sorting and top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.catalog.registry import query
from tiffin.catalog.views import sql
from tiffin.functions import clock, ledger, offers
from tiffin.operators import boxes, profile
from tiffin.plans import report
from tiffin.plans.features import with_finance
from tiffin.plans.report import MEASURES
from tiffin.sources import fixtures

# Order lines have no unique number of their own; this order has no ties.
TIE_BREAK = ["order_id", "line_no", "l_partkey", "restaurant_id", "order_value"]


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_finance(fixtures.delivery_orders(spark, sf_dir))


def rounded(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# -- counts and means -------------------------------------------------------


@query(
    "value_counts",
    sql("orders", """
SELECT discounts_and_offers, count(*) AS n FROM delivery_orders
WHERE discounts_and_offers IS NOT NULL GROUP BY 1"""),
)
def value_counts(spark, sf_dir):
    return profile.value_counts(fixtures.delivery_orders(spark, sf_dir), "discounts_and_offers")


@query(
    "group_mean_profit",
    sql("finance", """
SELECT coalesce(discounts_and_offers, 'nan') AS discounts_and_offers, round(avg(profit), 4) AS mean_profit
FROM finance GROUP BY 1"""),
)
def group_mean_profit(spark, sf_dir):
    means = profile.group_mean(priced(spark, sf_dir), "discounts_and_offers", "profit")
    return rounded(means, ["mean_profit"])


@query(
    "profit_summary",
    sql("finance", """
SELECT round_even(avg(profit) * 100, 0) / 100 AS mean_profit,
       count(*) FILTER (WHERE profit < 0) AS loss_orders,
       round_even(avg(CASE WHEN profit < 0 THEN 1 ELSE 0 END) * 100 * 100, 0) / 100 AS loss_percent
FROM finance"""),
)
def profit_summary(spark, sf_dir):
    return profile.profit_summary(priced(spark, sf_dir))


def _correlation_sql() -> str:
    parts = [
        f"SELECT '{a}' AS column_a, '{b}' AS column_b,"
        f" CAST(round({'1' if a == b else f'corr({a}, {b})'}, 6) AS DOUBLE) AS correlation FROM measures"
        + (" LIMIT 1" if a == b else "")
        for a in MEASURES
        for b in MEASURES
    ]
    body = " UNION ALL ".join(f"({part})" for part in parts)
    return sql("finance", f""",
measures AS (SELECT *, hour(order_ts) AS hour_of_day FROM finance)
{body}""")


@query("correlation_matrix", _correlation_sql())
def correlation_matrix(spark, sf_dir):
    measures = priced(spark, sf_dir).select(*MEASURES, "has_discount", "refunded")
    return rounded(profile.correlation_matrix(measures), ["correlation"], 6)


@query(
    "category_frequencies",
    sql("orders", """
SELECT 'payment_method' AS category, payment_method AS label, count(*) AS n FROM delivery_orders
WHERE payment_method IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'discounts_and_offers', discounts_and_offers, count(*) FROM delivery_orders
WHERE discounts_and_offers IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'day_of_week', dayname(order_ts), count(*) FROM delivery_orders GROUP BY 2"""),
)
def category_frequencies(spark, sf_dir):
    orders = fixtures.delivery_orders(spark, sf_dir).withColumn(
        "day_of_week", clock.weekday_name(F.col("order_ts"))
    )
    return profile.category_frequencies(
        orders, ["payment_method", "discounts_and_offers", "day_of_week"]
    )


@query(
    "axis_max",
    sql("finance", """
SELECT greatest(max(delivery_minutes), max(CAST(40 AS DOUBLE) + l_partkey % 50)) AS axis_max FROM finance"""),
)
def axis_max(spark, sf_dir):
    scored = fixtures.scores(spark, sf_dir).withColumn(
        "delivery_minutes", clock.duration_minutes(F.col("order_ts"), F.col("delivery_ts"))
    )
    return profile.axis_max(scored, ["delivery_minutes", "prediction"])


@query(
    "rmse",
    sql("finance", """
SELECT round(sqrt(avg(pow(delivery_minutes - (CAST(40 AS DOUBLE) + l_partkey % 50), 2))), 6) AS rmse
FROM finance"""),
)
def rmse(spark, sf_dir):
    scored = fixtures.scores(spark, sf_dir).withColumn(
        "delivery_minutes", clock.duration_minutes(F.col("order_ts"), F.col("delivery_ts"))
    )
    return rounded(profile.rmse(scored, "delivery_minutes", "prediction"), ["rmse"], 6)


@query(
    "batch_counts",
    sql("requests", """
SELECT count(*) AS rows_in, count(*) FILTER (WHERE payment_method IS NOT NULL) AS rows_out FROM requests"""),
)
def batch_counts(spark, sf_dir):
    """Row counts before and after a step, both from the one pass that does the step."""
    requests = fixtures.requests(spark, sf_dir)
    return requests.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col("payment_method").isNotNull()).alias("rows_out"),
    )


@query(
    "offer_rollup_means",
    sql("finance", """
SELECT coalesce(discounts_and_offers, 'nan') AS discounts_and_offers, round(avg(profit), 4) AS mean_profit
FROM finance GROUP BY 1"""),
)
def offer_rollup_means(spark, sf_dir):
    """Mean profit per offer as the report gets it, from its one table of sums."""
    means = report.offer_means(report.offer_rollup(priced(spark, sf_dir)))
    return rounded(means, ["mean_profit"])


# -- box statistics ---------------------------------------------------------

_BOX_COLUMNS = ["q1", "median", "q3", "whisker_low", "whisker_high"]


def _box_body(key: str, source: str = "finance") -> str:
    """Box statistics written with the exact percentile and a join back to the rows."""
    return f"""
, keyed AS (SELECT {key}, delivery_minutes AS v FROM {source}),
quartiles AS (
  SELECT k, count(*) AS n_rows, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
         quantile_cont(v, 0.75) AS q3
  FROM keyed WHERE k IS NOT NULL AND v IS NOT NULL GROUP BY k
)
SELECT k, n_rows, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  round(least(q1, min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1))), 4) AS whisker_low,
  round(greatest(q3, max(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1))), 4) AS whisker_high,
  count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
FROM keyed JOIN quartiles USING (k) WHERE v IS NOT NULL
GROUP BY k, n_rows, q1, median, q3"""


def _box_sql(name: str, key: str, source: str = "finance", views: str = "finance", extra: str = "") -> str:
    body = _box_body(f"{key} AS k", source)
    head, select = body.split("\nSELECT k, n_rows", 1)
    return sql(
        views,
        extra + head.strip()
        + f"\nSELECT k AS {name}, * EXCLUDE (k) FROM (SELECT k, n_rows{select})",
    )


def _boxes(df: DataFrame, name: str, key: Column) -> DataFrame:
    minutes = clock.duration_minutes_exact(F.col("order_ts"), F.col("delivery_ts"))
    return rounded(boxes.box_stats(df, {name: key}, minutes), _BOX_COLUMNS)


def _skewed_minutes(df: DataFrame) -> DataFrame:
    """Every hundredth order takes ten times as long, so that the boxes have outliers."""
    late = F.pmod("l_partkey", F.lit(100)) == 7
    extra = F.when(late, F.pmod("l_partkey", F.lit(9)) * 60).otherwise(0)
    return df.withColumn("delivery_ts", F.timestamp_add("MINUTE", extra, F.col("delivery_ts")))


_LATE = """
, late AS (
  SELECT * REPLACE (delivery_minutes + CASE WHEN l_partkey % 100 = 7 THEN (l_partkey % 9) * 60 ELSE 0 END
    AS delivery_minutes) FROM finance
)"""


def _two_key_sql() -> str:
    body = _box_body("struct_pack(method := payment_method, refunded := coalesce(refunds > 0, false)) AS k", "late")
    head, select = body.split("\nSELECT k, n_rows", 1)
    return sql("finance", _LATE + head.strip() + f"""
SELECT k.method AS payment_method, k.refunded AS refunded, * EXCLUDE (k) FROM (SELECT k, n_rows{select})""")


@query("box_stats", _two_key_sql())
def box_stats(spark, sf_dir):
    """The general form: any number of grouping columns."""
    orders = _skewed_minutes(fixtures.delivery_orders(spark, sf_dir))
    minutes = clock.duration_minutes_exact(F.col("order_ts"), F.col("delivery_ts"))
    by = {"payment_method": F.col("payment_method"), "refunded": ledger.is_refunded(F.col("refunds"))}
    return rounded(boxes.box_stats(orders, by, minutes), _BOX_COLUMNS)


@query("box_by_weekday", _box_sql("day_of_week", "dayname(order_ts)"))
def box_by_weekday(spark, sf_dir):
    orders = fixtures.delivery_orders(spark, sf_dir)
    result = _boxes(orders, "day_of_week", clock.weekday_name(F.col("order_ts")))
    return result.orderBy(clock.weekday_position(F.col("day_of_week")))


@query(
    "box_by_top_restaurant",
    _box_sql("restaurant_id", "restaurant_id", "kept", extra=""", top AS (
  SELECT restaurant_id FROM delivery_orders GROUP BY 1 ORDER BY count(*) DESC, restaurant_id LIMIT 10
), kept AS (SELECT * FROM finance WHERE restaurant_id IN (SELECT restaurant_id FROM top))"""),
)
def box_by_top_restaurant(spark, sf_dir):
    orders = fixtures.delivery_orders(spark, sf_dir)
    kept = profile.keep_top_values(orders, "restaurant_id", 10)
    return _boxes(kept, "restaurant_id", F.col("restaurant_id"))


@query(
    "box_by_has_discount",
    _box_sql("has_discount", "coalesce(lower(discounts_and_offers) <> 'none', true)"),
)
def box_by_has_discount(spark, sf_dir):
    orders = fixtures.delivery_orders(spark, sf_dir)
    return _boxes(
        orders, "has_discount", offers.has_discount_not_none(F.col("discounts_and_offers"))
    )


@query("box_by_payment", _box_sql("payment_method", "payment_method", "late", extra=_LATE))
def box_by_payment(spark, sf_dir):
    orders = _skewed_minutes(fixtures.delivery_orders(spark, sf_dir))
    return _boxes(orders, "payment_method", F.col("payment_method"))


@query("box_by_refunded", _box_sql("refunded", "coalesce(refunds > 0, false)"))
def box_by_refunded(spark, sf_dir):
    return _boxes(fixtures.delivery_orders(spark, sf_dir), "refunded", ledger.is_refunded(F.col("refunds")))


@query("box_by_hour", _box_sql("hour_of_day", "CAST(hour(order_ts) AS INTEGER)"))
def box_by_hour(spark, sf_dir):
    orders = fixtures.delivery_orders(spark, sf_dir)
    result = _boxes(orders, "hour_of_day", clock.hour_of_day(F.col("order_ts")))
    return result.orderBy("hour_of_day")


@query(
    "box_by_refunded_label",
    _box_sql(
        "refunded", "CASE WHEN refunds > 0 THEN 'with refund' ELSE 'without refund' END",
        "late", extra=_LATE,
    ),
)
def box_by_refunded_label(spark, sf_dir):
    orders = _skewed_minutes(fixtures.delivery_orders(spark, sf_dir))
    label = F.when(F.col("refunds") > 0, "with refund").otherwise("without refund")
    return _boxes(orders, "refunded", label)


_REPORT_KEYS = {
    "day_of_week": "dayname(order_ts)",
    "has_discount": "coalesce(lower(discounts_and_offers) <> 'none', true)",
    "payment_method": "payment_method",
    "refunded": "coalesce(refunds > 0, false)",
    "hour_of_day": "hour(order_ts)",
}


def _report_sql() -> str:
    union = "\n  UNION ALL ".join(
        f"SELECT '{name}' AS grouping, CAST({key} AS VARCHAR) AS level, delivery_minutes FROM finance"
        for name, key in _REPORT_KEYS.items()
    )
    body = _box_body("struct_pack(grouping := grouping, level := level) AS k", "unfolded")
    head, select = body.split("\nSELECT k, n_rows", 1)
    return sql("finance", f""", unfolded AS (
  {union}
){head.strip()}
SELECT k.grouping AS "grouping", k.level AS "level", * EXCLUDE (k) FROM (SELECT k, n_rows{select})""")


@query("box_report", _report_sql())
def box_report(spark, sf_dir):
    """Five of the box plots in one scan."""
    minutes = clock.duration_minutes_exact(F.col("order_ts"), F.col("delivery_ts"))
    orders = fixtures.delivery_orders(spark, sf_dir)
    return rounded(boxes.box_report(orders, report.box_groupings(), minutes), _BOX_COLUMNS)


# -- sorting and top lists --------------------------------------------------

_TOP_COLUMNS = [*TIE_BREAK, "commission_fee", "total_cost", "profit", "discounts_and_offers"]


def _top_sql(direction: str) -> str:
    money = ", ".join(f"round({c}, 4) AS {c}" for c in ("commission_fee", "total_cost", "profit"))
    plain = ", ".join(c for c in _TOP_COLUMNS if c not in ("commission_fee", "total_cost", "profit"))
    return sql("finance", f"""
SELECT {plain}, {money} FROM finance ORDER BY finance.profit {direction}, {', '.join(TIE_BREAK)} LIMIT 10""")


@query("top_profit_orders", _top_sql("DESC"))
def top_profit_orders(spark, sf_dir):
    top = profile.top_by(priced(spark, sf_dir), [F.desc("profit"), *map(F.asc, TIE_BREAK)])
    return rounded(
        top.orderBy("profit", *TIE_BREAK).select(*_TOP_COLUMNS),
        ["commission_fee", "total_cost", "profit"],
    )


@query("top_loss_orders", _top_sql("ASC"))
def top_loss_orders(spark, sf_dir):
    top = profile.top_by(priced(spark, sf_dir), [F.asc("profit"), *map(F.asc, TIE_BREAK)])
    return rounded(top.select(*_TOP_COLUMNS), ["commission_fee", "total_cost", "profit"])


@query(
    "top_restaurants",
    sql("orders", """
SELECT restaurant_id, count(*) AS n FROM delivery_orders GROUP BY 1 ORDER BY n DESC, restaurant_id LIMIT 10"""),
)
def top_restaurants(spark, sf_dir):
    return profile.top_values(fixtures.delivery_orders(spark, sf_dir), "restaurant_id", 10)


@query(
    "ordered_categories",
    sql("orders", """
SELECT dayname(order_ts) AS day_of_week, isodow(order_ts) AS "position", count(*) AS n
FROM delivery_orders GROUP BY 1, 2"""),
)
def ordered_categories(spark, sf_dir):
    days = fixtures.delivery_orders(spark, sf_dir).select(
        clock.weekday_name(F.col("order_ts")).alias("day_of_week")
    )
    counted = days.groupBy("day_of_week").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "day_of_week", clock.weekday_position(F.col("day_of_week")).alias("position"), "n"
    ).orderBy("position")


@query(
    "semi_join_top_keys",
    sql("orders", f"""
SELECT {', '.join(TIE_BREAK)} FROM delivery_orders WHERE restaurant_id IN (
  SELECT restaurant_id FROM delivery_orders GROUP BY 1 ORDER BY count(*) DESC, restaurant_id LIMIT 10)"""),
)
def semi_join_top_keys(spark, sf_dir):
    kept = profile.keep_top_values(fixtures.delivery_orders(spark, sf_dir), "restaurant_id", 10)
    return kept.select(*TIE_BREAK)


@query(
    "filter_in_top",
    sql("orders", """
SELECT payment_method, count(*) AS n, round(sum(order_value), 2) AS order_value FROM delivery_orders
WHERE discounts_and_offers IN (
  SELECT discounts_and_offers FROM delivery_orders WHERE discounts_and_offers IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, discounts_and_offers LIMIT 3)
GROUP BY 1"""),
)
def filter_in_top(spark, sf_dir):
    orders = fixtures.delivery_orders(spark, sf_dir)
    kept = profile.keep_top_values(orders, "discounts_and_offers", 3)
    return kept.groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("order_value"), 2).alias("order_value")
    )
