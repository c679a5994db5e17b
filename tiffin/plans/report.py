"""The exploratory report: every table of the analysis, from as few scans as possible."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.functions import clock, ledger, offers
from tiffin.operators import boxes, profile

MEASURES = [
    "order_value", "delivery_fee", "commission_fee", "payment_processing_fee", "refunds",
    "delivery_minutes", "hour_of_day", "discount_value", "total_cost", "profit",
]
TOP_COLUMNS = ["order_value", "commission_fee", "total_cost", "profit", "discounts_and_offers"]


def offer_rollup(priced: DataFrame) -> DataFrame:
    """Counts and sums per offer text; several tables of the report follow from these."""
    return priced.groupBy("discounts_and_offers").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("profit").alias("n_profit"),
        F.sum("profit").alias("sum_profit"),
        F.count_if(F.col("profit") < 0).alias("n_loss"),
    )


def offer_counts(rollup: DataFrame) -> DataFrame:
    counted = rollup.where(F.col("discounts_and_offers").isNotNull())
    return counted.select("discounts_and_offers", "n").orderBy(F.desc("n"), "discounts_and_offers")


def offer_means(rollup: DataFrame) -> DataFrame:
    return rollup.select(
        ledger.stringify(F.col("discounts_and_offers")).alias("discounts_and_offers"),
        (F.col("sum_profit") / F.nullif(F.col("n_profit"), F.lit(0))).alias("mean_profit"),
    ).orderBy("mean_profit", "discounts_and_offers")


def profit_totals(rollup: DataFrame) -> DataFrame:
    """Mean profit, number and share of orders at a loss, to two decimals."""
    total = rollup.agg(*[F.sum(c).alias(c) for c in ("n", "n_profit", "sum_profit", "n_loss")])
    return total.select(
        ledger.round_half_even(F.col("sum_profit") / F.nullif(F.col("n_profit"), F.lit(0))).alias(
            "mean_profit"
        ),
        F.col("n_loss").alias("loss_orders"),
        ledger.round_half_even(
            F.col("n_loss") / F.nullif(F.col("n"), F.lit(0)) * 100
        ).alias("loss_percent"),
    )


def box_groupings() -> dict:
    """The groupings whose box plots come out of one scan."""
    ts = F.col("order_ts")
    return {
        "day_of_week": clock.weekday_name(ts),
        "has_discount": offers.has_discount_not_none(F.col("discounts_and_offers")),
        "payment_method": F.col("payment_method"),
        "refunded": ledger.is_refunded(F.col("refunds")),
        "hour_of_day": clock.hour_of_day(ts),
    }


def analysis_report(
    priced: DataFrame, tie_break: list[str], rollup: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All tables of the report, lazily, by name.

    `priced` has the columns of `with_finance`; `tie_break` makes the top lists stable;
    `rollup` is the offer rollup if it has been stored already.
    """
    minutes = F.col("delivery_minutes")
    rollup = offer_rollup(priced) if rollup is None else rollup
    kept = profile.keep_top_values(priced, "restaurant_id", 10)
    top_columns = [*dict.fromkeys([*tie_break, *TOP_COLUMNS])]
    most = profile.top_by(priced, [F.desc("profit"), *map(F.asc, tie_break)])
    least = profile.top_by(priced, [F.asc("profit"), *map(F.asc, tie_break)])
    return {
        "offer_counts": offer_counts(rollup),
        "offer_mean_profit": offer_means(rollup),
        "profit_summary": profit_totals(rollup),
        "correlation_matrix": profile.correlation_matrix(priced.select(*MEASURES)),
        "box_report": boxes.box_report(priced, box_groupings(), minutes),
        "box_by_top_restaurant": boxes.box_stats(
            kept, {"restaurant_id": F.col("restaurant_id")}, minutes
        ),
        "top_restaurants": profile.top_values(priced, "restaurant_id", 10),
        "top_profit_orders": most.orderBy("profit", *tie_break).select(*top_columns),
        "top_loss_orders": least.select(*top_columns),
    }
