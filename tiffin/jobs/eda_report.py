"""Write every table of the exploratory report.

    spark-submit -m tiffin.jobs.eda_report --data orders.parquet --out report/
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.functions.ledger import money, quoted
from tiffin.operators.columns import canonical_columns, resolve_columns
from tiffin.plans.features import as_timestamp, with_finance
from tiffin.plans.report import analysis_report, offer_rollup
from tiffin.schemas import DEFAULT_TIMESTAMP_FORMAT
from tiffin.session import build_session
from tiffin.sources.tables import read_orders_csv


def prepared_orders(raw: DataFrame, fmt: str = DEFAULT_TIMESTAMP_FORMAT) -> DataFrame:
    """An orders table, whatever its spellings and types, as the analysis expects it."""
    found = resolve_columns(
        raw, {"restaurant_id": ["Restaurant ID", "restaurant_id"], "order_id": ["Order ID", "order_id"]}
    )
    if found["restaurant_id"] is None:
        raise ValueError(f"missing restaurant id; available columns: {', '.join(raw.columns)}")
    kept = {wanted: name for wanted, name in found.items() if name}
    df = canonical_columns(raw, keep=list(kept.values()))
    return df.select(
        *[F.col(quoted(name)).alias(wanted) for wanted, name in kept.items()],
        as_timestamp(df, "order_date_and_time", fmt).alias("order_ts"),
        as_timestamp(df, "delivery_date_and_time", fmt).alias("delivery_ts"),
        "payment_method",
        "discounts_and_offers",
        *[money(df, c).alias(c) for c in ("order_value", "delivery_fee", "commission_fee", "payment_processing_fee")],
        money(df, "refunds/chargebacks").alias("refunds"),
    )


def run(orders: DataFrame, out: str, tie_break: list[str] | None = None) -> list[str]:
    """Write the report tables under `out`; returns their names."""
    priced = with_finance(orders)
    keys = tie_break or [
        c for c in ("order_id", "restaurant_id", "order_ts", "order_value") if c in priced.columns
    ]
    # Tables per offer all follow from one small rollup, which is written and read back.
    offer_rollup(priced).write.mode("overwrite").parquet(f"{out}/offer_rollup")
    rollup = orders.sparkSession.read.parquet(f"{out}/offer_rollup")
    tables = analysis_report(priced, keys, rollup)
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{out}/{name}")
    return list(tables)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--data", required=True, help="orders table")
    parser.add_argument("--out", required=True, help="folder for the report tables")
    parser.add_argument("--format", default="csv", choices=["csv", "parquet", "orc", "json"])
    parser.add_argument("--schema", help="DDL schema of a CSV; spares the inference pass")
    parser.add_argument("--datefmt", default=DEFAULT_TIMESTAMP_FORMAT)
    parser.add_argument("--master")
    args = parser.parse_args(argv)
    spark = build_session("tiffin-report", args.master)
    if args.format == "csv":
        raw = read_orders_csv(spark, args.data, args.schema)
    else:
        raw = spark.read.format(args.format).load(args.data)
    for name in run(prepared_orders(raw, args.datefmt), args.out):
        print(f"{args.out}/{name}")


if __name__ == "__main__":
    main()
