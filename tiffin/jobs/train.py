"""Train the delivery-time model on a table of delivered orders and save it.

    spark-submit -m tiffin.jobs.train --data orders.csv --out models/pipeline_model
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from tiffin.operators.columns import canonical_columns
from tiffin.plans import training
from tiffin.plans.features import build_training_rows
from tiffin.schemas import DEFAULT_TIMESTAMP_FORMAT, NUMERIC_FEATURES
from tiffin.session import build_session
from tiffin.sources.tables import read_orders_csv

SPLIT_KEYS = [
    "order_date_and_time", "order_value_dbl", "delivery_fee_dbl", "commission_fee_dbl",
    "payment_processing_fee_dbl", "payment_method", "discounts_and_offers",
]


def run(
    raw: DataFrame,
    out: str,
    fmt: str = DEFAULT_TIMESTAMP_FORMAT,
    keys: list[str] | None = None,
    max_depth: int = training.MAX_DEPTH,
    max_iter: int = training.MAX_ITER,
    refund_amount: bool = False,
    max_labels: int | None = None,
) -> training.TrainingResult:
    """Train on the rows of `raw`, whatever their column spellings, and save under `out`.

    With `refund_amount` the refunded amount is a feature beside the flag made from it.
    """
    rows = build_training_rows(canonical_columns(raw, keep=keys), fmt)
    result = training.train(
        rows,
        keys or SPLIT_KEYS,
        numeric=NUMERIC_FEATURES if refund_amount else None,
        max_depth=max_depth,
        max_iter=max_iter,
        max_labels=max_labels,
    )
    training.save_model(result.model, out)
    return result


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--data", required=True, help="orders table")
    parser.add_argument("--out", required=True, help="folder for the fitted pipeline")
    parser.add_argument("--format", default="csv", choices=["csv", "parquet", "orc", "json"])
    parser.add_argument("--schema", help="DDL schema of a CSV; spares the inference pass")
    parser.add_argument("--datefmt", default=DEFAULT_TIMESTAMP_FORMAT)
    parser.add_argument("--key", action="append", help="column that decides the split; repeatable")
    parser.add_argument("--depth", type=int, default=training.MAX_DEPTH)
    parser.add_argument("--iterations", type=int, default=training.MAX_ITER)
    parser.add_argument("--refund-amount", action="store_true", help="use the amount as a feature")
    parser.add_argument("--max-labels", type=int, default=None)
    parser.add_argument("--master")
    args = parser.parse_args(argv)
    spark = build_session("tiffin-train", args.master)
    if args.format == "csv":
        raw = read_orders_csv(spark, args.data, args.schema)
    else:
        raw = spark.read.format(args.format).load(args.data)
    result = run(
        raw, args.out, args.datefmt, args.key, args.depth, args.iterations, args.refund_amount,
        args.max_labels,
    )
    print(
        f"rmse {result.rmse:.2f} on {result.n_test} rows (mean of {result.n_train} training rows"
        f" as prediction: {result.baseline_rmse:.2f}); saved to {args.out}"
    )


if __name__ == "__main__":
    main()
