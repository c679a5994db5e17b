"""Durable notes about micro-batches: counts, commits, and how far event time has come.

A note of batch N is one row in the folder `batch_id=N` of a ledger. Running the batch again
replaces its note, so a ledger never holds two of one batch and needs no state of its own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.session import delete_folder, folder_exists
from tiffin.streaming.dedup import EVENT_TIME

COUNTS = "rows_in long, rows_scored long, rows_rejected long"
COMMIT = "sinks array<string>"
REACHED = "newest timestamp"
KEPT_NOTES = 20


def _folder(path: str, epoch: int) -> str:
    return f"{path}/batch_id={int(epoch)}"


def note(spark: SparkSession, path: str, epoch: int, values: tuple, schema: str) -> None:
    """Write the note of a batch in place of an earlier one."""
    row = spark.createDataFrame([values], schema)
    row.coalesce(1).write.mode("overwrite").parquet(_folder(path, epoch))


def notes(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All notes, with `batch_id`; none if the ledger is not there yet."""
    full = f"{schema}, batch_id long"
    if not folder_exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


class BatchLedger:
    """Row counts of every batch of a stream, over all its runs."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, epoch: int, values: dict) -> None:
        counts = tuple(values[n] for n in ("rows_in", "rows_scored", "rows_rejected"))
        note(self.spark, self.path, epoch, counts, COUNTS)

    def counts(self) -> DataFrame:
        return notes(self.spark, self.path, COUNTS)


def commit_batch(spark: SparkSession, path: str, epoch: int, names: list[str]) -> None:
    """Say that a batch has reached all its sinks; written after them."""
    note(spark, path, epoch, (names,), COMMIT)


def is_committed(spark: SparkSession, path: str, epoch: int) -> bool:
    return folder_exists(spark, f"{_folder(path, epoch)}/_SUCCESS")


def committed(rows: DataFrame, commits: DataFrame) -> DataFrame:
    """Of rows with `batch_id` those of committed batches.

    A batch that stopped between two sinks is in some of them and not in others; no reader that
    comes through here sees any of it.
    """
    return rows.join(commits.select("batch_id").distinct(), "batch_id", "left_semi")


def late_splitter(limit: dt.timedelta, on_time, late, reached: str, event_time: str = EVENT_TIME):
    """A function for `foreachBatch` that writes late rows beside the others.

    A row is late if it is not newer than the newest time of all earlier batches less `limit`,
    which is what the watermark drops without a trace; a row without a time never is. How far
    the time has come is noted in the ledger `reached` once the batch is written, so a batch
    that runs again, or runs after a restart, meets the same limit and replaces its own output.
    `on_time` and `late` are writers of sinks.
    """

    def process(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        earlier = notes(spark, reached, REACHED).where(F.col("batch_id") < epoch)
        before = earlier.agg(F.max("newest")).first()[0]
        kept = batch.persist()
        try:
            newest = kept.agg(F.max(event_time)).first()[0]
            mark = F.lit(None if before is None else before - limit).cast("timestamp")
            is_late = F.coalesce(F.col(event_time) <= mark, F.lit(False))
            on_time(kept.where(~is_late), epoch)
            late(kept.where(is_late), epoch)
        finally:
            kept.unpersist()
        times = [t for t in (before, newest) if t is not None]
        note(spark, reached, epoch, (max(times) if times else None,), REACHED)
        # A note includes all before it; the last few serve batches that run again.
        if epoch >= KEPT_NOTES:
            delete_folder(spark, _folder(reached, epoch - KEPT_NOTES))

    return process
