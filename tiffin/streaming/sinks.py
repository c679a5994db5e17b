"""Writers for micro-batches.

A micro-batch may run again after a failure, so every writer puts the rows of batch N into
the folder `batch_id=N` and replaces what an earlier attempt left there. All writers run on
the executors; no rows pass through the driver.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.operators.documents import iso_timestamps, response_kv_encode, search_bulk
from tiffin.schemas import RESPONSE_INDEX, RESPONSE_TOPIC
from tiffin.session import delete_folder, folder_exists

log = logging.getLogger(__name__)

ERROR_SCHEMA = T.StructType(
    [
        T.StructField("epoch_id", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("note", T.StringType()),
    ]
)

Writer = Callable[[DataFrame, int], None]


class SinkFailed(RuntimeError):
    """A required sink failed; `fan_out` has recorded it."""


@dataclass
class Sink:
    """A named writer; `on_error` says whether its failure stops the batch."""

    name: str
    write: Writer
    on_error: str = "fail"


def _batch_folder(path: str, epoch: int) -> str:
    return f"{path}/batch_id={epoch}"


def message_sink(
    fmt: str = "kafka",
    path: str | None = None,
    topic: str = RESPONSE_TOPIC,
    servers: str | None = None,
) -> Writer:
    """Responses as keyed JSON messages, to a topic or to files that stand in for one."""

    def write(df: DataFrame, epoch: int) -> None:
        messages = response_kv_encode(df)
        if fmt == "kafka":
            (
                messages.write.format("kafka")
                .option("kafka.bootstrap.servers", servers)
                .option("topic", topic)
                .save()
            )
        else:
            messages.write.format(fmt).mode("overwrite").save(_batch_folder(path, epoch))

    return write


def document_sink(path: str, fmt: str = "json") -> Writer:
    """Responses as documents, one row each, times as ISO text."""

    def write(df: DataFrame, epoch: int) -> None:
        documents = iso_timestamps(df.drop("_id"))
        documents.write.format(fmt).mode("overwrite").save(_batch_folder(path, epoch))

    return write


def search_sink(path: str, index: str = RESPONSE_INDEX) -> Writer:
    """Responses as bulk-index text, an action line and a document line per row."""

    def write(df: DataFrame, epoch: int) -> None:
        search_bulk(df, index).write.mode("overwrite").text(_batch_folder(path, epoch))

    return write


def _of_sink(path: str, name: str) -> str:
    return f"{path}/sink={quote(name, safe='')}"


def dead_letter(
    spark: SparkSession, path: str, epoch: int, error: str, note: str, sink: str = "batch"
) -> None:
    """Record one failed batch or sink; a later failure of the same one replaces the record."""
    row = spark.createDataFrame([(int(epoch), error, note)], ERROR_SCHEMA)
    folder = _of_sink(_batch_folder(path, int(epoch)), sink)
    row.coalesce(1).write.mode("overwrite").json(folder)


def failures(spark: SparkSession, path: str) -> DataFrame:
    """The records of failed batches and sinks: epoch_id, error, note, batch_id, sink."""
    schema = T.StructType([*ERROR_SCHEMA.fields]).add("batch_id", "long").add("sink", "string")
    if not folder_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def replay(spark: SparkSession, held: str, errors: str, sinks: list[Sink]) -> dict[str, list[int]]:
    """Send held batches to the sinks that failed on them; returns what each sink now has.

    A batch leaves the held rows and the records once its sink has taken it; a sink that fails
    again keeps both. Batches are listed by their folders, their rows stay in Spark.
    """
    sent: dict[str, list[int]] = {}
    for sink in sinks:
        path = _of_sink(held, sink.name)
        if not folder_exists(spark, path):
            continue
        rows = spark.read.parquet(path)
        epochs = rows.agg(F.sort_array(F.collect_set("batch_id"))).first()[0]
        for epoch in epochs:
            batch = rows.where(F.col("batch_id") == epoch).drop("batch_id")
            try:
                sink.write(batch, epoch)
            except Exception as error:
                log.warning("replay of batch %s: sink %s failed: %s", epoch, sink.name, error)
                dead_letter(spark, errors, epoch, str(error), f"sink {sink.name}", sink.name)
                continue
            delete_folder(spark, _batch_folder(path, epoch))
            delete_folder(spark, _of_sink(_batch_folder(errors, epoch), sink.name))
            sent.setdefault(sink.name, []).append(epoch)
        if sent.get(sink.name) == epochs:
            delete_folder(spark, path)
    return sent


def fan_out(
    df: DataFrame, epoch: int, sinks: list[Sink], errors: str | None = None,
    held: str | None = None,
) -> list[str]:
    """Write one batch to all sinks in order; returns the names of those that failed.

    A failure of a `continue` sink is recorded and the rest go on; with `held` its rows are put
    there for `replay`. A failure of a `fail` sink is recorded and raised, so the batch is not
    committed and will be run again.
    """
    failed = []
    for sink in sinks:
        try:
            sink.write(df, epoch)
        except Exception as error:
            log.warning("batch %s: sink %s failed: %s", epoch, sink.name, error)
            if errors:
                dead_letter(
                    df.sparkSession, errors, epoch, str(error), f"sink {sink.name}", sink.name
                )
            if sink.on_error != "continue":
                raise SinkFailed(f"sink {sink.name}: {error}") from error
            if held:
                folder = _batch_folder(_of_sink(held, sink.name), epoch)
                df.write.mode("overwrite").parquet(folder)
            failed.append(sink.name)
    return failed
