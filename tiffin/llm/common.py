"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.session import work_path

# Words are runs of anything but the six ASCII blanks; in Python `bytes.split()` gives the same.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 8 << 20
ARROW_ROWS = "1000"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of some megabytes: both sides hold a batch as a whole, and
    the default of 10,000 rows is tens of megabytes of text for each task and direction."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of one piece stay near `limit` bytes; rows stay whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(
            pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ).astype(np.int64)
        block = np.cumsum(sizes) // limit
        cuts = np.flatnonzero(np.diff(block)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(lo, hi - lo)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each run, one run after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of MurmurHash3)."""
    x = values.astype(np.uint64)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(33)
    return x


def window_hash(values: np.ndarray, size: int, base: int) -> np.ndarray:
    """Polynomial hash of each run of `size` values, by doubling; empty if there are fewer."""
    count = len(values) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out, offset = np.zeros(count, np.uint64), 0
    block, length, power = values, 1, np.uint64(base)
    with np.errstate(over="ignore"):
        while size:
            if size & 1:
                out = out * power + block[offset : offset + count]
                offset += length
            size >>= 1
            if size:
                block = block[:-length] * power + block[length:]
                length *= 2
                power = power * power
    return out
