"""Exact de-duplication by counting quotient filters and a comparison of bytes.

Each partition builds a counting quotient filter of its fingerprints, one part per block of the
fingerprint space. The parts of a block are merged, which loses nothing, and only texts whose
fingerprint is counted more than once are compared byte by byte.

Defined results: a null text counts as empty. Of equal texts the row with the largest id stays,
a null id being smaller than any other; of rows that also share that id exactly one stays. The
result has one row per input row. Other columns of the input are not carried on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.common import slices, stored
from tiffin.llm.quotient_filter import CountingQuotientFilter
from tiffin.llm.routing import may_match

BLOCK_BITS = 9
# A fingerprint is hot if it has more than one in HOT_SHARE of all rows: at most HOT_SHARE are.
HOT_SHARE = 1024
HOT_SALTS = 256


def _digests(docs: DataFrame, id_col: str, text_col: str, with_text: bool) -> DataFrame:
    """(id, sha, fp), and the normalised text if wanted; A-Z is lower-cased, nothing else."""
    fields = [
        T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("sha", T.BinaryType(), False),
        T.StructField("fp", T.LongType(), False),
    ]
    if with_text:
        fields.append(T.StructField("text", T.BinaryType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            column = batch.column("text").cast(pa.binary())
            texts = [(t or b"").lower() for t in column.to_pylist()]
            shas = [hashlib.sha256(t).digest() for t in texts]
            fps = np.frombuffer(b"".join(s[:8] for s in shas), ">i8").astype(np.int64)
            columns = [batch.column("id"), pa.array(shas, pa.binary()), pa.array(fps)]
            if with_text:
                columns.append(pa.array(texts, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, T.StructType(fields))


def repeated_fingerprints(keys: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """(fp, n) of every fingerprint that occurs more than once."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, CountingQuotientFilter] = {}
        for batch in batches:
            values = np.sort(np.asarray(batch.column("fp")).view(np.uint64))
            blocks = (values >> np.uint64(64 - block_bits)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            for part in np.split(values, cuts):
                if len(part):
                    block = int(part[0] >> np.uint64(64 - block_bits))
                    new = CountingQuotientFilter.of(part, block, block_bits)
                    held[block] = held[block].merged(new) if block in held else new
        if held:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(held), pa.int32()),
                    pa.array([f.to_bytes() for f in held.values()], pa.binary()),
                ],
                ["block", "filter"],
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def found(done: CountingQuotientFilter) -> pa.RecordBatch:
            fps, counts = done.repeated()
            return pa.RecordBatch.from_arrays(
                [pa.array(fps.view(np.int64)), pa.array(counts)], ["fp", "n"]
            )

        for batch in batches:
            for data in batch.column("filter").to_pylist():
                new = CountingQuotientFilter.from_bytes(data)
                if held is not None and held.block == new.block:
                    held = held.merged(new)
                    continue
                if held is not None:
                    yield found(held)
                held = new
        if held is not None:
            yield found(held)

    parts = keys.select("fp").mapInArrow(build, "block int, filter binary")
    return (
        parts.repartition("block").sortWithinPartitions("block")
        .mapInArrow(merge, "fp long, n long")
    )


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, sha256 hex, keep_id, group_size, kept) per row."""
    keys = stored(
        _digests(docs, id_col, text_col, False).withColumn(
            "seq", F.monotonically_increasing_id()
        ),
        "exact-keys",
    )
    repeated = stored(repeated_fingerprints(keys), "exact-repeated")

    # Hot fingerprints, at most HOT_SHARE of them, are known to every task, so that their texts
    # can be dealt out by a salt.
    hot = repeated.where(F.col("n") * HOT_SHARE > F.lit(keys.count())).select(
        "fp", F.lit(HOT_SALTS).alias("salts")
    )
    salts = F.coalesce(F.col("salts"), F.lit(1))
    # Only texts whose fingerprint repeats leave the task that reads them.
    texts = may_match(
        _digests(docs, id_col, text_col, True), F.col("fp"), repeated.select("fp"), "repeats"
    ).where("repeats").drop("repeats")
    texts = texts.join(F.broadcast(hot), "fp", "left").withColumn(
        "salt", F.pmod(F.xxhash64("id"), salts).cast("int")
    )
    wanted = repeated.join(F.broadcast(hot), "fp", "left").select(
        "fp", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")
    )
    # The comparison: rows are grouped by their bytes, after partial grouping in every task.
    classes = (
        texts.join(wanted, ["fp", "salt"], "left_semi")
        .groupBy("sha", "text").agg(F.count("*").alias("n"))
    )
    verified = classes.groupBy("sha").agg(
        F.sum("n").alias("n"), F.count("*").alias("n_texts")
    ).where(F.col("n") > 1)
    stays = (
        keys.join(repeated, "fp", "left_semi").groupBy("sha")
        .agg(F.max(F.struct("id", "seq")).alias("top"))
    )
    groups = verified.join(stays, "sha").select(
        F.col("sha").alias("group_sha"),
        F.when(F.col("n_texts") == 1, F.col("n"))
        .otherwise(F.raise_error(F.lit("two texts share a SHA-256 digest")).cast("long"))
        .alias("n"),
        "top",
    )
    alone = F.col("group_sha").isNull()
    return keys.join(groups, F.col("sha") == F.col("group_sha"), "left").select(
        "id",
        F.lower(F.hex("sha")).alias("sha256"),
        F.when(alone, F.col("id")).otherwise(F.col("top.id")).alias("keep_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("n")).cast("long").alias("group_size"),
        (alone | (F.col("seq") == F.col("top.seq"))).alias("kept"),
    )
