"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the mix by its weight. A source whose share exceeds the allowed
number of epochs is clamped there, and the excess is dealt out again by weight until no share
exceeds its cap. A source is then taken in whole repetitions, and one more time for a seeded
part of its documents: those that come first in the order of a hash, up to the remaining words.

The plan is one row per source: how often every document is taken, and the last document in
hash order that is taken once more. It is found from sums per (source, hash bucket), so no task
ever sees a whole source.

Defined results: a null text has no words; a null source is a source of its own, last in order;
a document without an id is ordered by a hash of its text. Rows with equal source, id and hash
are treated alike. An empty table, or one without words, mixes to nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import WORD, stored

BUCKET_BITS = 12
HASH_BITS = 60  # 15 hexadecimal digits of an MD5


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_hash(id_col: Column, text: Column, seed: int) -> Column:
    """60 bits that order the documents; the same in every run."""
    name = F.coalesce(id_col.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def weighted(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Weights dealt out in turn to the sources by code point, null last.

    Ranks are counted per range of names and then across ranges, so that many sources do not
    meet in one task.
    """
    ranged = stored(
        sources.withColumn("missing", F.col("source").isNull())
        .repartitionByRange(F.col("missing"), F.col("source"))
        .withColumn("part", F.spark_partition_id()),
        "mix-sources",
    )
    inside = Window.partitionBy("part").orderBy("missing", "source")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the range exchange.
    offsets = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    place = F.row_number().over(inside) - 1 + F.col("offset")
    values = F.array(*[F.lit(float(w)) for w in weights])
    return ranged.join(offsets, "part").withColumn(
        "weight", F.element_at(values, (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    ).drop("part", "missing")


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """Add `target`: weight times a common level, at most `max_epochs` times the source's size.

    The level rises from round to round as clamped sources leave, until it stays.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level = 0.0
    while True:
        clamped = F.lit(level) * F.col("weight") > cap
        row = sources.agg(
            F.sum(F.when(clamped, cap).otherwise(0.0)).alias("taken"),
            F.sum(F.when(clamped, 0.0).otherwise(F.col("weight"))).alias("weights"),
        ).first()
        if not row["weights"]:
            break
        raised = (total - row["taken"]) / row["weights"]
        if raised <= level:
            break
        level = raised
    share = F.lit(level) * F.col("weight")
    return sources.withColumn("target", F.when(share > cap, cap).otherwise(share))


def mixing_plan(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), epochs: float = 1.5,
    max_epochs: float = 2.0, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """(rows, plan).

    rows: id, source, size, hash of each document. plan: source, source_size, target, whole
    (repetitions of every document), and the last hash and id that are taken once more.
    """
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            words(F.col(text_col)).alias("size"),
            seeded_hash(F.col(id_col), F.col(text_col), seed).alias("hash"),
        ),
        "mix-rows",
    )
    bucket = F.shiftright("hash", HASH_BITS - BUCKET_BITS)
    buckets = stored(
        rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size")),
        "mix-buckets",
    )
    sources = buckets.groupBy("source").agg(F.sum("size").alias("source_size"))
    total = buckets.agg(F.sum("size")).first()[0] or 0
    filled = water_fill(weighted(sources, weights), epochs * total, max_epochs)
    repeats = F.when(
        F.col("source_size") > 0, F.col("target") / F.col("source_size")
    ).otherwise(0.0)
    plan = stored(
        filled.withColumn("whole", F.floor(repeats).cast("long")).withColumn(
            "rest", F.col("target") - F.col("whole") * F.col("source_size")
        ),
        "mix-targets",
    )
    # The bucket in which the taken words reach the rest, and the documents before that point.
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("size").over(upto), F.lit(0))
    edge = buckets.withColumn("before", before).alias("b").join(
        plan.select("source", "rest").alias("p"),
        F.col("b.source").eqNullSafe(F.col("p.source")),
    ).where(
        (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("size") >= F.col("rest"))
    ).select(
        F.col("b.source").alias("edge_source"), F.col("bucket").alias("edge_bucket"),
        "before", "rest",
    )
    ordered = Window.partitionBy("source", "edge_bucket").orderBy("hash", "id", "size")
    inside = rows.withColumn("bucket", bucket).join(
        edge,
        F.col("source").eqNullSafe(F.col("edge_source"))
        & (F.col("bucket") == F.col("edge_bucket")),
    ).withColumn(
        "middle",
        2 * (
            F.col("before")
            + F.coalesce(
                F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            )
        ) + F.col("size"),
    )
    # A document is taken if its middle lies before the rest: the sum comes as near as whole
    # documents allow. Buckets before the edge are taken whole.
    cut = inside.groupBy("edge_source").agg(
        F.max(
            F.when(F.col("middle") < 2 * F.col("rest"), F.struct("hash", "id"))
        ).alias("last"),
        F.min("edge_bucket").alias("first_bucket"),
    )
    start = F.shiftleft("first_bucket", HASH_BITS - BUCKET_BITS) - 1
    plan = plan.join(cut, F.col("source").eqNullSafe(F.col("edge_source")), "left").select(
        "source", "source_size", "target", "whole", "rest",
        F.coalesce(F.col("last.hash"), start, F.lit(-1)).alias("last_hash"),
        F.col("last.id").alias("last_id"),
    )
    return rows, stored(plan, "mix-plan")


def copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows, which have source, id and hash, with `copies`, `source_size` and `target`."""
    plan = plan.withColumnRenamed("source", "plan_source")
    tied = F.col("hash") == F.col("last_hash")
    extra = (F.col("hash") < F.col("last_hash")) | (
        tied & (F.col("id").isNull() | F.coalesce(F.col("id") <= F.col("last_id"), F.lit(False)))
    )
    return rows.join(
        plan, F.col("source").eqNullSafe(F.col("plan_source")), "left"
    ).withColumn("copies", F.col("whole") + extra.cast("long")).drop(
        "plan_source", "last_hash", "last_id", "whole", "rest"
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of the input."""
    names = {k: options.get(k, v) for k, v in (
        ("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source")
    )}
    _, plan = mixing_plan(docs, **options)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(
        row.alias("row"),
        F.col(names["id_col"]).alias("id"),
        F.col(names["source_col"]).alias("source"),
        seeded_hash(
            F.col(names["id_col"]), F.col(names["text_col"]), options.get("seed", 42)
        ).alias("hash"),
    )
    times = copies(keyed, plan).where("copies > 0").select(
        "row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    )
    return times.select("row.*")
