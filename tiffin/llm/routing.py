"""Sending only those rows through an exchange that can have a partner.

A fixed-size bit table holds the hashes of the keys of a join's smaller side. Each task of the
larger side tests its rows against the table where they are read; rows that miss certainly have
no partner and stay where they are. A table that is too full for its size lets more rows through
and changes nothing else: the join that follows is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 15  # one bitmap of 4 KB per bucket, the size of Spark's bitmap functions
TABLE_BITS = 26  # 2048 buckets: 8 MB for all tasks, whatever the number of keys


def may_match(rows: DataFrame, key: Column, keys: DataFrame, hit: str) -> DataFrame:
    """The rows with a column `hit`: false only if `key` is not in the one column of `keys`."""

    def split(value: Column) -> tuple[Column, Column]:
        place = F.pmod(F.xxhash64(value), F.lit(1 << TABLE_BITS))
        return F.shiftright(place, BUCKET_BITS), place.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))

    bucket, bit = split(F.col(keys.columns[0]))
    table = keys.select(bucket.alias("_bucket"), bit.alias("_bit")).groupBy("_bucket").agg(
        F.bitmap_construct_agg("_bit").alias("_bitmap")
    )
    # At most 2048 rows of 4 KB.
    bucket, bit = split(key)
    byte = F.col("_bitmap").substr((F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    mask = F.element_at(
        F.array(*[F.lit(1 << i) for i in range(8)]), (bit.bitwiseAND(F.lit(7)) + 1).cast("int")
    )
    found = rows.withColumn("_key_bucket", bucket).join(
        F.broadcast(table), F.col("_key_bucket") == F.col("_bucket"), "left"
    )
    return found.withColumn(
        hit, F.coalesce(value.bitwiseAND(mask) != 0, F.lit(False))
    ).drop("_key_bucket", "_bucket", "_bitmap")


def without(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows whose `key` is not in the one column of `gone`; both are read twice."""
    flagged = may_match(rows, F.col(key), gone, "_hit")
    name = gone.columns[0]
    kept = flagged.where("_hit").join(
        gone.select(F.col(name).alias("_gone")), F.col(key) == F.col("_gone"), "left_anti"
    )
    return flagged.where("NOT _hit").unionByName(kept).drop("_hit")
