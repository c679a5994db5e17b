"""Static tables: CSV scans and a look at their shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_orders_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """CSV with a header. Types are inferred unless a schema spares that extra pass."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def use_all_cores(scan: DataFrame) -> DataFrame:
    """Spread the rows of a plain scan that has fewer splits than the cluster has cores.

    A small table, or a file that cannot be split, would keep all later work on a few cores.
    A table with enough splits, as any large one has, is left as it is: no shuffle is added.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def schema_shape(df: DataFrame) -> DataFrame:
    """One row per column with its type, beside the row and column counts of the table."""
    fields = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
            )
            for position, field in enumerate(df.schema.fields, start=1)
        ]
    )
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .select("n_rows", F.lit(len(df.columns)).alias("n_columns"), F.explode(fields).alias("f"))
        .select("f.position", "f.column_name", "f.data_type", "n_rows", "n_columns")
    )


def sample_rows(df: DataFrame, columns: list[str], order: list, n: int) -> DataFrame:
    """The first `n` rows in a stated order, as a top-k and not a full sort."""
    return df.orderBy(*order).limit(n).select(*columns)


def sample_json(df: DataFrame, columns: list[str], order: list, n: int = 3) -> DataFrame:
    """The same small sample as one JSON text per row, for logs."""
    return sample_rows(df, columns, order, n).select(F.to_json(F.struct(*columns)).alias("value"))
