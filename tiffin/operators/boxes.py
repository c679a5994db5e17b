"""Box-plot statistics: exact quartiles, whiskers and outlier counts per group.

The built-in exact percentile keeps every distinct value of a group in one task's memory.
Here the rows are first counted per (group, value), which partial aggregation does before
any shuffle, and all later steps work on those counts. A group is cut into cells one unit
wide; running totals over the cells say which cells hold the wanted ranks, and only inside
those cells are values ranked one by one. So no task ever holds a whole group's values,
however many rows or distinct values it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.operators.clean import present

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
WHISKER_REACH = 1.5


def histogram(df: DataFrame, groups: dict[str, Column], value: Column) -> DataFrame:
    """Row count per group and distinct value; rows with a missing part are left out."""
    named = df.select(*[c.alias(name) for name, c in groups.items()], value.alias("value"))
    for name in [*groups, "value"]:
        named = named.where(present(named, name))
    return (
        named.withColumn("cell", F.floor("value"))
        .where(F.col("cell").isNotNull())
        .groupBy(*groups, "cell", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def box_stats_of(hist: DataFrame, keys: list[str]) -> DataFrame:
    """Box statistics per `keys` from the counts that `histogram` made."""
    whole = Window.partitionBy(*keys)
    cells = (
        hist.groupBy(*keys, "cell")
        .agg(F.sum("n").alias("cell_n"))
        .withColumn("upto", F.sum("cell_n").over(whole.orderBy("cell")))
        .withColumn("total", F.sum("cell_n").over(whole))
        .withColumn("before", F.col("upto") - F.col("cell_n"))
    )
    # Each quartile lies between two neighbouring ranks, counted from 0.
    place = {name: (F.col("total") - 1) * F.lit(q) for name, q in QUARTILES.items()}
    ranks = {}
    for name, position in place.items():
        ranks[f"{name}_lo"] = F.floor(position)
        ranks[f"{name}_hi"] = F.ceil(position)

    def holds(rank: Column, start: Column, end: Column) -> Column:
        return (rank >= start) & (rank < end)

    wanted = F.lit(False)
    for rank in ranks.values():
        wanted = wanted | holds(rank, F.col("before"), F.col("upto"))
    hit = cells.where(wanted).select(*keys, "cell", "before", "total")

    in_cell = Window.partitionBy(*keys, "cell").orderBy("value")
    ranked = (
        hist.join(hit, [*keys, "cell"])
        .withColumn("end", F.col("before") + F.sum("n").over(in_cell))
        .withColumn("start", F.col("end") - F.col("n"))
    )
    picked = ranked.groupBy(*keys).agg(
        F.max("total").alias("n"),
        *[
            F.max(F.when(holds(rank, F.col("start"), F.col("end")), F.col("value"))).alias(name)
            for name, rank in ranks.items()
        ],
    )
    quartiles = picked.select(
        *keys,
        F.col("n").alias("n_rows"),
        *[
            (
                F.col(f"{name}_lo")
                + (F.col(f"{name}_hi") - F.col(f"{name}_lo"))
                * ((F.col("n") - 1) * F.lit(q) - F.floor((F.col("n") - 1) * F.lit(q)))
            ).alias(name)
            for name, q in QUARTILES.items()
        ],
    )
    reach = (F.col("q3") - F.col("q1")) * WHISKER_REACH
    value = F.col("value")
    fenced = (value >= F.col("q1") - reach) & (value <= F.col("q3") + reach)
    # Whiskers end at the outermost values inside the fences, never inside the box.
    return (
        hist.join(quartiles, keys)
        .groupBy(*keys, "n_rows", *QUARTILES)
        .agg(
            F.min(F.when(fenced, value)).alias("lowest"),
            F.max(F.when(fenced, value)).alias("highest"),
            F.sum(F.when(fenced, 0).otherwise(F.col("n"))).alias("outliers"),
        )
        .select(
            *keys,
            "n_rows",
            *QUARTILES,
            F.least("lowest", "q1").alias("whisker_low"),
            F.greatest("highest", "q3").alias("whisker_high"),
            "outliers",
        )
    )


def box_stats(df: DataFrame, by: dict[str, Column], value: Column) -> DataFrame:
    """Box statistics of `value` per group."""
    return box_stats_of(histogram(df, by, value), list(by))


def box_report(df: DataFrame, by: dict[str, Column], value: Column) -> DataFrame:
    """Box statistics for several groupings in one scan: one row per grouping and level.

    The rows are counted once per combination of all groupings; the separate groupings are
    then unfolded from those counts and not from the rows.
    """
    named = df.select(
        *[c.cast("string").alias(name) for name, c in by.items()], value.alias("value")
    )
    joint = (
        named.where(present(named, "value"))
        .groupBy(*by, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sides = F.explode(
        F.array(
            *[F.struct(F.lit(name).alias("grouping"), F.col(name).alias("level")) for name in by]
        )
    )
    hist = (
        joint.select(sides.alias("side"), "value", "n")
        .select("side.grouping", "side.level", F.floor("value").alias("cell"), "value", "n")
        .where(F.col("level").isNotNull() & F.col("cell").isNotNull())
        .groupBy("grouping", "level", "cell", "value")
        .agg(F.sum("n").alias("n"))
    )
    return box_stats_of(hist, ["grouping", "level"])
