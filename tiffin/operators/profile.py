"""Counts, means, correlations and top lists of an orders table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.functions.ledger import quoted, round_half_even, stringify
from tiffin.operators.clean import present


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs, most frequent first; missing values are not counted."""
    return (
        df.where(present(df, column))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
    )


def group_mean(df: DataFrame, by: str, value: str) -> DataFrame:
    """Mean of a value per category text, lowest first; a missing category is a group."""
    return (
        df.select(stringify(F.col(by)).alias(by), value)
        .groupBy(by)
        .agg(F.avg(value).alias(f"mean_{value}"))
        .orderBy(f"mean_{value}", by)
    )


def profit_summary(df: DataFrame, profit: str = "profit") -> DataFrame:
    """Mean profit, number and share of orders at a loss, to two decimals."""
    # A missing profit is no loss but still an order, so it stays in the share.
    loss = F.coalesce(F.col(profit) < 0, F.lit(False))
    return df.agg(
        round_half_even(F.avg(profit)).alias("mean_profit"),
        F.count_if(loss).alias("loss_orders"),
        round_half_even(F.avg(loss.cast("int")) * 100).alias("loss_percent"),
    )


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the number columns; booleans are not numbers."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


CENTRE_COPIES = 1024


def _with_centres(values: DataFrame, centres: DataFrame, has: list[str]) -> DataFrame:
    """Every row with the means of its group.

    Most rows are of one group as a rule, so its means are there in many copies and the rows meet
    them in as many places.
    """
    copies = centres.selectExpr("*", f"explode(sequence(0L, {CENTRE_COPIES - 1}L)) as copy")
    dealt = values.selectExpr("*", f"pmod(monotonically_increasing_id(), {CENTRE_COPIES}L) as copy")
    return dealt.join(copies, [*has, "copy"])


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of all pairs, each over the rows where both are present.

    Rows are grouped by which columns they have, so inside a group no sum needs a null test
    per pair, and plain sums of products are enough for every pair at once. They stay within
    generated code, unlike one `corr` per pair, whose buffers outgrow it. Values are taken from
    the mean of their own group, found by a pass over all rows, and the groups are put together
    by their means, so large values with a small spread lose no digits. The result has one row
    per ordered pair, NULL where a column does not vary.
    """
    columns = columns or numeric_columns(df)
    at = range(len(columns))
    pairs = [(i, j) for i in at for j in at if i <= j]
    # One bit per column that is present, in as many long numbers as that takes.
    bits = [f"if(x{i} is null, 0L, {1 << (i % 62)}L)" for i in at]
    has = [f"has{k}" for k in at[::62]]
    values = df.selectExpr(
        *[f"nullif(cast({quoted(c)} as double), double('NaN')) as x{i}" for i, c in enumerate(columns)]
    ).selectExpr("*", *[f"{' + '.join(bits[k : k + 62])} as has{k}" for k in at[::62]])
    centres = values.groupBy(*has).agg(
        *[F.expr(f"{f}(x{i}) as {f}{i}") for f in ("avg", "min", "max") for i in at]
    )
    shifted = _with_centres(values, centres, has).selectExpr(
        *has, *[f"x{i} - avg{i} as x{i}" for i in at]
    )
    moments = shifted.groupBy(*has).agg(
        F.expr("count(1) as n"),
        *[F.expr(f"sum(x{i}) as s{i}") for i in at],
        *[F.expr(f"sum(x{i} * x{j}) as p{i}_{j}") for i, j in pairs],
    ).join(centres, has)
    one_pair = (
        "named_struct('i', {i}, 'j', {j}, 'sx', s{i}, 'sy', s{j}, 'sxx', p{i}_{i}, 'syy', p{j}_{j},"
        " 'sxy', p{i}_{j}, 'mx', avg{i} + s{i} / n, 'my', avg{j} + s{j} / n,"
        " 'lox', min{i}, 'hix', max{i}, 'loy', min{j}, 'hiy', max{j})"
    )
    listed = ", ".join(one_pair.format(i=i, j=j) for i, j in pairs)
    # One row per pair and group here: as many as there are sets of present columns.
    whole = "over (partition by i, j)"
    per_pair = (
        moments.selectExpr("n", f"inline(array({listed}))")
        .where("sx is not null and sy is not null")
        .selectExpr(
            "*", f"mx - sum(n * mx) {whole} / sum(n) {whole} as dx",
            f"my - sum(n * my) {whole} / sum(n) {whole} as dy",
        )
        .groupBy("i", "j")
        .agg(
            F.expr("sum(sxx - sx * sx / n + n * dx * dx) as cxx"),
            F.expr("sum(syy - sy * sy / n + n * dy * dy) as cyy"),
            F.expr("sum(sxy - sx * sy / n + n * dx * dy) as cxy"),
            F.expr("min(lox) < max(hix) and min(loy) < max(hiy) as varies"),
        )
    )
    names = ", ".join("'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'" for c in columns)
    return per_pair.selectExpr(
        "case when not varies then null when i = j then 1D"
        " else cxy / (sqrt(cxx) * sqrt(cyy)) end as correlation",
        "explode(if(i = j, array(array(i, j)), array(array(i, j), array(j, i)))) as place",
    ).selectExpr(
        f"get(array({names}), place[0]) as column_a",
        f"get(array({names}), place[1]) as column_b",
        "correlation",
    )


def top_by(df: DataFrame, order: list[Column], n: int = 10) -> DataFrame:
    """First `n` rows in a total order, planned as a top-k without a full sort."""
    return df.orderBy(*order).limit(n)


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The `n` most frequent values, ties in value order."""
    return (
        df.where(present(df, column))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
        .limit(n)
    )


def keep_top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Rows whose value is among the `n` most frequent.

    The list of values has at most `n` rows by construction, so it is broadcast.
    """
    top = top_values(df, column, n).select(column)
    return df.join(F.broadcast(top), column, "left_semi")


def axis_max(df: DataFrame, columns: list[str]) -> DataFrame:
    """Largest number over several columns."""
    return df.agg(F.greatest(*[F.max(quoted(c)) for c in columns]).alias("axis_max"))


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Root of the mean squared error as one plain aggregate."""
    error = F.col(quoted(label)) - F.col(quoted(prediction))
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def category_frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts of every value of several category columns, in one scan."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("category"), F.col(quoted(c)).alias("label")) for c in columns]
    )
    # Combinations are counted first, so the unfolding works on counts and not on rows.
    joint = df.groupBy(*[F.col(quoted(c)) for c in columns]).agg(F.count(F.lit(1)).alias("n"))
    return (
        joint.select(F.explode(pairs).alias("pair"), "n")
        .select("pair.category", "pair.label", "n")
        .where(F.col("label").isNotNull())
        .groupBy("category", "label")
        .agg(F.sum("n").alias("n"))
    )
