from __future__ import annotations

import math
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiffin.operators import boxes, profile


def brute_box(values):
    """Box statistics of one list, by sorting it."""
    values = sorted(values)
    series = pd.Series(values)
    q1, median, q3 = (float(series.quantile(q)) for q in (0.25, 0.5, 0.75))
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = [v for v in values if low <= v <= high]
    whisker_low = min([q1, *inside])
    whisker_high = max([q3, *inside])
    outliers = sum(v < whisker_low or v > whisker_high for v in values)
    return len(values), q1, median, q3, whisker_low, whisker_high, outliers


def check_boxes(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: tuple(r)[1:] for r in boxes.box_stats(df, {"g": F.col("g")}, F.col("v")).collect()}
    groups: dict[str, list[float]] = {}
    for g, v in rows:
        if g is not None and v is not None and not math.isnan(v):
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g] == pytest.approx(brute_box(values), rel=1e-12, abs=1e-12), g


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(
                st.none(),
                st.integers(-50, 50).map(float),
                st.floats(-1e4, 1e4, allow_nan=False).map(lambda x: round(x, 3)),
            ),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_boxes_equal_sorting(spark, rows):
    check_boxes(spark, rows)


def test_box_of_one_hot_group(spark):
    random.seed(3)
    rows = [("hot", random.gauss(40, 10)) for _ in range(3000)]
    rows += [(f"g{i}", float(i)) for i in range(50)]
    rows += [("same", 5.0)] * 20 + [("odd", 0.0), ("odd", 10.0), ("odd", 10.0), ("odd", 10.0)]
    rows += [("nan", float("nan")), ("nan", 1.0)]
    check_boxes(spark, rows)


def test_report_equals_single_boxes(spark):
    rows = [(i % 3 == 0, f"p{i % 4}", float((i * 37) % 101)) for i in range(500)]
    df = spark.createDataFrame(rows, "flag boolean, pay string, v double")
    by = {"flag": F.col("flag"), "pay": F.col("pay")}
    report = {(r[0], r[1]): tuple(r)[2:] for r in boxes.box_report(df, by, F.col("v")).collect()}
    for name in by:
        for r in boxes.box_stats(df, {name: by[name]}, F.col("v")).collect():
            key = str(r[0]).lower() if name == "flag" else r[0]
            assert report.pop((name, key)) == tuple(r)[1:]
    assert not report


def test_correlation_equals_pandas_with_gaps(spark):
    random.seed(5)
    data = {
        "a": [random.gauss(1e6, 3) if i % 7 else None for i in range(300)],
        "b": [random.random() if i % 5 else None for i in range(300)],
        "same": [4.25] * 300,
        "sparse": [float(i) if i < 2 else None for i in range(300)],
        "n": list(range(300)),
    }
    data["c"] = [None if x is None else x * 2 + random.random() for x in data["b"]]
    frame = pd.DataFrame(data)
    expected = frame.corr()
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]
    rows = [(*r[:4], int(r[4]), r[5], True) for r in rows]
    df = spark.createDataFrame(rows, "a double, b double, same double, sparse double, n int, c double, flag boolean")
    got = {(r[0], r[1]): r[2] for r in profile.correlation_matrix(df).select("column_a", "column_b", "correlation").collect()}
    for x in expected.columns:
        for y in expected.columns:
            want = expected.loc[x, y]
            if math.isnan(want):
                assert got.get((x, y)) is None, (x, y)
            else:
                assert got[x, y] == pytest.approx(want, abs=1e-9), (x, y)
    assert not any("flag" in pair for pair in got)


def test_correlation_treats_nan_as_missing(spark):
    rows = [(1.0, 2.0), (2.0, 4.0), (float("nan"), 100.0), (3.0, 6.5)]
    df = spark.createDataFrame(rows, "x double, `it's` double")
    got = {(r[0], r[1]): r[2] for r in profile.correlation_matrix(df).select("column_a", "column_b", "correlation").collect()}
    want = pd.DataFrame(rows, columns=["x", "y"]).corr().loc["x", "y"]
    assert got["x", "it's"] == pytest.approx(want)


def test_counts_leave_out_missing_and_means_keep_them(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 3.0), ("a", 2.0), ("b", None)], "o string, profit double")
    assert [tuple(r) for r in profile.value_counts(df, "o").collect()] == [("a", 2), ("b", 1)]
    means = [tuple(r) for r in profile.group_mean(df, "o", "profit").collect()]
    assert sorted(means, key=str) == sorted([("a", 1.5), ("nan", 3.0), ("b", None)], key=str)
    summary = profile.profit_summary(df).first()
    assert tuple(summary) == (2.0, 0, 0.0)


def test_summary_equals_report(spark):
    from tiffin.plans import report

    df = spark.createDataFrame(
        [("a", -1.0), (None, 3.0), ("a", 2.125), ("b", None)], "discounts_and_offers string, profit double"
    )
    rollup = report.offer_rollup(df)
    assert tuple(report.profit_totals(rollup).first()) == tuple(profile.profit_summary(df).first())
    assert sorted(map(tuple, report.offer_means(rollup).collect()), key=str) == sorted(
        map(tuple, profile.group_mean(df, "discounts_and_offers", "profit").collect()), key=str
    )


def test_top_lists_break_ties_by_value(spark):
    df = spark.createDataFrame([(x,) for x in "bbaaccd"], "k string")
    assert [tuple(r) for r in profile.top_values(df, "k", 2).collect()] == [("a", 2), ("b", 2)]
    assert profile.keep_top_values(df, "k", 2).count() == 4


def test_category_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x")], "p string, q string")
    got = {tuple(r) for r in profile.category_frequencies(df, ["p", "q"]).collect()}
    assert got == {("p", "a", 2), ("p", "b", 1), ("q", "x", 2)}


@pytest.mark.parametrize("start, size", [("NULL", 1e9), ("0", 1e6)])
def test_correlation_of_large_values_with_an_untypical_start(spark, start, size):
    from tiffin.operators.profile import correlation_matrix

    rows = spark.range(20_000, numPartitions=1).selectExpr(
        f"if(id < 1000, {start}, {size} + id % 7) as a",
        f"if(id < 1000, NULL, {size} + id % 7 + 0.1 * (id % 5)) as b",
    )
    got = {(r["column_a"], r["column_b"]): r["correlation"] for r in correlation_matrix(rows).collect()}
    want = rows.where("a IS NOT NULL AND b IS NOT NULL").selectExpr(
        f"corr(a - {size}, b - {size})").first()[0]
    assert got["a", "b"] == pytest.approx(want, abs=1e-9)


def test_a_missing_refund_is_no_refund(spark):
    from tiffin.functions.ledger import is_refunded

    rows = spark.createDataFrame([(1.0,), (0.0,), (None,)], "refunds double")
    assert [r[0] for r in rows.select(is_refunded(F.col("refunds"))).collect()] == [True, False, False]
