"""Every named query against its SQL; queries without SQL must at least return rows."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect
from tiffin.catalog import ORACLES, QUERIES

WITHOUT_SQL = {"gbt_train", "score_batch", "tune_grid", "stream_score_plain"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, sf_dir, name):
    assert compare(spark, duck, name, queries()[name], oracle_sql()[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0


def test_only_the_listed_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["discounts_and_offers", "mean_profit"]
    assert df.count() > 10


def test_saved_model_predicts_the_same(spark, sf_dir):
    rows = queries()["model_save_load"](spark, sf_dir)
    assert rows.where("NOT equal").count() == 0


def test_model_beats_the_mean(spark, sf_dir):
    row = queries()["gbt_train"](spark, sf_dir).first()
    assert row["rmse"] < row["baseline_rmse"]
    assert row["n_trees"] == 20


def test_every_scored_row_has_a_prediction(spark, sf_dir):
    assert queries()["score_batch"](spark, sf_dir).where("prediction IS NULL").count() == 0
