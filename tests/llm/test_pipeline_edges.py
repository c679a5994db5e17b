"""The pipeline's stages on nulls, repeated rows, ties, empty tables and clashing names."""

from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tiffin.llm import routing

STAGES = dict(corpus_pipeline.STAGES)
EXTRA = "id long, row string, place long, row_number long, lang_pred string, score double, _hit boolean, `a.b` int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars int, {EXTRA}"
LONG = " ".join(f"w{i % 997}x{i}" for i in range(120_000))
NEAR = " ".join(f"near{i}" for i in range(200))
TEXTS = [
    (1, "the house and the garden", "en"), (2, "The House and the GARDEN", "en"), (None, "the house and the garden", "en"),
    (3, None, "en"), (4, "", None), (5, "... 123", "en"), (6, NEAR, "en"), (7, NEAR + " end", "en"),
    (7, NEAR + " end", "en"), (8, LONG, "en"), (None, NEAR + " more", None), (9, "das haus und der garten", "de"),
    (10, "das haus und der garten", "de"), (11, "das haus und der garten", "de"),
]


def table(spark, rows):
    data = [
        (i, t, lang, None if i == 9 else "s", at, at, f"r{at}", at, -at, f"p{at}", at / 2, None, at)
        for at, (i, t, lang) in enumerate(rows)
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module", params=["memory", "files"])
def docs(request, spark):
    rows = table(spark, TEXTS)
    if request.param == "memory":
        return rows
    from tiffin.session import work_path

    path = work_path(spark, "edge-docs")
    rows.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def kept(stage, spark, docs):
    """The rows' numbers; every other column but `lang` must have come through unchanged."""
    rows = STAGES[stage](spark, docs, "")
    assert rows.columns == docs.columns
    names = [F.col(f"`{c}`") for c in docs.columns if c != "lang"]
    assert rows.select(*names).exceptAll(docs.select(*names)).count() == 0
    return sorted(r["n_chars"] for r in rows.select("n_chars").collect())


def test_language_id_drops_what_has_no_letters(spark, docs):
    assert kept("language_id", spark, docs) == [at for at in range(len(TEXTS)) if at not in (3, 4, 5)]


def test_exact_dedup_keeps_the_largest_id(spark, docs):
    got = kept("exact_dedup", spark, docs)
    # Null and empty texts are equal; the third is a null id, which is picked last.
    assert [at for at in got if at not in (7, 8)] == [1, 4, 5, 6, 9, 10, 13]
    assert len([at for at in got if at in (7, 8)]) == 1


def test_near_dedup_keeps_the_smallest_id(spark, docs):
    got = kept("simhash_dedup", spark, docs)
    # Lower-cased copies, texts without words, and the near copies are a group each.
    assert got == [0, 3, 5, 6, 9, 11]


def test_mixing_repeats_whole_rows(spark, docs):
    got = kept_counts = STAGES["mix_sources"](spark, docs, "")
    assert got.columns == docs.columns
    assert kept_counts.groupBy("n_chars").count().agg(F.max("count")).first()[0] <= 2


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_table(spark, name):
    empty = table(spark, TEXTS).where("false")
    assert STAGES[name](spark, empty, "").count() == 0


def test_only_possible_partners_pass(spark):
    rows = spark.range(5000).withColumnRenamed("id", "n")
    keys = spark.range(0, 5000, 50).withColumnRenamed("id", "k")
    marked = routing.may_match(rows, F.col("n"), keys, "hit")
    assert marked.count() == 5000
    assert marked.where("hit AND n % 50 = 0").count() == 100
    assert marked.where("hit").count() < 110
    assert routing.without(rows, "n", keys).count() == 4900
    assert routing.without(rows, "n", keys.where("false")).count() == 5000
