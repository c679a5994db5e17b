"""Every query of the training-data operators against SQL, a library or plain loops."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from tests.oracle import compare, connect
from tiffin.llm import languages
from tiffin.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


def rows_of(spark, sf_dir, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, sf_dir).collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), name, QUERIES[name], ORACLES[name], sf_dir) is None


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_sentencepiece_equals_the_library(spark, sf_dir, docs):
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = rows_of(spark, sf_dir, "op1_sentencepiece")
    assert len(got) == len(docs)
    for row in docs:
        ids = library.encode(row["text"] or "")
        assert got[row["doc_id"]][1:] == (
            len(ids), brute.sha(",".join(map(str, ids)).encode()),
            brute.sha(library.decode(ids).encode()))


def test_token_counts_equal_the_library(spark, sf_dir, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = rows_of(spark, sf_dir, "op8_token_counts")
    for row in docs:
        text = row["text"] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert tuple(got[row["doc_id"]][k] for k in ("n_bytes", "n_tokens", "over_limit")) == (
            len(text.encode()), n, n > 2048)


def test_simhash_equals_all_pairs(spark, sf_dir, docs):
    got = rows_of(spark, sf_dir, "op7_simhash_dedup")
    ids, fps = [r["doc_id"] for r in docs], [brute.fingerprint(r["text"]) for r in docs]
    assert [got[i]["fingerprint"] for i in ids] == [f"{f:016x}" for f in fps]
    assert [got[i]["component_id"] for i in ids] == brute.component_ids(ids, fps)


def test_byte_removal_equals_plain_loops(spark, sf_dir, docs):
    got = rows_of(spark, sf_dir, "op10_suffix_dedup")
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs]
    assert any(r["n_removed"] for r in got.values())
    for (id_, text), gone in zip(rows, brute.covered(rows, 50), strict=True):
        spans = sum(g and not before for g, before in zip(gone, [False, *gone], strict=False))
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        assert tuple(got[id_][k] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) == (
            len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest())


def test_language_of_held_out_documents(spark, sf_dir, docs):
    got = rows_of(spark, sf_dir, "op9_language_id")
    truth = {r["doc_id"]: r["lang"] for r in docs if r["lang"] is not None}
    held = [r for r in got.values() if r["held_out"] and r["doc_id"] in truth]
    assert len(got) == len(docs) and len(held) > 30
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_pipeline_stage_by_stage(spark, sf_dir):
    """Each stage against plain loops over what the stage before kept."""
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    frame = source
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, sf_dir).cache()
        kept[name] = frame.collect()
        if name != "sentencepiece":
            assert frame.columns == source.columns
    before = source.collect()
    lettered = {r["doc_id"] for r in before if any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in kept["language_id"]} == lettered
    last: dict = {}
    for row in kept["language_id"]:
        key = (row["text"] or "").encode().lower()
        last[key] = max(last.get(key, row["doc_id"]), row["doc_id"])
    assert sorted(r["doc_id"] for r in kept["exact_dedup"]) == sorted(last.values())
    ids = [r["doc_id"] for r in kept["exact_dedup"]]
    sets = [brute.shingles(r["text"], 5) for r in kept["exact_dedup"]]
    first = set(brute.component_ids(ids, sets, lambda a, b: brute.similarity(a, b) >= 0.8))
    assert {r["doc_id"] for r in kept["simhash_dedup"]} == first
    words = {r["doc_id"]: len(brute.WORD.findall(r["text"].encode()))
             for r in kept["simhash_dedup"]}
    mixed = sum(words[r["doc_id"]] for r in kept["mix_sources"])
    assert abs(mixed - 1.5 * sum(words.values())) < 0.1 * sum(words.values())
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = {r["doc_id"]: r["text"] for r in before}
    assert len(kept["sentencepiece"]) == len(kept["mix_sources"])
    for row in kept["sentencepiece"]:
        assert row["ids"] == library.encode(text[row["doc_id"]])


def test_pipeline_hands_on_predictions_and_decodes(spark, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = languages.held_out(F.col("doc_id")) & F.col("lang").isNotNull()
    first = source.where(held_out).orderBy("doc_id").first()
    # A wrong label of a document that is not learned from.
    mislabelled = F.when(F.col("doc_id") == first["doc_id"], "xx").otherwise(F.col("lang"))
    rows = stages["language_id"](spark, source.withColumn("lang", mislabelled), sf_dir).collect()
    assert {r["doc_id"]: r["lang"] for r in rows}[first["doc_id"]] == first["lang"]
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for row in stages["sentencepiece"](spark, source.limit(50), sf_dir).collect():
        assert row["decoded"] == library.decode(row["ids"])
