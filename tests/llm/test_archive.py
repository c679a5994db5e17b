"""Archives of token ids: round trips, order, short access and the files themselves."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tiffin.llm import archive
from tiffin.llm.common import stored
from tiffin.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, id long, width int, ids binary, part int, name string, start long"
TEXTS = [
    None, "", " ", "Hello  WORLD", "<|endoftext|>x <|startoftext|>", "it's ΣΑΣ é é", "日本語 漢字",
    "a\x1cb\x1d \x85 c", "a" * 30_000, "many words " * 4000, "many words " * 4000, "\x00 nul",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def test_equal_to_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op13_token_archive"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    start = 0
    for row in sorted(docs, key=lambda r: r["doc_id"]):
        ids = ids_of(library, row["text"])
        assert tuple(got[row["doc_id"]])[1:] == (
            start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@pytest.mark.parametrize("shard_bytes", [1 << 26, 100])
def test_odd_texts_nulls_and_clashing_names(spark, folder, library, shard_bytes):
    rows = [(None if i in (2, 9) else i // 2, t, 9, 9, b"x", 9, "n", 9) for i, t in enumerate(TEXTS)]
    encoded = archive.encode(spark.createDataFrame(rows, SCHEMA).repartition(3), VOCABULARY, 2)
    dictionary = archive.train_dictionary(encoded)
    archive.write(archive.pack(encoded, dictionary), folder, dictionary, shard_bytes)
    got = sorted(archive.read(spark, folder).collect(), key=lambda r: r["start"])
    # In order, without gaps, nulls last.
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
    ids = [r["id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is None, i or 0))
    want = sorted((str(r[0]), np.array(ids_of(library, r[1]), "<u4").tobytes()) for r in rows)
    assert sorted((str(r["id"]), bytes(r["ids"])) for r in got) == want
    shards = archive.manifest(spark, folder).collect()
    assert sum(s["n_docs"] for s in shards) == len(rows)
    if shard_bytes == 100:
        assert len(shards) > 2


def test_empty_table(spark, folder):
    empty = spark.createDataFrame([], SCHEMA)
    assert archive.archived(empty, VOCABULARY, folder, 2).count() == 0


def test_one_document_without_the_others(spark, sf_dir, folder, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    encoded = stored(archive.encode(docs, VOCABULARY, 2), "ids")
    trained = archive.train_dictionary(encoded)
    archive.write(archive.pack(encoded, trained), folder, trained)
    row = spark.read.parquet(f"{folder}/dictionary").first()
    dictionary = bytes(row["dictionary"])
    assert len(dictionary) > 1000 and bytes(row["sha256"]) == archive.hashlib.sha256(dictionary).digest()
    shards = archive.manifest(spark, folder).orderBy("part", "shard").collect()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    shard = archive.Shard(f"{folder}/shards/{shards[0]['name']}", dictionary)
    place = len(shard) // 2
    id_ = shard.index.column("id")[place].as_py()
    assert shard.ids(place).tolist() == ids_of(library, text[id_])
    # The dictionary is what makes short documents small.
    plain_bytes = encoded.agg(F.sum(F.length("ids"))).first()[0]
    assert sum(s["n_bytes"] for s in shards) < 0.75 * plain_bytes
    with pytest.raises(ValueError, match="another dictionary"):
        archive.Shard(f"{folder}/shards/{shards[0]['name']}", dictionary[:-1])


def test_half_written_files_are_not_read(spark, folder):
    rows = [(i, f"text number {i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = archive.archived(docs, VOCABULARY, folder, 2).collect()
    with open(f"{folder}/shards/left-by-a-lost-task.tok", "wb") as file:
        file.write(archive.MAGIC)
    assert sorted(archive.read(spark, folder).collect()) == sorted(before)


def test_ids_wider_than_two_bytes(spark, folder):
    rows = [(1, np.array([70_000, 5], "<u4").tobytes(), 4), (2, np.array([5], "<u2").tobytes(), 2)]
    encoded = spark.createDataFrame(
        [(i, w, bytearray(b)) for i, b, w in rows], "id long, width int, ids binary")
    archive.write(archive.pack(encoded, b""), folder, b"")
    got = {r["id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in archive.read(spark, folder).collect()}
    assert got == {1: [70_000, 5], 2: [5]}


def test_the_sample_is_bounded(spark):
    rows = spark.range(10_000)
    assert 50 <= archive.sampled(rows, 100).count() <= 200
    assert archive.sampled(rows, 20_000).count() == 10_000
    assert archive.train_dictionary(spark.createDataFrame([], "ids binary")) == b""


def test_words_in_parts_are_encoded_like_whole_ones(library):
    with open(VOCABULARY, "rb") as file:
        encoder = archive.WordEncoder(file.read())
    words = ["(word)", "WORD,%%%", "don't!", "'s,", "é!", "a1b2,", "<|endoftext|>", "<|x|>,", "...", "x̌,", "ªb,", "ß-ß",
             "end.<|endoftext|>", "<|ENDOFTEXT|>", "ÀÉ.", "J̌,"]
    for texts in ([" ".join(words)], words):
        ids, sizes = encoder.encode(texts)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [i for w in want for i in w] and sizes.tolist() == list(map(len, want))
