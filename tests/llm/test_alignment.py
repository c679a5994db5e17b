"""Token alignment against plain definitions over whole texts."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tiffin.llm import alignment
from tiffin.llm.common import stored
from tiffin.llm.queries import QUERIES
from tiffin.llm.token_counts import byte_letters

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, id long, chunk long, groups string, pairs long, n_a int"
TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  ", "  a  b  ", "\n", " \n bar", "foo \n bar\t", "don't can't's",
    "<|endoftext|> and <s> or <0x41>", "x▁y", "é　ß naïve", "日本語のテキスト 漢字", "😀😀 ok", "\x1c a\x1cb \x85c",
    "a" * 5000, "word " * 300, "word " * 300, "x" * 20000 + " tail", "tab\tseparated\twords  two", "\x00 nul\x00",
]


def plain(texts: list[str | None]) -> list[tuple]:
    library = Tokenizer.from_file(A_PATH)
    library.encode_special_tokens = True
    other = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    byte_of = {c: i for i, c in enumerate(byte_letters())}
    vocabulary = {i: t for t, i in library.get_vocab().items()}
    found, holders = [], Counter()
    for text in texts:
        if not text:
            found.append(None)
            continue
        ids_a = library.encode(" " + text, add_special_tokens=False).ids
        ids_b = other.encode(text)
        raw_a = [bytes(byte_of[c] for c in vocabulary[i]) for i in ids_a]
        raw_b = [
            bytes([int(other.id_to_piece(i)[1:-1], 16)]) if other.is_byte(i)
            else other.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
        ]
        whole = (" " + text).encode()
        if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            found.append(None)
            continue
        owner_a = [k for k, r in enumerate(raw_a) for _ in r]
        owner_b = [k for k, r in enumerate(raw_b) for _ in r]
        links = [(ids_a[i], ids_b[j]) for i, j in sorted(set(zip(owner_a, owner_b, strict=True)))]
        groups, a, b = [], [], []
        for place in range(len(whole)):
            last = place + 1 == len(whole)
            end_a = last or owner_a[place] != owner_a[place + 1]
            end_b = last or owner_b[place] != owner_b[place + 1]
            a += [str(ids_a[owner_a[place]])] if end_a else []
            b += [str(ids_b[owner_b[place]])] if end_b else []
            if end_a and end_b:
                groups.append(",".join(a) + "|" + ",".join(b))
                a, b = [], []
        found.append((len(ids_a), len(ids_b), groups, links))
        holders.update(set(links))
    best = defaultdict(int)
    for (a, _), n in holders.items():
        best[a] = max(best[a], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if f is None else (
            f[0], f[1], len(f[2]), len(f[3]),
            sum(holders[link] == best[link[0]] for link in f[3]),
            sum(holders[link] for link in f[3]),
            hashlib.sha256(";".join(f[2]).encode()).hexdigest(),
        )
        for f in found
    ]


def weighed(docs):
    aligned = alignment.align(docs, A_PATH, B_PATH)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    rows = stored(aligned.withColumn("digest", digest).drop("groups"), "aligned")
    return alignment.weigh_links(rows)


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def test_equal_to_plain_definition(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op11_token_alignment"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for row, want in zip(docs, plain([r["text"] for r in docs]), strict=True):
        assert tuple(got[row["doc_id"]][c] for c in [*COLUMNS, "groups_sha256"]) == want


@pytest.mark.parametrize("parts", [1, 5])
def test_odd_texts_nulls_and_clashing_names(spark, parts):
    rows = [(None if i % 7 == 3 else i // 2, t, 9, 9, "g", 9, 9) for i, t in enumerate(TEXTS)]
    got = weighed(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    want = sorted(
        (str(r[0]), *values) for r, values in zip(rows, plain(TEXTS), strict=True)
    )
    assert sorted((str(r["id"]), *[r[c] for c in COLUMNS], r["digest"]) for r in got) == want


def test_empty_table(spark):
    assert weighed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_full_store_changes_nothing(monkeypatch):
    with open(A_PATH, "rb") as a, open(B_PATH, "rb") as b:
        aligner = alignment.Aligner(a.read(), b.read())
    texts = ["one two three", "two three four", "", "three four five"]
    before = [aligner.align([t]) for t in texts]
    monkeypatch.setattr(alignment, "STORE_UNITS", 1)
    after = [aligner.align([t]) for t in texts]
    for x, y in zip(before, after, strict=True):
        assert x[1] == y[1] and sorted(x[2].tolist()) == sorted(y[2].tolist())


def test_groups_follow_the_common_ends():
    sizes = np.array([0, 2, 2, 1, 3])
    found = alignment.Groups(np.array([1, 2, 3]), np.array([3, 2, 1]), sizes, sizes)
    assert found.cuts_a.tolist() == found.cuts_b.tolist() == [3]
    assert found.links_a.tolist() == [1, 1, 2, 2, 3] and found.links_b.tolist() == [3, 2, 2, 1, 1]
    found = alignment.Groups(np.array([1, 2, 4]), np.array([2, 1, 1, 3]), sizes, sizes)
    assert found.cuts_a.tolist() == [1, 2, 3] and found.cuts_b.tolist() == [1, 2, 4]
    assert found.links_a.tolist() == [1, 2, 4, 4] and found.links_b.tolist() == [2, 1, 1, 3]
