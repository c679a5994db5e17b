"""Nulls, empty and repeated rows, ties, empty tables and clashing column names."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tiffin.llm import (
    anchors, chunked, exact, inner_search, languages, mixing, pieces, simhash, suffixes, token_counts, urls,
)
from tiffin.llm.deep_shallow import sort_windows

PASSAGE = " ".join(f"word{i}" for i in range(70))
SCHEMA = "doc_id long, text string, lang string, source string, id long, th int, found string, fp long"
ROWS = [
    (None, PASSAGE), (1, None), (2, ""), (3, "..."), (4, PASSAGE), (5, "x " + PASSAGE + " y"),
    (5, "x " + PASSAGE + " y"), (6, PASSAGE.upper()), (7, "a" * 300), (8, "b" + "a" * 200),
    (9, PASSAGE + "\n" + PASSAGE), (None, None), (10, "é　ß " * 60), (11, "é　ß " * 60),
]
MODEL = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

OPERATORS = {
    "encode": lambda d: pieces.encode(d, MODEL),
    "count": lambda d: token_counts.count_tokens(d, VOCABULARY),
    "mix": lambda d: mixing.copies(*mixing.mixing_plan(d)),
    "words": anchors.remove_repeats,
    "exact": exact.exact_duplicates,
    "simhash": simhash.near_duplicates,
    "similar": lambda d: simhash.near_duplicates(d, 5, simhash.SIMILAR),
    "language": lambda d: languages.identify(d, languages.train(d, F.lit(True))),
    "bytes": suffixes.remove_repeats,
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i and i % 2 else None, None, 9, 9, "f", 9) for i, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document(docs, name):
    got = [r["id"] for r in OPERATORS[name](docs).collect()]
    assert sorted(got, key=str) == sorted((i for i, _ in ROWS), key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


def test_removed_words_and_bytes(docs):
    texts = [(t or "").encode() for _, t in ROWS]
    split = [(i, t.split()) for (i, _), t in zip(ROWS, texts, strict=True)]
    raw = [(i, t) for (i, _), t in zip(ROWS, texts, strict=True)]
    want = sorted((str(i), sum(g)) for (i, _), g in zip(split, brute.covered(split, 50), strict=True))
    got = anchors.remove_repeats(docs).collect()
    assert sorted((str(r["id"]), r["n_removed"]) for r in got) == want
    want = sorted((str(i), sum(g)) for (i, _), g in zip(raw, brute.covered(raw, 50), strict=True))
    got = suffixes.remove_repeats(docs).collect()
    assert sorted((str(r["id"]), sum(s["end"] - s["first"] for s in r["spans"])) for r in got) == want


@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_removed_bytes_of_random_texts(spark, letters):
    chance = random.Random(len(letters))
    pool = ["".join(chance.choices(letters, k=90)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [chance.choice(pool)[chance.randrange(30):] + chance.choice(letters)
                 for _ in range(chance.randrange(5))]
        rows.append((i, "".join(parts)))
    raw = [(i, t.encode()) for i, t in rows]
    got = {r["id"]: r for r in suffixes.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    for (i, text), gone in zip(raw, brute.covered(raw, 50), strict=True):
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        assert bytes(got[i]["kept"]) == kept


def candidates(texts):
    """The candidate windows of texts that are each a chunk of their own."""
    parts = [suffixes.segments(t, 50, 16) for t in texts]
    rows = [
        {"token": at} | dict(zip("abc", suffixes.packed_segments(
            np.stack((anchor, whole), axis=1), flanks, np.arange(len(anchor)),
            np.full(len(anchor), at)), strict=True))
        for at, (anchor, whole, flanks, _, _) in enumerate(parts)
    ]
    out = chunked.Rows()
    suffixes.compare_segments(rows, out)
    judge, found = suffixes.judge_segments(50, 16), []
    for at, (anchor, _, _, sizes, before) in enumerate(parts):
        replies = [dict(zip("abc", r[5:], strict=True)) for r in out.rows if r[1] == at]
        row = {"a": chunked.runs(np.arange(len(anchor))).tobytes(), "c": bytes(len(anchor) // 8 + 1),
               "b": np.concatenate((sizes, before)).astype(np.uint8).tobytes()}
        spans = suffixes.spans_of(judge(row, suffixes.segment_flags(replies)))[1]
        found.append({x for a, b in spans.tolist() for x in range(a, b)})
    return found


def test_only_windows_with_a_shared_flank_are_candidates():
    chance = random.Random(3)
    texts = [chance.randbytes(400), chance.randbytes(400)]
    common = chance.randbytes(60)
    # 30 bytes hold an anchor now and then but never an anchor with a flank of 17 bytes.
    assert candidates([t[:200] + common[:30] + t[200:] for t in texts]) == [set(), set()]
    first, second = candidates([t[:200] + common + t[200:] for t in texts])
    assert set(range(200, 211)) <= first and set(range(200, 211)) <= second
    assert max(len(first), len(second)) < 60


@pytest.mark.parametrize("values", [
    [0], [7, 7], [-3, 252], [5, 70_000], [-(1 << 31), (1 << 31) - 1], [1 << 40, -(1 << 40)],
    [-(1 << 63), (1 << 63) - 1],
])
def test_packed_numbers(values):
    assert chunked.unpack(chunked.pack(np.array(values, np.int64))).tolist() == values


def test_deep_shallow_order():
    chance = np.random.default_rng(5)
    windows = chance.integers(97, 99, (400, 50)).astype(np.uint8)
    windows[:, :45] = windows[chance.integers(0, 9, 400), :45]
    windows = np.concatenate((windows, windows[:50]))
    order, fresh = sort_windows(windows)
    lines = [windows[i].tobytes() for i in order]
    assert lines == sorted(w.tobytes() for w in windows)
    assert fresh.tolist() == [i == 0 or a != lines[i - 1] for i, a in enumerate(lines)]


def test_covers():
    assert anchors.is_cover(anchors.COVER, anchors.PERIOD)
    assert not anchors.is_cover((0, 1, 2), 31)


def test_search_with_odd_vectors(spark):
    chance = np.random.default_rng(3)
    vectors = [chance.normal(size=8) * 2.0 ** (i % 5) for i in range(300)]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 8), (303, [float("inf")] * 8),
             (None, vectors[0].tolist()), (400, vectors[0].tolist()), (400, vectors[0].tolist()),
             (500, [0.0] * 8), (501, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in inner_search.top_k(frame, F.col("id") % 100 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    usable = [(i, [int(np.floor(x * 1024)) for x in v]) for i, v in rows
              if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    assert sorted(got) == [0, 100, 200, 400, 500]
    for at, (query, x) in enumerate(usable):
        if query in (0, 100, 200, 500):
            scores = [(-sum(a * b for a, b in zip(x, y, strict=False)), i is None, i or 0)
                      for j, (i, y) in enumerate(usable) if j != at]
            want = [(None if n else i, -s) for s, n, i in sorted(scores)[:10]]
            assert [(i, s) for _, i, s in sorted(got[query])] == want
    assert len(got[400]) == 20


@pytest.mark.parametrize("size", [2000.0, 1e6, 2.0**40, 1e30, 1e200])
def test_search_with_large_components(spark, size):
    chance = np.random.default_rng(6)
    rows = [(i, chance.normal(size=4).tolist()) for i in range(40)]
    rows += [(100, [size, 0.0, -size / 3, 1.0]), (101, [size, 1.0, 0.0, 0.0]), (102, [-size, 5.0, 0.0, 2.0]),
             (200, [1e6, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in inner_search.top_k(frame, F.col("id") % 100 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    whole = {i: [int(np.floor(x * 1024)) for x in v] for i, v in rows}
    assert sorted(got) == [0, 100, 200]
    for query in got:
        scores = sorted((-sum(a * b for a, b in zip(whole[query], v, strict=True)), i)
                        for i, v in whole.items() if i != query)[:10]
        want = [(n + 1, i, -s if -s < 1 << 63 and -s >= -(1 << 63) else None)
                for n, (s, i) in enumerate(scores)]
        assert sorted(got[query]) == want


def test_search_without_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert inner_search.top_k(empty, F.col("id") % 100 == 0).count() == 0


def test_language_without_labels_or_letters(spark, docs):
    got = languages.identify(docs, languages.train(docs, F.lit(False))).collect()
    assert {r["lang_pred"] for r in got} == {"und"} and {r["score"] for r in got} == {0.0}
    one = languages.identify(docs, languages.train(docs, F.lit(True))).collect()
    by_id = {r["id"]: r["lang_pred"] for r in one}
    assert by_id[3] == by_id[1] == "und" and by_id[4] == "en"


def test_urls_without_rows_or_parts(spark):
    schema = "page_id long, url string, html string, host string, verdict string"
    assert urls.judge(spark.createDataFrame([], schema), (("allow", "com", "/"),)).count() == 0
    rows = [(1, None, None, "h", "v"), (None, "no scheme", "", "h", "v"),
            (2, "http://A.COM", None, "h", "v"), (2, "http://b.com/x?y", "<a>", "h", "v")]
    got = urls.judge(spark.createDataFrame(rows, schema), (("block", "com", "/"),)).collect()
    assert sorted((r["host"], r["path"], r["rule"] or "") for r in got) == [
        ("", "", ""), ("", "", ""), ("a.com", "", ""), ("b.com", "/x", "com/")]


def test_similar_documents_share_four_fifths_of_their_shingles(spark):
    """Of 100 edits each at similarities around 0.87 and 0.72, the first are found alone."""
    rows, pairs = [], {}
    for i in range(200):
        words = [f"w{i}x{j}" for j in range(300)]
        edited = list(words)
        for j in range(4 if i < 100 else 10):
            edited[20 + 25 * j] = "edited"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(edited))]
        pairs[2 * i] = brute.similarity(*(brute.shingles(t, 5) for _, t in rows[-2:]))
    assert min(list(pairs.values())[:100]) > 0.8 > 0.75 > max(list(pairs.values())[100:])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {
        r["id"]: r["component_id"]
        for r in simhash.near_duplicates(docs, 5, simhash.SIMILAR).collect()
    }
    assert len(got) == 400
    assert all(got[i] in (i, i - i % 2) for i in got)
    assert sum(got[i + 1] == i for i in list(pairs)[:100]) >= 97
    assert not any(got[i + 1] == i for i in list(pairs)[100:])


def test_every_match_around_the_similarity_is_judged(spark):
    """A refuted match must not stand for a true one that it displaced."""
    rng = random.Random(5)
    texts = []
    for group in range(40):
        base = [f"w{group}x{i}" for i in range(100)]
        edits = [(rng.randrange(5, 95), f"e{group}x{i}") for i in range(12)]
        for _ in range(12):
            words = list(base)
            for at, word in rng.sample(edits, rng.choice((2, 3, 4))):
                words[at] = word
            texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = simhash.SIMILAR
    items = []
    for text in texts:
        hashes = simhash.shingle_hashes(text.encode(), 5)
        fps = [f & (1 << 64) - 1 for f in simhash.long_fingerprint(hashes, index)]
        items.append((fps, brute.shingles(text, 5)))

    def linked(a, b):
        differ = [f ^ g for f, g in zip(a[0], b[0], strict=True)]
        meet = any(
            (differ[word] >> low & (1 << width) - 1).bit_count() <= index.radius
            for word, low, width in index.segments
        )
        close = sum(d.bit_count() for d in differ) <= index.distance
        return close and meet and brute.similarity(a[1], b[1]) >= index.similarity

    got = {r["id"]: r["component_id"] for r in simhash.near_duplicates(docs, 5, index).collect()}
    wanted = brute.component_ids(list(range(len(texts))), items, linked)
    assert [got[i] for i in range(len(texts))] == wanted
