"""Token counts by rank-synchronous merging.

The pre-tokens of a batch of texts are held as ragged byte-symbol arrays; `merge_rounds.merge`
applies each sequence's lowest-rank pair in all of them at once, and the surviving symbols are
counted. Read are byte-level BPE files with a word-end suffix, whose normaliser composes (NFC),
joins blanks and lower-cases; anything else is refused when the file is read.

Defined results: a null text counts as empty and has no tokens and no bytes. Strings of special
tokens inside a text count as one token each, the library's default. Each input row gives one
output row. Other columns of the input are not carried on, so their names cannot clash.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.common import slices
from tiffin.llm.merge_rounds import Pairs, merge

# str.split() also cuts at these four, which are no blanks for the tokenizer.
_separators = re.compile("[\x1c-\x1f]")
_blanks = re.compile(r"[^\S\x1c-\x1f]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class Counter:
    """A tokenizer file as arrays, with the counts of words seen before."""

    def __init__(self, data: bytes, limit: int = 400_000):
        spec = json.loads(data)
        model = spec["model"]
        normal = [n["type"] for n in spec["normalizer"]["normalizers"]]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if (
            model["type"] != "BPE" or model["dropout"] or model["continuing_subword_prefix"]
            or model["byte_fallback"] or model["ignore_merges"]
            or normal != ["NFC", "Replace", "Lowercase"]
            or [s["type"] for s in steps] != ["Split", "ByteLevel"]
            or not (steps[0]["behavior"] == "Removed" and steps[0]["invert"])
            or steps[1]["add_prefix_space"] or steps[1]["use_regex"]
            or any(t["normalized"] or t["single_word"] for t in spec["added_tokens"])
        ):
            raise ValueError("this kind of tokenizer file is not supported")
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + end] for c in letters], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.pairs = Pairs(
            [vocab[a] for a, _ in merges], [vocab[b] for _, b in merges],
            np.arange(len(merges)), [vocab[a + b] for a, b in merges], max(vocab.values()) + 1,
        )
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        specials = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(specials)) if specials else None
        self.limit = limit
        self.known: dict[str, int] = {}

    def pre_tokens(self, word: str) -> list[str]:
        if not word.isascii():
            # Lower-casing is letter by letter: a capital sigma never becomes a final one.
            word = unicodedata.normalize("NFC", word).replace("Σ", "σ")
        return self.pattern.findall(word.lower())

    def merged_sizes(self, tokens: list[str]) -> np.ndarray:
        """How many symbols survive of each pre-token."""
        raw = [t.encode() for t in tokens]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[data[ends]]
        return merge(self.pairs, symbols, sizes)[1]

    def _learn(self, words: list[str]) -> None:
        """Count new words; words are free of blanks."""
        extra, parts = np.zeros(len(words), np.int64), []
        for i, word in enumerate(words):
            if self.special is not None and "<" in word and self.special.search(word):
                extra[i] = len(self.special.findall(word))
                pieces = self.special.split(word)
                parts.append([t for piece in pieces for t in self.pre_tokens(piece)])
            else:
                parts.append(self.pre_tokens(word))
        unique = {t: 0 for part in parts for t in part}
        if unique:
            sizes = self.merged_sizes(list(unique)).tolist()
            unique = dict(zip(unique, sizes, strict=True))
        for word, part, more in zip(words, parts, extra.tolist(), strict=True):
            self.known[word] = more + sum(map(unique.__getitem__, part))

    def counts(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        parts = [
            _blanks.split(t) if _separators.search(t) else t.split() for t in texts
        ]
        words = [w for part in parts for w in part]
        if len(self.known) > self.limit:
            self.known.clear()
        each = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(each < 0).tolist()
        if missing:
            self._learn(list(dict.fromkeys([words[i] for i in missing])))
            each[missing] = [self.known[words[i]] for i in missing]
        totals = np.concatenate(([0], np.cumsum(each)))
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        return np.diff(totals[ends], prepend=0)


_counters: dict[bytes, Counter] = {}


def counter_of(data: bytes) -> Counter:
    """The counter, read once per Python process."""
    if data not in _counters:
        _counters[data] = Counter(data)
    return _counters[data]


def count_tokens(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    limit: int = 2048,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row."""
    # The file is of fixed size, about two megabytes.
    data = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_bytes())
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("n_bytes", T.LongType(), False),
            T.StructField("n_tokens", T.LongType(), False),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(data.value)
        for batch in slices(batches, "text"):
            column = batch.column("text")
            tokens = counter.counts([t or "" for t in column.to_pylist()])
            size = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), size, pa.array(tokens)], ["id", "n_bytes", "n_tokens"]
            )

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, schema).withColumn(
        "over_limit", F.col("n_tokens") > F.lit(limit)
    )
