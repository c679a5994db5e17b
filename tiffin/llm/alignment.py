"""Alignment of two tokenizers over the same texts.

Both tokenizers spell a text out in bytes. The running sums of token lengths give the byte
offsets at which tokens end; a dictionary from end to index is built for each side, the
intersection of the two key sets, sorted, slices both id lists into groups, and each slice is
expanded into links: pairs of an A and a B token whose bytes overlap.

Texts are cut into units before a blank that follows a visible letter. No token of either side
crosses such a place, so both have an end there, and a unit is aligned the same wherever it
stands; a bounded store keeps the units seen before. Supported are a byte-level BPE file for A
and a SentencePiece BPE model without normalisation for B, which is checked when they are read.

Counts over the corpus work in chunks of some megabytes of text: a chunk sends each distinct
pair once, with the number of its documents that hold it, so a pair that a third of all
documents hold still costs one row a chunk. The totals come back to the chunks the same way.

Defined results: a text that is null, empty, or not spelled out exactly by both sides (one with
U+2581) has no tokens and zeros. A long text without blanks is one unit, encoded by the
libraries in time close to linear; one document is the unit of memory. Each input row gives one
output row, equal rows equal ones, so null and repeated ids are no concern. Other columns are
not carried on, so their names cannot clash.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.llm.common import ragged, slices, stored
from tiffin.llm.token_counts import byte_letters
from tiffin.llm.units import model_ids

BLANK = "▁"
_cut = re.compile(r" (?<=\S )")
STORE_UNITS = 250_000
STORE_VALUES = 8_000_000
LEARN_AT_ONCE = 20_000
CHUNK_BITS = 24
SLICE_BYTES = 1 << 20
CHUNK_SLICES = 8


def expand(ids_a: list[int], ids_b: list[int], ends_a: list[int], ends_b: list[int]):
    """The pairs of overlapping tokens of one slice; both sides end at the same byte."""
    links, i, j = [], 0, 0
    while i < len(ids_a) and j < len(ids_b):
        links.append((ids_a[i], ids_b[j]))
        # Inside a slice no two ends are equal but the last ones.
        if ends_a[i] <= ends_b[j]:
            i += 1
        else:
            j += 1
    return links


class Groups:
    """Two id arrays that spell the same bytes, cut into groups.

    `cuts_a` and `cuts_b` say how many ids lie before the end of each group, `links_a` and
    `links_b` hold the ids of the links, group after group, `n_links` how many each group has.
    """

    def __init__(self, ids_a, ids_b, sizes_a, sizes_b):
        ends_a, ends_b = np.cumsum(sizes_a[ids_a]), np.cumsum(sizes_b[ids_b])
        # From an end to the index behind its token.
        at_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1), strict=True))
        at_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1), strict=True))
        common = sorted(at_a.keys() & at_b.keys())
        self.cuts_a = np.fromiter(map(at_a.__getitem__, common), np.int64, len(common))
        self.cuts_b = np.fromiter(map(at_b.__getitem__, common), np.int64, len(common))
        self.n_a = np.diff(self.cuts_a, prepend=0)
        self.n_b = np.diff(self.cuts_b, prepend=0)
        # A slice with one token on a side links it with all of the other; so only slices with
        # several on both need a look at where their tokens end.
        self.n_links = self.n_a + self.n_b - 1
        first_a, first_b = self.cuts_a - self.n_a, self.cuts_b - self.n_b
        inner = ragged(np.zeros(len(common), np.int64), self.n_links)
        at = np.repeat(first_a, self.n_links) + np.where(np.repeat(self.n_a > 1, self.n_links), inner, 0)
        bt = np.repeat(first_b, self.n_links) + np.where(np.repeat(self.n_b > 1, self.n_links), inner, 0)
        places = np.cumsum(self.n_links) - self.n_links
        both = np.flatnonzero((self.n_a > 1) & (self.n_b > 1))
        at[ragged(places[both], self.n_links[both])] = 0
        bt[ragged(places[both], self.n_links[both])] = 0
        self.links_a, self.links_b = ids_a[at], ids_b[bt]
        for g in both.tolist():
            a, b = slice(first_a[g], self.cuts_a[g]), slice(first_b[g], self.cuts_b[g])
            links = expand(
                ids_a[a].tolist(), ids_b[b].tolist(), ends_a[a].tolist(), ends_b[b].tolist()
            )
            place = slice(places[g], places[g] + self.n_links[g])
            self.links_a[place], self.links_b[place] = zip(*links, strict=True)


class Aligner:
    """The two tokenizers, and the units aligned before."""

    def __init__(self, a_file: bytes, b_file: bytes):
        # Spark runs one task a core; threads of the library would only compete.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        spec = json.loads(a_file)
        steps = spec["pre_tokenizer"]
        if (
            spec["model"]["type"] != "BPE" or spec["normalizer"] or spec["post_processor"]
            or steps["type"] != "ByteLevel" or steps["add_prefix_space"] or not steps["use_regex"]
        ):
            raise ValueError("A must be a plain byte-level BPE file")
        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (1 + max(vocabulary.values()))
        for text, i in vocabulary.items():
            self.bytes_a[i] = (
                bytes(map(byte_of.__getitem__, text)) if set(text) <= byte_of.keys() else text.encode()
            )
        self.b = SentencePieceProcessor(model_proto=b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(
            BLANK in p.lstrip(BLANK) for i, p in enumerate(pieces)
            if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i))
        ) or self.b.encode("a  b") == self.b.encode("a b") or not self.b.is_byte(
            self.b.encode("\U000f0000")[-1]
        ):
            raise ValueError("B must be a plain BPE model with byte fallback")
        self.bytes_b = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.sizes_a = np.fromiter(map(len, self.bytes_a), np.int64)
        self.sizes_b = np.fromiter(map(len, self.bytes_b), np.int64)
        # An id with what follows it in the text form: A inside and at the end of a group, B
        # inside, at the end of a group and at the end of a unit.
        many_a, many_b = len(self.bytes_a), len(self.bytes_b)
        self.spelled = [f"{i}{mark}" for mark in ",|" for i in range(many_a)]
        self.spelled += [f"{i}{mark}" for mark in (",", ";", "") for i in range(many_b)]
        self.lone_blank = self.b.piece_to_id(BLANK)
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.pair_index: dict[int, int] = {}
        self.texts: list[str] = []
        self.pairs = np.zeros(0, np.int64)  # by number of the pair
        self.links = np.zeros(0, np.int32)  # numbers of pairs, unit after unit
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros((0, 5), np.int64)  # A ids, B ids, groups, links, faults

    def _spells(self, units: list[str], forms: list[list[int]], spelled: list[bytes]) -> np.ndarray:
        """Which of the units, with a blank before each, their ids spell out exactly."""
        return np.array([
            b"".join(map(spelled.__getitem__, ids)) == (" " + unit).encode()
            for unit, ids in zip(units, forms, strict=True)
        ], bool)

    def _learn(self, units: list[str]) -> None:
        """Align and hold new units, some thousands at once: the library's forms are large."""
        spaced = [" " + u for u in units]
        forms_a = model_ids(self.a.model, spaced)
        others = [i for i, form in enumerate(forms_a) if form is None]
        coded = self.a.encode_batch_fast([spaced[i] for i in others], add_special_tokens=False)
        for i, form in zip(others, coded, strict=True):
            forms_a[i] = form.ids
        forms_b = self.b.encode(units, num_threads=1)
        if "" in units:
            # Alone, an empty text has no tokens; after another unit it is a blank.
            forms_b[units.index("")] = [self.lone_blank]
        good = self._spells(units, forms_a, self.bytes_a) & self._spells(units, forms_b, self.bytes_b)
        if not good.all():
            for i in np.flatnonzero(~good).tolist():
                forms_a[i] = forms_b[i] = []
        sizes_a = np.fromiter(map(len, forms_a), np.int64, len(units))
        sizes_b = np.fromiter(map(len, forms_b), np.int64, len(units))
        ids_a = np.fromiter(chain.from_iterable(forms_a), np.int64, int(sizes_a.sum()))
        ids_b = np.fromiter(chain.from_iterable(forms_b), np.int64, int(sizes_b.sum()))
        # All units lie one after the other: both sides end where a unit ends.
        groups = Groups(ids_a, ids_b, self.sizes_a, self.sizes_b)
        last = np.searchsorted(groups.cuts_a, np.cumsum(sizes_a), side="right")
        n_groups = np.diff(last, prepend=0)
        n_links = np.diff(np.concatenate(([0], np.cumsum(groups.n_links)))[last], prepend=0)

        codes = np.zeros(len(ids_a) + len(ids_b), np.int64)
        of_a, of_b = ids_a.copy(), ids_b + 2 * len(self.bytes_a)
        of_a[groups.cuts_a - 1] += len(self.bytes_a)
        of_b[groups.cuts_b - 1] += len(self.bytes_b)
        of_b[(np.cumsum(sizes_b) - 1)[good]] += len(self.bytes_b)
        codes[np.arange(len(ids_a)) + np.repeat(groups.cuts_b - groups.n_b, groups.n_a)] = of_a
        codes[np.arange(len(ids_b)) + np.repeat(groups.cuts_a, groups.n_b)] = of_b
        parts = list(map(self.spelled.__getitem__, codes.tolist()))
        ends = np.cumsum(sizes_a + sizes_b).tolist()
        self.texts.extend("".join(parts[lo:hi]) for lo, hi in zip([0, *ends], ends, strict=False))

        keys, numbers = np.unique(groups.links_a << 32 | groups.links_b, return_inverse=True)
        known = [self.pair_index.setdefault(k, len(self.pair_index)) for k in keys.tolist()]
        links = np.array(known, np.int32)[numbers]
        begin = len(self.index)
        self.index.update(zip(units, range(begin, begin + len(units)), strict=True))
        self.starts = np.concatenate((self.starts, np.cumsum(n_links) - n_links + len(self.links)))
        self.counts = np.concatenate(
            (self.counts, np.stack((sizes_a, sizes_b, n_groups, n_links, ~good), axis=1))
        )
        self.links = np.concatenate((self.links, links))

    def align(self, texts: list[str]):
        """Per text: counts (A ids, B ids, groups, links), the groups as text, and the distinct
        pairs with the number of links of each, flat and with their number per text."""
        if len(self.index) > STORE_UNITS or len(self.links) > STORE_VALUES:
            self._clear()
        parts = [_cut.split(t) if t else [] for t in texts]
        units = list(chain.from_iterable(parts))
        rows = np.fromiter(map(self.index.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(rows < 0).tolist()
        if missing:
            new = list(dict.fromkeys([units[i] for i in missing]))
            for at in range(0, len(new), LEARN_AT_ONCE):
                self._learn(new[at : at + LEARN_AT_ONCE])
            self.pairs = np.fromiter(self.pair_index, np.int64, len(self.pair_index))
            rows[missing] = [self.index[units[i]] for i in missing]
        per_text = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(per_text)
        running = np.concatenate((np.zeros((1, 5), np.int64), np.cumsum(self.counts[rows], axis=0)))
        counts = running[ends] - running[ends - per_text]
        good = counts[:, 4] == 0
        counts = np.where(good[:, None], counts[:, :4], 0)
        chosen = rows.tolist()
        groups = [
            ";".join(map(self.texts.__getitem__, chosen[hi - n : hi])) if fine else ""
            for hi, n, fine in zip(ends.tolist(), per_text.tolist(), good.tolist(), strict=True)
        ]
        owner = np.repeat(np.arange(len(texts)), per_text)
        fine = good[owner]
        rows, owner = rows[fine], owner[fine]
        sizes = self.counts[rows, 3]
        links = self.links[ragged(self.starts[rows], sizes)].astype(np.int64)
        width = max(1, len(self.pairs))
        keys, times = np.unique(np.repeat(owner, sizes) * width + links, return_counts=True)
        return (
            counts, groups, self.pairs[keys % width], times,
            np.bincount(keys // width, minlength=len(texts)),
        )


_aligners: dict[tuple[bytes, bytes], Aligner] = {}


def aligner_of(a_file: bytes, b_file: bytes) -> Aligner:
    """The aligner, made once per Python process."""
    if (a_file, b_file) not in _aligners:
        _aligners[a_file, b_file] = Aligner(a_file, b_file)
    return _aligners[a_file, b_file]


def align(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, chunk, n_a, n_b, n_groups, n_links, groups, pairs, times) per row.

    `groups` is the alignment as text, `a1,a2|b1;a3|b2,b3` with the ids of A and B in order.
    `pairs` holds the distinct linked pairs as `a << 32 | b`, `times` the links of each. Write
    the rows before `count_links`: chunk numbers are only good within one run of the plan.
    """
    context = docs.sparkSession.sparkContext
    # Two files of fixed size, some megabytes.
    files = context.broadcast((Path(a_path).read_bytes(), Path(b_path).read_bytes()))
    names = ["n_a", "n_b", "n_groups", "n_links"]
    fields = [
        T.StructField("id", docs.schema[id_col].dataType),
        *[T.StructField(n, T.LongType(), False) for n in ("chunk", *names)],
        T.StructField("groups", T.StringType(), False),
        T.StructField("pairs", T.ArrayType(T.LongType(), False), False),
        T.StructField("times", T.ArrayType(T.IntegerType(), False), False),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(*files.value)
        task = TaskContext.get()
        first = (task.partitionId() if task else 0) << CHUNK_BITS
        for place, batch in enumerate(slices(batches, "text", SLICE_BYTES)):
            chunk = first + place // CHUNK_SLICES
            found = aligner.align([t or "" for t in batch.column("text").to_pylist()])
            counts, groups, pairs, times, per_text = found
            offsets = np.concatenate(([0], np.cumsum(per_text))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(np.full(batch.num_rows, chunk)),
                    *[pa.array(c) for c in counts.T],
                    pa.array(groups, pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(pairs)),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                ],
                [f.name for f in fields],
            )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, T.StructType(fields)
    )


def chunk_links(aligned: DataFrame) -> DataFrame:
    """(chunk, pair, docs): in how many documents of the chunk a pair is linked.

    A chunk read in two batches gives a pair twice; the sum is what counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = np.asarray(batch.column("chunk"))
            lists = batch.column("pairs")
            for chunk in np.unique(chunks):
                pairs, docs = np.unique(
                    np.asarray(lists.filter(pa.array(chunks == chunk)).flatten()),
                    return_counts=True,
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), chunk)), pa.array(pairs), pa.array(docs)],
                    ["chunk", "pair", "docs"],
                )

    return aligned.select("chunk", "pairs").mapInArrow(run, "chunk long, pair long, docs long")


def count_links(per_chunk: DataFrame) -> DataFrame:
    """(pair, docs, best) over the corpus: in how many documents a pair is linked, and whether
    no pair of the same A id is linked in more. An A id has at most as many as B has ids."""
    totals = per_chunk.groupBy("pair").agg(F.sum("docs").alias("docs"))
    same_a = Window.partitionBy(F.shiftright("pair", 32))
    return totals.withColumn("best", F.col("docs") == F.max("docs").over(same_a))


def weigh_links(aligned: DataFrame) -> DataFrame:
    """The columns of `aligned` but pairs and times, with n_best and count_sum of each document.

    `aligned` is a written table: its rows of `align`, with any further columns.
    """
    per_chunk = stored(chunk_links(aligned), "chunk-links")
    replies = per_chunk.select("chunk", "pair").join(count_links(per_chunk), "pair")
    kept = [f for f in aligned.schema.fields if f.name not in ("pairs", "times")]
    names = [f.name for f in kept]
    more = [T.StructField(n, T.LongType(), False) for n in ("n_best", "count_sum")]

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        pair = np.asarray(found.column("pair"))
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        values = np.stack(
            (np.asarray(found.column("best")).astype(np.int64), np.asarray(found.column("docs")))
        )[:, order]
        lists = docs.column("pairs").combine_chunks()
        times = np.asarray(docs.column("times").combine_chunks().flatten()).astype(np.int64)
        at = np.searchsorted(pair, np.asarray(lists.flatten()))
        sums = np.concatenate(
            (np.zeros((2, 1), np.int64), np.cumsum(values[:, at] * times, axis=1)), axis=1
        )
        ends = np.cumsum(np.asarray(lists.value_lengths()).astype(np.int64))
        totals = np.diff(sums[:, ends], axis=1, prepend=0)
        return pa.Table.from_arrays(
            [*[docs.column(n) for n in names], pa.array(totals[0]), pa.array(totals[1])],
            [*names, "n_best", "count_sum"],
        )

    # A group is one chunk, some megabytes of text: bounded whatever the texts share.
    return aligned.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        run, T.StructType([*kept, *more])
    )
