"""Substring de-duplication over words with difference-cover anchors.

A window is a run of `window` words. A set of residues D modulo `period` in which every
difference occurs (a difference cover) makes sure that of two equal windows, wherever they
begin, some position with the same distance from both starts lies on D in both documents. So
only words at positions in D begin anchors, hashes of `window - period + 1` words, and any
shared window shares an anchor. Documents that share one extend it: all windows around shared
anchors are compared by 128-bit hashes, and those that also start in a document with a smaller
id are removed.

Anchors and windows travel by the exchange of `chunked`, so a passage in very many documents
reaches a task once per chunk, not once per document.

Defined results: a null text has no words. A row without an id is neither smaller than another
nor has a smaller one, so it keeps all its words. Rows that share their id do not remove each
other's words. Each input row gives one output row. Other columns are not carried on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tiffin.llm import chunked
from tiffin.llm.chunked import DOC, REPLY, Rows, Tokens
from tiffin.llm.common import mixed, ragged, slices, stored, window_hash

WINDOW = 50
# A perfect difference set: every residue modulo 31 is one difference of two of its members.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def is_cover(cover: tuple[int, ...], period: int) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def word_hashes(text: bytes) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def cover_positions(count: int, cover=COVER, period=PERIOD) -> np.ndarray:
    """The positions below `count` whose residue is in the cover, ascending."""
    blocks = np.arange(-(-count // period)) * period
    places = (blocks[:, None] + np.array(sorted(cover))).ravel()
    return places[: np.searchsorted(places, count)]


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order of first appearance, number of each key)."""
    _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    order = np.argsort(first, kind="stable")
    number = np.empty(len(first), np.int64)
    number[order] = np.arange(len(first))
    return keys[first[order]], number[inverse]


def send_anchors(docs: DataFrame, window: int, cover, period: int) -> DataFrame:
    n_blocks = chunked.blocks_of(docs.sparkSession)
    size = window - period + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        held: dict[tuple[int, int], np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            rows, token = Rows(), tokens.new()
            names, parts = list(held), list(held.values())
            sizes = np.array([len(p) for p in parts])
            distinct, number = _numbered(np.concatenate(parts))
            owner = np.repeat(np.arange(len(parts)), sizes)
            low = np.full(len(distinct), len(parts))
            high = np.full(len(distinct), -1)
            np.minimum.at(low, number, owner)
            np.maximum.at(high, number, owner)
            # Anchors that documents of this chunk share are known to be shared.
            known = np.flatnonzero(low != high).astype("<u4")
            rows.add(REPLY, token, chunked.home(token), a=known)
            ends = np.cumsum(sizes)
            for name, lo, hi in zip(names, ends - sizes, ends, strict=True):
                rows.add(DOC, token, chunked.home(token), *name, a=chunked.runs(number[lo:hi]))
            block = (mixed(distinct) % np.uint64(n_blocks)).astype(np.int64)
            chunked.by_block(
                rows, token, block, [distinct, np.arange(len(distinct)).astype("<u4")]
            )
            held.clear()
            yield from rows.batches()

        total = 0
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for id_, th, text in zip(
                batch.column("id").to_pylist(), batch.column("th").to_pylist(), texts, strict=True
            ):
                if text is None or id_ is None or (id_, th) in held:
                    continue
                hashes = word_hashes(text)
                if len(hashes) < window:
                    continue
                places = cover_positions(len(hashes) - size + 1, cover, period)
                held[id_, th] = window_hash(hashes, size, BASES[0])[places]
                total += len(places)
                if total >= chunked.CHUNK_KEYS:
                    yield from flush()
                    total = 0
        if held:
            yield from flush()

    return docs.select("id", "th", "text").mapInArrow(run, chunked.SCHEMA)


def compare_anchors(rows: list[dict], out: Rows) -> None:
    """Reply to the chunks of every anchor that two chunks hold."""
    keys = np.concatenate([np.frombuffer(r["a"], "<u8") for r in rows])
    sizes = [len(r["b"]) // 4 for r in rows]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    shared = np.zeros(len(keys), bool)
    shared[order] = np.append(False, same) | np.append(same, False)
    for row, mask in zip(rows, np.split(shared, np.cumsum(sizes)[:-1]), strict=True):
        if mask.any():
            numbers = np.frombuffer(row["b"], "<u4")[mask]
            out.add(REPLY, row["token"], chunked.home(row["token"]), a=numbers)


def numbers_of(replies: list[dict], column: str = "a") -> np.ndarray:
    """A flag for each key number of the chunk: whether a reply has it."""
    found = np.concatenate([np.frombuffer(r[column], "<u4") for r in replies] or [np.zeros(0, "<u4")])
    flags = np.zeros(int(found.max()) + 1 if len(found) else 0, bool)
    flags[found] = True
    return flags


def flag(flags: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(numbers), bool)
    inside = numbers < len(flags)
    out[inside] = flags[numbers[inside]]
    return out


def _candidates(window: int, cover, period: int):
    """Of a document's anchors, the starts of the windows around the shared ones."""

    def resolve_doc(row: dict, flags: np.ndarray) -> bytes | None:
        spans = np.frombuffer(row["a"], "<u4").reshape(-1, 2).astype(np.int64)
        shared = np.flatnonzero(flag(flags, ragged(spans[:, 0], spans[:, 1])))
        if not len(shared):
            return None
        steps = np.array(sorted(cover))
        place = period * (shared // len(steps)) + steps[shared % len(steps)]
        return chunked.intervals(np.maximum(place - period + 1, 0), place + 1).tobytes()

    return resolve_doc


def send_windows(rows: DataFrame, window: int) -> DataFrame:
    """Hashes of the candidate windows, each once per chunk with the chunk's smallest id."""
    n_blocks = chunked.blocks_of(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            out, token = Rows(), tokens.new()
            parts = list(held.values())
            sizes = np.array([len(p[0]) for p in parts])
            ids = np.repeat(np.array([name[0] for name in held], np.int64), sizes)
            h1, h2 = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
            order = np.lexsort((h2, h1))
            fresh = np.append(
                True, (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
            )
            begin = np.flatnonzero(fresh)
            least = np.minimum.reduceat(ids[order], begin)
            first = np.minimum.reduceat(order, begin)
            group = np.empty(len(order), np.int64)
            group[order] = np.cumsum(fresh) - 1
            rank = np.argsort(first, kind="stable")
            number = np.empty(len(first), np.int64)
            number[rank] = np.arange(len(first))
            mine = ids > least[group]
            ends = np.cumsum(sizes)
            for (name, part), lo, hi in zip(held.items(), ends - sizes, ends, strict=True):
                covered, starts = mine[lo:hi], part[0]
                out.add(
                    DOC, token, chunked.home(token), *name,
                    a=chunked.runs(starts[~covered], number[group[lo:hi]][~covered]),
                    b=chunked.runs(starts[covered]),
                )
            at = order[begin]
            block = (mixed(h1[at]) % np.uint64(n_blocks)).astype(np.int64)
            pairs = np.stack((h1[at], h2[at]), axis=1)
            chunked.by_block(out, token, block, [pairs, number.astype("<u4"), least])
            held.clear()
            yield from out.batches()

        total = 0
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for id_, th, text, found in zip(
                batch.column("id").to_pylist(), batch.column("th").to_pylist(), texts,
                batch.column("found").to_pylist(), strict=True,
            ):
                if (id_, th) in held:
                    continue
                hashes = word_hashes(text)
                last = len(hashes) - window + 1
                spans = np.minimum(np.frombuffer(found, "<u4").reshape(-1, 2), last).astype(int)
                starts = ragged(spans[:, 0], spans[:, 1] - spans[:, 0])
                if not len(starts):
                    continue
                held[id_, th] = (
                    starts, *(window_hash(hashes, window, base)[starts] for base in BASES)
                )
                total += len(starts)
                if total >= chunked.CHUNK_KEYS:
                    yield from flush()
                    total = 0
        if held:
            yield from flush()

    return rows.select("id", "th", "text", "found").mapInArrow(run, chunked.SCHEMA)


def compare_windows(rows: list[dict], out: Rows) -> None:
    """Reply to a chunk with the windows that start in a smaller document elsewhere."""
    keys = np.concatenate([np.frombuffer(r["a"], "<u8").reshape(-1, 2) for r in rows])
    least = np.concatenate([np.frombuffer(r["c"], "<i8") for r in rows])
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    sorted_keys = keys[order]
    begin = np.flatnonzero(np.append(True, (sorted_keys[1:] != sorted_keys[:-1]).any(axis=1)))
    lowest = np.repeat(
        np.minimum.reduceat(least[order], begin), np.diff(np.append(begin, len(order)))
    )
    covered = np.zeros(len(least), bool)
    covered[order] = least[order] > lowest
    sizes = [len(r["b"]) // 4 for r in rows]
    for row, mask in zip(rows, np.split(covered, np.cumsum(sizes)[:-1]), strict=True):
        if mask.any():
            numbers = np.frombuffer(row["b"], "<u4")[mask]
            out.add(REPLY, row["token"], chunked.home(row["token"]), a=numbers)


def covered_windows(window: int):
    """The removed words of a document as disjoint intervals."""

    def resolve_doc(row: dict, flags: np.ndarray) -> bytes | None:
        spans = np.frombuffer(row["a"], "<u4").reshape(-1, 3).astype(np.int64)
        starts = ragged(spans[:, 0], spans[:, 2])
        starts = starts[flag(flags, ragged(spans[:, 1], spans[:, 2]))]
        own = np.frombuffer(row["b"], "<u4").reshape(-1, 2).astype(np.int64)
        begin = np.concatenate((starts, own[:, 0]))
        end = np.concatenate((starts + window, own[:, 0] + own[:, 1] - 1 + window))
        return chunked.intervals(begin, end).tobytes() if len(begin) else None

    return resolve_doc


def cut_words(rows: DataFrame) -> DataFrame:
    """(id, n_words, n_removed, spans, kept) of (id, text, found)."""
    schema = (
        "id long, n_words long, n_removed long, spans array<struct<first:int,end:int>>,"
        " kept string"
    )
    span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts, removed, spans, kept = [], [], [], []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for text, found in zip(texts, batch.column("found").to_pylist(), strict=True):
                words = (text or b"").split()
                cuts = np.frombuffer(found or b"", "<u4").reshape(-1, 2).tolist()
                counts.append(len(words))
                removed.append(sum(end - first for first, end in cuts))
                spans.append([{"first": first, "end": end} for first, end in cuts])
                for first, end in reversed(cuts):
                    del words[first:end]
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()), pa.array(spans, span),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["id", "n_words", "n_removed", "spans", "kept"],
            )

    return rows.select("id", "text", "found").mapInArrow(run, schema)


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, cover: tuple[int, ...] = COVER, period: int = PERIOD,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_removed, spans, kept) per row; spans are removed runs of words."""
    if not is_cover(cover, period) or window < period:
        raise ValueError("the residues must cover all differences of a period up to the window")
    texts = chunked.keyed(docs, id_col, text_col)
    shared = chunked.compare(send_anchors(texts, window, cover, period), compare_anchors)
    candidates = stored(
        chunked.resolve(shared, _candidates(window, cover, period), numbers_of), "anchors"
    )
    # Both joins below need the texts by id: the plan deals them out once and reads them twice.
    near = chunked.same_document(texts, candidates, "inner")
    compared = chunked.compare(send_windows(near, window), compare_windows)
    removed = chunked.resolve(compared, covered_windows(window), numbers_of)
    return cut_words(chunked.same_document(texts, removed, "left"))
