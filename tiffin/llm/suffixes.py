"""Removal of repeated byte strings by suffix sorting.

Suffixes only matter here to the depth of `window` bytes. Sorting all of them together would
send every byte through an exchange fifty times, so two steps come before the sort:

1. Each window names its anchor, the `gram` bytes within it with the smallest hash (the leftmost
   of equals). Equal windows name equal anchors. Neighbouring windows with one anchor make a
   segment. A segment that also occurs in a smaller document is covered whole. A segment whose
   anchor occurs in no other segment shares its windows with copies of itself only.
   A window that reaches far to the left of its anchor (or far to the right; one of the two holds)
   can only be equal to one with the same bytes there, the flank. A segment tells the hashes of
   its two flanks, and windows on a side without a partner are settled too.
2. What is left, windows of first copies whose anchor lies in other segments with the same flank,
   are the candidates. Every chunk sorts its candidate suffixes by deep-shallow sorting, and sends each
   distinct one once, with its smallest document, to be compared with those of other chunks.

Segments and windows are compared between chunks by 128 bits of hash. However many documents
share a passage, a block receives it once a chunk.

Defined results: a null text has no bytes. A row without an id is neither smaller than another
nor has a smaller one, so it keeps all its bytes. Rows that share their id do not remove each
other's bytes. Each input row gives one output row. Other columns are not carried on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm import chunked
from tiffin.llm.anchors import compare_windows, covered_windows, flag, numbers_of
from tiffin.llm.chunked import DOC, Rows, Tokens
from tiffin.llm.common import mixed, ragged, slices, stored, window_hash
from tiffin.llm.deep_shallow import as_words, sort_windows

WINDOW = 50
GRAM = 16
BASE = 0x9E3779B97F4A7C15
SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344)


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest value in each run of `width` values."""
    count = len(values) - width + 1
    low, place, size = values, np.arange(len(values), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        a, b = slice(None, len(low) - step), slice(step, None)
        later = low[b] < low[a]
        low, place = np.where(later, low[b], low[a]), np.where(later, place[b], place[a])
        size += step
    return place[:count]


def flank_of(window: int, gram: int) -> int:
    """How many bytes of a window lie on one side of its anchor at least."""
    return -(-(window - gram) // 2)


def segments(text: bytes, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, segment hash, flank hashes, number of windows, bytes before the anchor) of
    each segment of a text.

    The flank hashes, left and right, are 0 where no window of the segment has that flank.
    """
    data = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
    hashes = mixed(window_hash(data, gram, BASE))
    place = leftmost_minima(hashes, window - gram + 1)
    starts = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
    ends = np.append(starts[1:], len(place))
    digest = xxhash.xxh3_64_intdigest
    whole = np.fromiter(
        (digest(text[a:b]) for a, b in zip(starts.tolist(), (ends + window - 1).tolist(), strict=True)),
        np.uint64, len(starts),
    )
    anchor, sizes = place[starts], ends - starts
    flank = flank_of(window, gram)
    # 16 bits and not 0: a chance match only makes a window a candidate.
    beside = np.maximum(mixed(window_hash(data, flank, BASE)) >> np.uint64(48), 1).astype("<u2")
    left_end, right_begin = sides(sizes, anchor - starts, window, gram)
    flanks = np.zeros((len(starts), 2), "<u2")
    has_left, has_right = left_end > 0, right_begin < sizes
    flanks[has_left, 0] = beside[anchor[has_left] - flank]
    flanks[has_right, 1] = beside[anchor[has_right] + gram]
    return hashes[anchor], whole, flanks, sizes, anchor - starts


def sides(
    sizes: np.ndarray, before: np.ndarray, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray]:
    """Where in a segment the windows with a left flank end and those with a right flank begin."""
    flank = flank_of(window, gram)
    return (
        np.clip(before - flank + 1, 0, sizes),
        np.clip(before - (window - gram - flank), 0, sizes),
    )


def distinct_rows(ids: np.ndarray, *keys: np.ndarray):
    """(first row, least id, number) of distinct keys, numbered as they first appear."""
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for key in keys:
        fresh[1:] |= key[order][1:] != key[order][:-1]
    return _numbered(ids, order, fresh)


def _numbered(ids: np.ndarray, order: np.ndarray, fresh: np.ndarray):
    begin = np.flatnonzero(fresh)
    least = np.minimum.reduceat(ids[order], begin)
    first = np.minimum.reduceat(order, begin)
    rank = np.argsort(first, kind="stable")
    number = np.empty(len(first), np.int64)
    number[rank] = np.arange(len(first))
    numbers = np.empty(len(order), np.int64)
    numbers[order] = number[np.cumsum(fresh) - 1]
    return first[rank], least[rank], numbers


def send_segments(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Distinct segments of a chunk with their smallest document."""
    n_blocks = chunked.blocks_of(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        held: dict[tuple[int, int], tuple] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            rows, token = Rows(), tokens.new()
            parts = list(held.values())
            anchor, whole, flanks = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 2))
            sizes = np.array([len(p[0]) for p in parts])
            ids = np.repeat(np.array([name[0] for name in held], np.int64), sizes)
            first, least, number = distinct_rows(ids, anchor, whole)
            covered = ids > least[number]
            ends = np.cumsum(sizes)
            for (name, part), lo, hi in zip(held.items(), ends - sizes, ends, strict=True):
                rows.add(
                    DOC, token, chunked.home(token), *name, a=chunked.runs(number[lo:hi]),
                    b=np.concatenate(part[3:]).astype(np.uint8), c=np.packbits(covered[lo:hi]),
                )
            block = (anchor[first] % np.uint64(n_blocks)).astype(np.int64)
            chunked.by_block(
                rows, token, block,
                [np.stack((anchor[first], whole[first]), axis=1), flanks[first],
                 np.arange(len(first)), least],
                packed_segments,
            )
            held.clear()
            yield from rows.batches()

        total = 0
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for id_, th, text in zip(
                batch.column("id").to_pylist(), batch.column("th").to_pylist(), texts, strict=True
            ):
                if text is None or id_ is None or len(text) < window or (id_, th) in held:
                    continue
                held[id_, th] = segments(text, window, gram)
                total += len(held[id_, th][0])
                if total >= chunked.CHUNK_KEYS:
                    yield from flush()
                    total = 0
        if held:
            yield from flush()

    return docs.select("id", "th", "text").mapInArrow(run, chunked.SCHEMA)


def packed_segments(
    keys: np.ndarray, flanks: np.ndarray, numbers: np.ndarray, least: np.ndarray
) -> tuple[bytes, bytes, bytes]:
    """The columns of a KEYS row; the numbers ascend and are sent as steps."""
    steps = chunked.pack(np.diff(numbers, prepend=0))
    return keys.tobytes() + flanks.tobytes(), steps, chunked.pack(least)


def unpacked_segments(row: dict) -> tuple[np.ndarray, ...]:
    """(keys, flanks, numbers, least) of a KEYS row."""
    numbers = np.cumsum(chunked.unpack(row["b"]))
    keys = np.frombuffer(row["a"], "<u8", 2 * len(numbers)).reshape(-1, 2)
    flanks = np.frombuffer(row["a"], "<u2", offset=keys.nbytes).reshape(-1, 2)
    return keys, flanks, numbers.astype("<u4"), chunked.unpack(row["c"])


def compare_segments(rows: list[dict], out: Rows) -> None:
    """Reply which segments start in a smaller document, and which of the others share their
    anchor and a flank, the left or the right one, with different segments."""
    parts = [unpacked_segments(r) for r in rows]
    keys, flanks, numbers, least = (np.concatenate(columns) for columns in zip(*parts, strict=True))
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    anchor, whole = keys[order, 0], keys[order, 1]
    other = np.append(True, (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1]))
    distinct = np.cumsum(other) - 1
    lowest = np.minimum.reduceat(least[order], np.flatnonzero(other))
    covered = np.zeros(len(order), bool)
    covered[order] = least[order] > lowest[distinct]
    found = [covered]
    for side in (0, 1):
        several = np.zeros(len(order), bool)
        several[order] = shared(anchor[other], flanks[order[other], side])[distinct]
        found.append(several & ~covered)
    cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
    for row, own, *masks in zip(
        rows, np.split(numbers, cuts), *(np.split(f, cuts) for f in found), strict=True
    ):
        if any(mask.any() for mask in masks):
            out.add(
                chunked.REPLY, row["token"], chunked.home(row["token"]), None, None,
                *[own[mask] for mask in masks],
            )


def shared(anchor: np.ndarray, flank: np.ndarray) -> np.ndarray:
    """Which of some different segments have an anchor and a flank that another one has too."""
    order = np.lexsort((flank, anchor))
    first, second = anchor[order], flank[order]
    same = (first[1:] == first[:-1]) & (second[1:] == second[:-1]) & (second[1:] != 0)
    out = np.zeros(len(order), bool)
    out[order] = np.append(same, False) | np.append(False, same)
    return out


def segment_flags(replies: list[dict]) -> tuple[np.ndarray, ...]:
    return tuple(numbers_of(replies, column) for column in "abc")


def judge_segments(window: int, gram: int):
    """How many spans of covered windows, these spans, and the spans of candidate windows."""

    def resolve_doc(row: dict, flags: tuple[np.ndarray, ...]) -> bytes | None:
        spans = np.frombuffer(row["a"], "<u4").reshape(-1, 2).astype(np.int64)
        number = ragged(spans[:, 0], spans[:, 1])
        sizes, before = np.frombuffer(row["b"], np.uint8).astype(np.int64).reshape(2, -1)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        bits = np.unpackbits(np.frombuffer(row["c"], np.uint8))[: len(number)].astype(bool)
        sure = bits | flag(flags[0], number)
        left, right = (flag(f, number) & ~sure for f in flags[1:])
        if not sure.any() and not left.any() and not right.any():
            return None
        covered = chunked.intervals(starts[sure], ends[sure])
        left_end, right_begin = sides(sizes, before, window, gram)
        candidates = chunked.intervals(
            np.concatenate((starts[left], (starts + right_begin)[right])),
            np.concatenate(((starts + left_end)[left], ends[right])),
        )
        return np.array([len(covered)], "<u4").tobytes() + covered.tobytes() + candidates.tobytes()

    return resolve_doc


def spans_of(found: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """What `judge_segments` packed: spans of covered and of candidate window starts."""
    numbers = np.frombuffer(found or bytes(4), "<u4").astype(np.int64)
    cut = 1 + 2 * int(numbers[0])
    return numbers[1:cut].reshape(-1, 2), numbers[cut:].reshape(-1, 2)


def word_hash(words: np.ndarray, seed: int) -> np.ndarray:
    out = np.full(len(words), seed, np.uint64)
    for column in words.T:
        out = mixed(out ^ column) + np.uint64(seed)
    return out


def send_windows(rows: DataFrame, window: int) -> DataFrame:
    """Distinct candidate suffixes of a chunk with their smallest document."""
    n_blocks = chunked.blocks_of(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            out, token = Rows(), tokens.new()
            windows = np.concatenate([w for _, w in held.values()])
            sizes = np.array([len(starts) for starts, _ in held.values()])
            ids = np.repeat(np.array([name[0] for name in held], np.int64), sizes)
            first, least, number = _numbered(ids, *sort_windows(windows))
            mine = ids > least[number]
            ends = np.cumsum(sizes)
            for (name, (starts, _)), lo, hi in zip(held.items(), ends - sizes, ends, strict=True):
                covered = mine[lo:hi]
                out.add(
                    DOC, token, chunked.home(token), *name,
                    a=chunked.runs(starts[~covered], number[lo:hi][~covered]),
                    b=chunked.runs(starts[covered]),
                )
            words = as_words(windows[first])
            pairs = np.stack([word_hash(words, seed) for seed in SEEDS], axis=1)
            block = (pairs[:, 0] % np.uint64(n_blocks)).astype(np.int64)
            chunked.by_block(
                out, token, block, [pairs, np.arange(len(first)).astype("<u4"), least]
            )
            held.clear()
            yield from out.batches()

        total = 0
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for id_, th, text, found in zip(
                batch.column("id").to_pylist(), batch.column("th").to_pylist(), texts,
                batch.column("found").to_pylist(), strict=True,
            ):
                spans = spans_of(found)[1]
                if not len(spans) or (id_, th) in held:
                    continue
                starts = ragged(spans[:, 0], spans[:, 1] - spans[:, 0])
                data = np.frombuffer(text, np.uint8)
                held[id_, th] = (
                    starts, np.lib.stride_tricks.sliding_window_view(data, window)[starts]
                )
                total += len(starts)
                if total >= chunked.CHUNK_KEYS:
                    yield from flush()
                    total = 0
        if held:
            yield from flush()

    return rows.select("id", "th", "text", "found").mapInArrow(run, chunked.SCHEMA)


def cut_bytes(rows: DataFrame, window: int) -> DataFrame:
    """(id, n_bytes, spans, kept) of (id, text, sure, found)."""
    schema = "id long, n_bytes long, spans array<struct<first:long,end:long>>, kept binary"
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, spans, kept = [], [], []
            for text, sure, found in zip(
                batch.column("text").cast(pa.binary()).to_pylist(),
                batch.column("sure").to_pylist(), batch.column("found").to_pylist(), strict=True,
            ):
                text = text or b""
                known = spans_of(sure)[0]
                more = np.frombuffer(found or b"", "<u4").reshape(-1, 2).astype(np.int64)
                begin = np.concatenate((known[:, 0], more[:, 0]))
                end = np.concatenate((known[:, 1] - 1 + window, more[:, 1]))
                cuts = chunked.intervals(begin, end).tolist() if len(begin) else []
                sizes.append(len(text))
                spans.append([{"first": a, "end": b} for a, b in cuts])
                inner = zip([0, *(b for _, b in cuts)], [*(a for a, _ in cuts), len(text)], strict=True)
                kept.append(b"".join(text[a:b] for a, b in inner))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(spans, span),
                 pa.array(kept, pa.binary())],
                ["id", "n_bytes", "spans", "kept"],
            )

    return rows.select("id", "text", "sure", "found").mapInArrow(run, schema)


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_bytes, spans, kept) per row; spans are the removed runs of bytes."""
    if not gram <= window < 256:
        raise ValueError("a window has at least the bytes of an anchor, and less than 256")
    texts = chunked.keyed(docs, id_col, text_col)
    compared = chunked.compare(send_segments(texts, window, gram), compare_segments)
    judged = stored(chunked.resolve(compared, judge_segments(window, gram), segment_flags), "suffix-segments")
    near = chunked.same_document(texts, judged, "inner")
    found = chunked.resolve(
        chunked.compare(send_windows(near, window), compare_windows),
        covered_windows(window), numbers_of,
    )
    sure = judged.withColumnRenamed("found", "sure")
    both = chunked.same_document(chunked.same_document(texts, sure, "left"), found, "left")
    return cut_bytes(both, window)
