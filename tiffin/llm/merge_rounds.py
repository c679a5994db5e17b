"""Pair merging of many symbol sequences at once, in rounds over flat arrays.

Byte-pair encoding merges, again and again, the adjacent pair of lowest rank, the leftmost if
several have it. Here all sequences lie one after the other in one array. A round takes the
lowest rank of each sequence, merges its occurrences in all sequences at once and compacts the
array; a sequence without a known pair leaves it.

Several occurrences in one sequence are merged in one round only if that cannot change the
result, that is if no pair with the merged symbol has a rank as low (`eager`). Otherwise the
round takes the leftmost alone, as the definition has it.

A round walks all symbols left, and a word of n letters may need as many rounds as it has different
pairs. Sequences above `LONG_WORD` symbols are therefore merged one by one with a heap of their
pairs, in n log n steps and about 80 bytes a symbol; the definition, and so the result, is the same.
"""

from __future__ import annotations

from array import array
from functools import cached_property
from heapq import heappop, heappush
from itertools import repeat

import numpy as np

NO_PAIR = np.iinfo(np.int32).max
LONG_WORD = 2_048  # symbols; decides the time a sequence takes, not its result


class Pairs:
    """Which adjacent symbols merge, into what, and in which order."""

    def __init__(self, left, right, rank, merged, n_symbols: int):
        left, right = np.asarray(left, np.int64), np.asarray(right, np.int64)
        rank, merged = np.asarray(rank, np.int32), np.asarray(merged, np.int32)
        self.n_symbols = n_symbols
        keys = left * n_symbols + right
        order = np.argsort(keys, kind="stable")
        lowest = np.full(n_symbols, NO_PAIR, np.int32)
        np.minimum.at(lowest, left, rank)
        np.minimum.at(lowest, right, rank)
        eager = lowest[merged] > rank
        # Open addressing with a few probes is faster than a search among all keys.
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        size = 1 << bits
        self.keys = np.full(size, -1, np.int64)
        self.rank = np.full(size, NO_PAIR, np.int32)
        self.merged = np.zeros(size, np.int32)
        self.eager = np.zeros(size, bool)
        self.probes = 0
        keys, rank, merged, eager = keys[order], rank[order], merged[order], eager[order]
        at = self._slot(keys)
        while len(keys):
            self.probes += 1
            free = self.keys[at] < 0
            # Of those that want one free slot, the first gets it.
            _, first = np.unique(at, return_index=True)
            wins = np.zeros(len(at), bool)
            wins[first] = True
            wins &= free
            for table, values in (
                (self.keys, keys), (self.rank, rank), (self.merged, merged), (self.eager, eager)
            ):
                table[at[wins]] = values[wins]
            rest = ~wins
            keys, rank, merged, eager = keys[rest], rank[rest], merged[rest], eager[rest]
            at = (at[rest] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> self.shift).astype(np.int64)

    @cached_property
    def by_key(self) -> dict[int, tuple[int, int]]:
        """left * (n_symbols + 1) + right -> (rank, merged); symbol n_symbols merges with none."""
        used = np.flatnonzero(self.keys >= 0)
        left, right = np.divmod(self.keys[used], self.n_symbols)
        keys = left * (self.n_symbols + 1) + right
        forms = zip(self.rank[used].tolist(), self.merged[used].tolist(), strict=True)
        return dict(zip(keys.tolist(), forms, strict=True))

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The table slot of each pair, -1 for a pair that does not merge."""
        keys = left.astype(np.int64) * self.n_symbols + right
        keys[(left < 0) | (right < 0)] = -2
        at = self._slot(keys)
        found = np.where(self.keys[at] == keys, at, -1)
        open_ = np.flatnonzero((found < 0) & (self.keys[at] >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            here = self.keys[at[open_]]
            hit = here == keys[open_]
            found[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit & (here >= 0)]
        return found


def merge(pairs: Pairs, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge each sequence to the end.

    `symbols` holds the sequences one after the other, `sizes` their lengths (0 is allowed);
    a negative symbol never merges. Returns the surviving symbols in the same form.
    """
    sizes, symbols = np.asarray(sizes, np.int64), np.asarray(symbols, np.int32)
    long_ = sizes > LONG_WORD
    if not long_.any():
        return _merge_in_rounds(pairs, symbols, sizes)
    short, out_sizes = _merge_in_rounds(
        pairs, symbols[np.repeat(~long_, sizes)], np.where(long_, 0, sizes)
    )
    starts = np.cumsum(sizes) - sizes
    forms = [
        _merge_with_heap(pairs, symbols[start : start + size])
        for start, size in zip(starts[long_].tolist(), sizes[long_].tolist(), strict=True)
    ]
    out_sizes[long_] = [len(form) for form in forms]
    of_long = np.repeat(long_, out_sizes)
    flat = np.empty(len(of_long), np.int32)
    flat[~of_long], flat[of_long] = short, np.concatenate(forms)
    return flat, out_sizes


def _merge_with_heap(pairs: Pairs, symbols: np.ndarray) -> np.ndarray:
    """One sequence merged to the end; the heap gives its lowest pair, the leftmost of equals."""
    size, base = len(symbols), pairs.n_symbols + 1
    known = pairs.by_key.get
    slot = pairs.find(symbols[:-1], symbols[1:])
    begin = np.flatnonzero(slot >= 0)
    ranks = np.full(size, -1, np.int32)
    ranks[begin] = pairs.rank[slot[begin]]
    heap = np.sort(ranks[begin].astype(np.int64) * size + begin).tolist()  # sorted is a heap
    rank_at = array("i", ranks.tobytes())
    symbol = array("i", np.where(symbols < 0, pairs.n_symbols, symbols).astype(np.int32).tobytes())
    after = array("q", np.arange(1, size + 1).tobytes())
    before = array("q", np.arange(-1, size - 1).tobytes())
    while heap:
        rank, at = divmod(heappop(heap), size)
        if rank_at[at] != rank:  # one of its symbols has merged since
            continue
        right = after[at]
        new = symbol[at] = known(symbol[at] * base + symbol[right])[1]
        rank_at[at] = rank_at[right] = -1
        symbol[right] = -1
        following = after[at] = after[right]
        if following < size:
            before[following] = at
            found = known(new * base + symbol[following])
            if found is not None:
                rank_at[at] = found[0]
                heappush(heap, found[0] * size + at)
        left = before[at]
        if left >= 0:
            found = known(symbol[left] * base + new)
            rank_at[left] = -1 if found is None else found[0]
            if found is not None:
                heappush(heap, found[0] * size + left)
    out = np.frombuffer(symbol, np.int32)
    kept = np.where(symbols < 0, symbols, out)  # those never merge
    return kept[out >= 0]


def _merge_in_rounds(
    pairs: Pairs, symbols: np.ndarray, sizes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    out_sizes = sizes.copy()
    done_symbols: list[np.ndarray] = []
    done_words: list[np.ndarray] = []
    word = np.repeat(np.arange(len(sizes)), sizes)

    # slot[i]: the pair (i, i + 1) if both are of one word, else -1
    slot = np.full(len(symbols), -1, np.int64)
    if len(symbols) > 1:
        inside = np.flatnonzero(word[1:] == word[:-1])
        slot[inside] = pairs.find(symbols[inside], symbols[inside + 1])

    while len(symbols):
        rank = np.where(slot >= 0, pairs.rank[slot], NO_PAIR)
        starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        lowest = np.minimum.reduceat(rank, starts)
        lengths = np.diff(np.append(starts, len(symbols)))
        going = lowest < NO_PAIR
        if not going.all():
            live = np.repeat(going, lengths)
            done_symbols.append(symbols[~live])
            done_words.append(word[~live])
            out_sizes[word[starts[~going]]] = lengths[~going]
            symbols, word, slot, rank = symbols[live], word[live], slot[live], rank[live]
            lengths, lowest = lengths[going], lowest[going]
            if not len(symbols):
                break
        best = np.flatnonzero(rank == np.repeat(lowest, lengths))
        # Of overlapping occurrences every second one merges, from the left.
        run = np.concatenate(([True], np.diff(best) != 1))
        place = np.arange(len(best))
        chosen = (place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0
        # A sequence with an occurrence that must not be merged early takes the leftmost only.
        first = np.concatenate(([True], word[best[1:]] != word[best[:-1]]))
        group = np.cumsum(first) - 1
        early = np.bitwise_and.reduceat(pairs.eager[slot[best]], np.flatnonzero(first))
        chosen &= first | early[group]
        best = best[chosen]

        symbols[best] = pairs.merged[slot[best]]
        keep = np.ones(len(symbols), bool)
        keep[best + 1] = False
        position = np.cumsum(keep) - 1
        symbols, word, slot = symbols[keep], word[keep], slot[keep]
        at = position[best]
        touched = np.zeros(len(symbols), bool)
        touched[at] = True
        touched[at[at > 0] - 1] = True
        stale = np.flatnonzero(touched)
        slot[stale] = -1
        stale = stale[stale + 1 < len(symbols)]
        stale = stale[word[stale] == word[stale + 1]]
        slot[stale] = pairs.find(symbols[stale], symbols[stale + 1])

    if not done_symbols:
        return np.zeros(0, np.int32), out_sizes
    flat, owner = np.concatenate(done_symbols), np.concatenate(done_words)
    return flat[np.argsort(owner, kind="stable")], out_sizes


class WordStore:
    """Merged forms of words seen before, in flat arrays; emptied when `limit` is reached.

    The limit bounds memory only: a word that is not held is merged anew.
    """

    def __init__(self, merge_words, limit: int = 400_000):
        self.merge_words, self.limit = merge_words, limit
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)

    def lookup(self, words: list[str]) -> np.ndarray:
        """The store's row of each word; all of them are held until the next call."""
        if len(self.index) > self.limit:
            self._clear()
        rows = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(rows < 0).tolist()
        if missing:
            new = list(dict.fromkeys([words[i] for i in missing]))
            flat, sizes = self.merge_words(new)
            begin = len(self.index)
            self.index.update(zip(new, range(begin, begin + len(new)), strict=True))
            starts = np.cumsum(sizes) - sizes + len(self.flat)
            self.flat = np.concatenate((self.flat, flat.astype(np.int32)))
            self.starts = np.concatenate((self.starts, starts))
            self.sizes = np.concatenate((self.sizes, sizes))
            rows[missing] = [self.index[words[i]] for i in missing]
        return rows
