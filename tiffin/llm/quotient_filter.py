"""Counting quotient filters over 64-bit fingerprints, in arrays.

A fingerprint is split into a quotient, the slot it belongs to, and a remainder, which is what
is stored. The remainders of one slot form a run, sorted; one bit per slot says whether it has
a run, one bit per remainder whether it ends one. Counts are kept beside. Nothing is lost: the
fingerprints and their counts can be read back, and two filters merge by their sorted runs.
"""

from __future__ import annotations

import numpy as np


class CountingQuotientFilter:
    """Of fingerprints that share their top `block_bits` bits."""

    def __init__(self, block: int, block_bits: int, occupied, run_ends, remainders, counts):
        self.block, self.block_bits = block, block_bits
        self.occupied, self.run_ends = occupied, run_ends
        self.remainders, self.counts = remainders, counts

    @classmethod
    def of_sorted(
        cls, fingerprints: np.ndarray, counts: np.ndarray, block: int, block_bits: int
    ) -> CountingQuotientFilter:
        """From distinct fingerprints in ascending order; about one slot for each."""
        slot_bits = max(3, int(len(fingerprints)).bit_length())
        width = np.uint64(64 - block_bits - slot_bits)
        mask = (np.uint64(1) << width) - np.uint64(1)
        slots = ((fingerprints >> width) & np.uint64((1 << slot_bits) - 1)).astype(np.int64)
        occupied = np.zeros(1 << slot_bits, bool)
        occupied[slots] = True
        run_ends = np.append(slots[1:] != slots[:-1], True)[: len(slots)]
        return cls(block, block_bits, occupied, run_ends, fingerprints & mask, counts)

    @classmethod
    def of(cls, fingerprints: np.ndarray, block: int, block_bits: int) -> CountingQuotientFilter:
        values, counts = np.unique(fingerprints, return_counts=True)
        return cls.of_sorted(values, counts.astype(np.int64), block, block_bits)

    def fingerprints(self) -> np.ndarray:
        """What was put in, ascending."""
        slot_bits = len(self.occupied).bit_length() - 1
        width = np.uint64(64 - self.block_bits - slot_bits)
        run = np.concatenate(([0], np.cumsum(self.run_ends)[:-1])).astype(np.int64)
        slots = np.flatnonzero(self.occupied)[run[: len(self.remainders)]].astype(np.uint64)
        high = np.uint64(self.block) << np.uint64(64 - self.block_bits) if self.block_bits else 0
        return np.uint64(high) | (slots << width) | self.remainders

    def merged(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """The filter of both inputs; equal fingerprints add their counts."""
        values = np.concatenate((self.fingerprints(), other.fingerprints()))
        counts = np.concatenate((self.counts, other.counts))
        order = np.argsort(values, kind="stable")  # two sorted runs: a merge
        values, counts = values[order], counts[order]
        starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
        sums = np.add.reduceat(counts, starts) if len(starts) else counts
        return self.of_sorted(values[starts], sums, self.block, self.block_bits)

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints counted more than once, and their counts."""
        more = self.counts > 1
        return self.fingerprints()[more], self.counts[more]

    def to_bytes(self) -> bytes:
        slot_bits = len(self.occupied).bit_length() - 1
        width = (64 - self.block_bits - slot_bits + 7) // 8
        n = len(self.remainders)
        packed = self.remainders.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
        more = np.flatnonzero(self.counts > 1)
        head = np.array([self.block, self.block_bits, slot_bits, n, len(more)], "<i8")
        return b"".join(
            part.tobytes()
            for part in (
                head, np.packbits(self.occupied), np.packbits(self.run_ends), packed,
                more.astype("<i8"), self.counts[more].astype("<i8"),
            )
        )

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        block, block_bits, slot_bits, n, more = np.frombuffer(data, "<i8", 5).tolist()
        width = (64 - block_bits - slot_bits + 7) // 8
        at = 40

        def take(count: int) -> np.ndarray:
            nonlocal at
            at += count
            return np.frombuffer(data, np.uint8, count, at - count)

        size = 1 << slot_bits
        occupied = np.unpackbits(take((size + 7) // 8))[:size].astype(bool)
        run_ends = np.unpackbits(take((n + 7) // 8))[:n].astype(bool)
        remainders = np.zeros((n, 8), np.uint8)
        remainders[:, :width] = take(n * width).reshape(n, width)
        where = np.frombuffer(take(8 * more).tobytes(), "<i8")
        counts = np.ones(n, np.int64)
        counts[where] = np.frombuffer(take(8 * more).tobytes(), "<i8")
        return cls(
            block, block_bits, occupied, run_ends, remainders.view("<u8").ravel(), counts
        )
