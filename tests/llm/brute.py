"""The operators' results by plain loops over small tables."""

from __future__ import annotations

import hashlib
import re

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def covered(rows: list[tuple[int, list | bytes]], window: int) -> list[list[bool]]:
    """Of each (id, sequence), which items lie in a window that starts in a smaller id too."""
    least: dict = {}
    for id_, items in rows:
        for at in range(len(items) - window + 1 if id_ is not None else 0):
            key = bytes(items[at : at + window]) if isinstance(items, bytes) else tuple(
                items[at : at + window])
            least[key] = min(least.get(key, id_), id_)
    out = []
    for id_, items in rows:
        gone = [False] * len(items)
        for at in range(len(items) - window + 1 if id_ is not None else 0):
            key = bytes(items[at : at + window]) if isinstance(items, bytes) else tuple(
                items[at : at + window])
            if least[key] < id_:
                gone[at : at + window] = [True] * window
        out.append(gone)
    return out


def fingerprint(text: str | None, size: int = 4) -> int:
    words = WORD.findall((text or "").encode().lower())
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles] if words else []
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def shingles(text: str | None, size: int) -> set:
    words = WORD.findall((text or "").encode().lower())
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def similarity(a: set, b: set) -> float:
    return len(a & b) / len(a | b)


def component_ids(ids: list[int], items: list, linked=None) -> list[int]:
    """The smallest id that each item reaches; by default over four bits of fingerprints."""
    linked = linked or (lambda a, b: (a ^ b).bit_count() <= 4)
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(items[i], items[j]):
                root[find(i)] = find(j)
    least: dict = {}
    for i, id_ in enumerate(ids):
        least[find(i)] = min(least.get(find(i), id_), id_)
    return [least[find(i)] for i in range(len(ids))]
