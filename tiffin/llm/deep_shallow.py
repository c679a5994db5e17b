"""Deep-shallow sorting of fixed-length windows of bytes.

Windows are first ordered by multikey quicksort, whose characters are words of eight bytes and
whose partitioning steps treat all groups at once, down to a shallow depth. Groups that still
agree there have long common prefixes; each is ordered by a blind trie, which stores only the
branching depths and bytes and compares a window in full with one leaf.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 3  # words


def as_words(windows: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of unsigned words in the same order."""
    width = -(-windows.shape[1] // 8) * 8
    padded = np.zeros((len(windows), width), np.uint8)
    padded[:, : windows.shape[1]] = windows
    return padded.view(">u8").astype(np.uint64)


class BlindTrie:
    """Strings of one length; nodes are [depth, {byte: child}], leaves are lists of numbers."""

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, [0]
        for number in range(1, len(strings)):
            self._insert(number)

    def _insert(self, number: int) -> None:
        new = self.strings[number]
        # Blind descent: only branching bytes are looked at, any child serves if none fits.
        node = self.root
        while isinstance(node, tuple):
            depth, children = node
            child = children.get(new[depth])
            node = child if child is not None else next(iter(children.values()))
        old = self.strings[node[0]]
        if old == new:
            node.append(number)
            return
        size = len(new)
        differ = int.from_bytes(old, "big") ^ int.from_bytes(new, "big")
        common = size - (differ.bit_length() + 7) // 8
        # Second descent, to where the new string leaves the trie.
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < common:
            above, node = node, node[1][new[node[0]]]
        if isinstance(node, tuple) and node[0] == common:
            node[1][new[common]] = [number]
            return
        split = (common, {old[common]: node, new[common]: [number]})
        if above is None:
            self.root = split
        else:
            above[1][new[above[0]]] = split

    def groups(self):
        """The numbers of equal strings, in the order of the strings."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node[1][byte] for byte in sorted(node[1], reverse=True))
            else:
                yield node


def sort_windows(windows: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, fresh): the rows in ascending order, and which of them differ from the one before."""
    count = len(windows)
    words = as_words(windows)
    order, fresh = np.arange(count), np.zeros(count, bool)
    fresh[:1] = True
    for depth in range(min(shallow, words.shape[1])):
        # Rows in a group of their own are done.
        alone = fresh & np.append(fresh[1:], True)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        rows, group = order[open_], np.cumsum(fresh)[open_]
        word = words[rows, depth]
        turn = np.lexsort((word, group))
        order[open_] = rows[turn]
        word = word[turn]
        fresh[open_[1:]] |= (word[1:] != word[:-1]) | (group[1:] != group[:-1])
    begins = np.flatnonzero(fresh)
    ends = np.append(begins[1:], count)
    long_ = ends - begins > 1
    for lo, hi in zip(begins[long_].tolist(), ends[long_].tolist(), strict=True):
        members = order[lo:hi].copy()
        trie = BlindTrie([row.tobytes() for row in windows[members]])
        at = lo
        for numbers in trie.groups():
            order[at : at + len(numbers)] = members[numbers]
            fresh[at] = True
            at += len(numbers)
    return order, fresh
