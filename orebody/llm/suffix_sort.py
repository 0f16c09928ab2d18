"""Deep-shallow suffix sorting: multikey quicksort to a shallow depth, blind tries below it."""

from __future__ import annotations

import numpy as np

#: Bytes of a string that the multikey quicksort looks at, in columns of eight.
SHALLOW = 48
#: Groups up to this size are sorted by their shallow bytes at once.
SMALL = 16


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the longest common prefix, known to be at least ``start``."""
    lo, hi = start, min(len(a), len(b))
    if a[lo:hi] == b[lo:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) >> 1
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class BlindTrie:
    """Patricia trie of byte strings: inner nodes hold a depth and a child a byte; skipped bytes are not looked at
    on the way down, one comparison with the leaf that is reached tells where a string belongs."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root = None  # a leaf is a list of equal strings' indexes; a node is (depth, {byte or -1: child})

    def insert(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [i]
            return
        at = self.root
        while isinstance(at, tuple):
            depth, children = at
            at = children.get(s[depth] if depth < len(s) else -1) or next(iter(children.values()))
        t = self.strings[at[0]]
        if s == t:
            at.append(i)
            return
        same = common(s, t)
        here, there = (x[same] if same < len(x) else -1 for x in (s, t))
        parent, at = None, self.root
        while isinstance(at, tuple) and at[0] < same:
            parent = at
            at = at[1][s[at[0]]]
        if isinstance(at, tuple) and at[0] == same:
            at[1][here] = [i]
            return
        node = (same, {there: at, here: [i]})
        if parent is None:
            self.root = node
        else:
            parent[1][s[parent[0]]] = node

    def in_order(self) -> tuple[list[int], list[int]]:
        """(indexes in order, common prefix of each with the one before)."""
        order: list[int] = []
        prefixes: list[int] = []
        stack = [(self.root, 0)]
        while stack:
            at, before = stack.pop()
            if isinstance(at, tuple):
                depth, children = at
                keys = sorted(children, reverse=True)
                for k in keys[:-1]:
                    stack.append((children[k], depth))
                stack.append((children[keys[-1]], before))
            else:
                size = len(self.strings[at[0]])
                for n, i in enumerate(at):
                    order.append(i)
                    prefixes.append(size if n else before)
        return order, prefixes


def sort_suffixes(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """(indexes in byte order, longest common prefix of each with the one before, 0 for the first)."""
    n = len(strings)
    if not n:
        return [], []
    heads = np.frombuffer(b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings), ">u8").reshape(n, -1).astype(np.uint64)
    order: list[int] = []
    prefixes: list[int] = []

    def deep(index: np.ndarray) -> None:
        trie = BlindTrie(strings)
        for i in index.tolist():
            trie.insert(i)
        ids, lcps = trie.in_order()
        if order:
            lcps[0] = common(strings[order[-1]], strings[ids[0]])
        order.extend(ids)
        prefixes.extend(lcps)

    # multikey quicksort with its own stack: (indexes, column)
    stack = [(np.arange(n), 0)]
    while stack:
        index, column = stack.pop()
        if not len(index):
            continue
        if len(index) == 1 or column == heads.shape[1]:
            deep(index)
            continue
        if len(index) <= SMALL:
            index = index[np.lexsort(tuple(heads[index, c] for c in range(heads.shape[1] - 1, column - 1, -1)))]
            same = (heads[index[1:]] == heads[index[:-1]]).all(axis=1)
            for part in reversed(np.split(index, np.flatnonzero(~same) + 1)):
                stack.append((part, heads.shape[1]))
            continue
        key = heads[index, column]
        pivot = np.sort(key[:: max(1, len(key) // 9)])[min(4, len(key) // 2)]
        stack.append((index[key > pivot], column))
        stack.append((index[key == pivot], column + 1))
        stack.append((index[key < pivot], column))
    prefixes[0] = 0
    return order, prefixes
