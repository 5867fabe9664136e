"""Sorting byte strings with long common prefixes: shallow quicksort, then blind tries.

The shallow part is multikey quicksort on eight-byte words, all open segments split around
their pivots at once. Segments that still agree at the shallow depth are ordered by blind tries:
a string first follows only the bytes at which earlier strings branched, is compared with the
one string it meets, and is then put where that comparison says.
"""

from __future__ import annotations

import numpy as np

WORD = 8
SHALLOW = 4  # words


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def blind_trie(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """The order of ``strings`` and the common prefix of each with the one before (0 first)."""
    if len(strings) == 2:
        shared = common_prefix(*strings)
        return ([0, 1] if strings[0] <= strings[1] else [1, 0]), [0, shared]
    # An inner node is [depth, {byte or -1 at the end: node}], a leaf a list of equal strings.
    root: list | None = None

    def at(s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    for i, s in enumerate(strings):
        if root is None:
            root = [i]
            continue
        node = root
        while _inner(node):
            branches = node[1]
            node = branches.get(at(s, node[0])) or next(iter(branches.values()))
        met = strings[node[0]]
        shared = common_prefix(s, met)
        if shared == len(s) == len(met):
            node.append(i)
            continue
        above, node = None, root
        while _inner(node) and node[0] < shared:
            above, node = node, node[1][s[node[0]]]
        if _inner(node) and node[0] == shared:
            node[1][at(s, shared)] = [i]
            continue
        split = [shared, {at(met, shared): node, at(s, shared): [i]}]
        if above is None:
            root = split
        else:
            above[1][s[above[0]]] = split
    order: list[int] = []
    lcp: list[int] = []
    stack = [(root, 0)]
    while stack:
        node, before = stack.pop()
        if _inner(node):
            children = [node[1][c] for c in sorted(node[1])]
            stack += [(child, node[0]) for child in children[:0:-1]] + [(children[0], before)]
        else:
            order += node
            lcp += [before] + [len(strings[node[0]])] * (len(node) - 1)
    return order, lcp


def _inner(node: list) -> bool:
    return len(node) == 2 and isinstance(node[1], dict)


def _padded(strings: list[bytes], width: int) -> np.ndarray:
    return np.array([s[:width] for s in strings], dtype=f"S{width}")


def shallow_sort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``words``, and for each place where its run of equal rows starts."""
    n, width = words.shape
    order, start = np.arange(n), np.zeros(n, dtype=np.int64)
    depth = np.zeros(n, dtype=np.int64)
    active = np.arange(n) if n > 1 else np.arange(0)
    while len(active):
        segment = start[active]
        first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        size = np.diff(np.r_[first, len(active)])
        word = words[order[active], depth[active]]
        three = np.stack([word[first], word[first + size // 2], word[first + size - 1]])
        pivot = np.repeat(np.sort(three, axis=0)[1], size)
        side = (word > pivot).astype(np.int64) + (word >= pivot)
        key = np.repeat(np.arange(len(first)), size) * 3 + side
        moved = np.argsort(key, kind="stable")
        key, side = key[moved], side[moved]
        order[active] = order[active[moved]]
        depth[active] += side == 1
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[new, len(active)])
        start[active] = np.repeat(active[new], size)
        active = active[(np.repeat(size, size) > 1) & (depth[active] < width)]
    return order, start


def sort_strings(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of ``strings`` and the common prefix of each with the one before (0 first)."""
    n = len(strings)
    if not n:
        return np.arange(0), np.arange(0)
    width = WORD * SHALLOW
    head = _padded(strings, width)
    words = head.view(">u8").reshape(n, SHALLOW).astype(np.uint64)
    order, start = shallow_sort(words)
    lcp = np.zeros(n, dtype=np.int64)
    first = np.flatnonzero(np.r_[True, start[1:] != start[:-1]])
    size = np.diff(np.r_[first, n])
    for low, many in zip(first[size > 1].tolist(), size[size > 1].tolist(), strict=True):
        here = order[low : low + many].copy()
        inside, prefix = blind_trie([strings[i] for i in here])
        order[low : low + many] = here[inside]
        lcp[low + 1 : low + many] = prefix[1:]
    for low in first[1:].tolist():
        lcp[low] = common_prefix(strings[order[low - 1]], strings[order[low]])
    return order, lcp
