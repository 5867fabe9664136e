"""Hashes of word shingles, computed for many texts at once with array operations.

Words are the runs of bytes other than ASCII white space in the lower-cased text. A shingle is
five words in a row; a text of one to four words has one shingle, all of its words. A text
without words has none. Equal shingles have equal 64-bit hashes in every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

WIDTH = 5
CHUNK_BYTES = 1 << 19  # texts hashed together; a longer text is hashed alone

U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, at least ``n`` of them."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, CHUNK_BYTES + 64), base, dtype=np.uint64)
        steps[0] = 1
        held = _powers[base] = np.multiply.accumulate(steps)
    return held


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the result."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and where each text's words begin (and end)."""
    parts = [t.lower().encode() for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    if not white[0]:
        edge = np.concatenate([[0], edge])
    begin, end = edge[::2], edge[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * powers(_BASE, len(data))[: len(data)], out=sums[1:])
    back = powers(_INVERSE, len(data))
    hashes = mixed((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))
    starts = np.cumsum([0] + [len(p) + 1 for p in parts])
    return hashes, np.searchsorted(begin, starts)


def _chain(words: Sequence[np.ndarray]) -> np.ndarray:
    total = words[0]
    for word in words[1:]:
        total = mixed(total * U(_BASE) + word)
    return mixed(total + U(len(words)))


def _of_chunk(texts: Sequence[str], width: int) -> Iterator[np.ndarray]:
    words, at = word_hashes(texts)
    n = len(words) - width + 1
    runs = _chain([words[i : i + n] for i in range(width)]) if n > 0 else words[:0]
    for first, last in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if last - first >= width:
            yield runs[first : last - width + 1]
        elif last > first:
            yield _chain([words[i : i + 1] for i in range(first, last)])
        else:
            yield words[:0]


def shingle_hashes(texts: Sequence[str], width: int = WIDTH) -> Iterator[np.ndarray]:
    """For each text the hashes of its shingles, in order and with repetitions."""
    chunk: list[str] = []
    size = 0
    for text in texts:
        if chunk and size + len(text) > CHUNK_BYTES // 2:
            yield from _of_chunk(chunk, width)
            chunk, size = [], 0
        chunk.append(text)
        size += len(text)
    if chunk:
        yield from _of_chunk(chunk, width)
