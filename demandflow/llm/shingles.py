"""Word shingles of whole texts as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

from demandflow.llm.common import ASCII_SPACE, BYTE_VALUES, powers, prefix_hash, splitmix

IS_SPACE = np.isin(np.arange(256), np.frombuffer(ASCII_SPACE.encode(), np.uint8))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_VALUES = BYTE_VALUES[LOWER]
SEGMENT = 1 << 20


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word; A-Z count as a-z, words are parted by ASCII white space."""
    if len(text) <= SEGMENT:
        return _segment(np.frombuffer(text, np.uint8))
    data, out, start = np.frombuffer(text, np.uint8), [], 0
    while start < len(data):  # cut at white space, so that memory stays bounded by the longest word
        end = start + SEGMENT
        while end < len(data) and not IS_SPACE[data[end]]:
            end += 1
        out.append(_segment(data[start:end]))
        start = end
    return np.concatenate(out)


def _segment(data: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~IS_SPACE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    c = prefix_hash(LOWER_VALUES[data])
    h = (c[ends] - c[starts]) * powers(len(data) + 1)[1][starts]
    return splitmix(h + (ends - starts).astype(np.uint64))


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct shingles; fewer words than ``width`` make one shingle, no words none."""
    words = word_hashes(text)
    n = len(words)
    if n == 0:
        return words
    size = min(width, n)
    total = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        total = total * np.uint64(0xA0761D6478BD642F) + words[k : n - size + 1 + k]
    return np.unique(splitmix(total))
