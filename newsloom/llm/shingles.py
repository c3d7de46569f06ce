"""Sets of word shingles as sorted 64-bit hashes, computed batch by batch with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from newsloom.llm.language import byte_chunks

#: Per byte a random odd-looking number; words are polynomials of them.
LETTER = np.random.default_rng(1234).integers(1, 1 << 63, 256, np.uint64)
LETTER[65:91] = LETTER[97:123]
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
STEPS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * STEPS[0]
    x = x ^ (x >> np.uint64(27))
    x = x * STEPS[1]
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(0, n - 1), BASE, np.uint64)]), dtype=np.uint64)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words before each text and in all) of texts lying end to end; ASCII case is ignored."""
    gap = BLANK[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = gap[1:] | gap[:-1]
    edge[offsets] = True
    start = np.flatnonzero(edge[:-1] & ~gap)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    end = np.flatnonzero(edge[1:] & ~gap) + 1
    lengths = end - start
    # A word's letters times powers that count from its start.
    place = np.arange(len(data)) - np.repeat(start, np.diff(np.append(start, len(data)))) if start[0] == 0 else None
    if place is None:
        place = np.empty(len(data), np.int64)
        place[: start[0]] = 0
        place[start[0] :] = np.arange(start[0], len(data)) - np.repeat(start, np.diff(np.append(start, len(data))))
    value = LETTER[data] * _powers(int(place.max()) + 1)[place]
    value[gap] = 0
    words = mixed(np.add.reduceat(value, start) + lengths.astype(np.uint64))
    return words, np.searchsorted(start, offsets)


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text; texts of fewer words are one shingle."""
    for first, rows, data, offsets in byte_chunks(column):
        words, before = word_hashes(data, offsets)
        joined = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            joined = mixed(joined + words[k : k + len(joined)] + BASE)
        for row in range(rows):
            a, b = int(before[row]), int(before[row + 1])
            if b - a >= width:
                own = np.sort(joined[a : b - width + 1])
                if len(own) > 1:
                    own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            elif b > a:
                one = np.zeros(1, np.uint64)
                for w in words[a:b]:
                    one = mixed(one + w + BASE)
                own = mixed(one + np.uint64(b - a))
            else:
                own = words[:0]
            yield first + row, own


def digest(sets: np.ndarray) -> int:
    """One number for a set, the same whatever the order."""
    with np.errstate(over="ignore"):
        return int(mixed(np.add.reduce(mixed(sets ^ BASE)) + np.uint64(len(sets))).astype(np.int64)) if len(sets) else 0
