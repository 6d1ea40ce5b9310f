"""Word shingles of whole texts as 64-bit hashes, computed on the bytes of an Arrow batch.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased; none of these bytes occurs inside
a longer UTF-8 sequence. A word's hash is a polynomial of its bytes modulo 2**64, mixed; a shingle's hash mixes
those of its words in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 3
PIECE_BYTES = 4 << 20
STRIPE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
WEIGHTS = np.array(
    [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64
)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(2)
def _powers(base: int, n: int) -> np.ndarray:
    made = np.full(n, base, dtype=np.uint64)
    made[0] = 1
    return np.cumprod(made)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1), kept for the usual length."""
    return _powers(base, STRIPE_BYTES)[:n] if n <= STRIPE_BYTES else _powers.__wrapped__(base, n)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word of the texts data[offsets[i]:offsets[i + 1]], in order."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + STRIPE_BYTES, side="right")))
        high = ends[to - 1]
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_LOWER[data[low:high]] * powers(BASE, high - low), out=sums[1:])
        s = starts[at:to] - low
        hashes[at:to] = (sums[ends[at:to] - low] - sums[s]) * powers(INVERSE, high - low)[s]
        at = to
    return mix(hashes), np.searchsorted(offsets[1:], starts, side="right")


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """For each text its distinct shingle hashes, ascending; fewer words than `size`: one hash of all of them."""
    if not 1 <= size <= len(WEIGHTS):
        raise ValueError(f"shingles have 1 to {len(WEIGHTS)} words")
    words, text = word_hashes(data, offsets)
    n = len(offsets) - 1
    bounds = np.searchsorted(text, np.arange(n + 1))
    weights = WEIGHTS[:size]
    rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        rolled += mix(words[k : k + len(rolled)] * weights[k] + np.uint64(k))
    rolled = mix(rolled)
    sets = []
    for low, high in zip(bounds[:-1], bounds[1:]):
        if high - low >= size:
            sets.append(np.unique(rolled[low : high - size + 1]))
        elif high > low:
            short = mix(words[low:high] * weights[: high - low] + np.arange(high - low, dtype=np.uint64))
            sets.append(mix(np.array([short.sum() + np.uint64(high - low)], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def text_pieces(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over row ranges of bounded size; null texts are empty."""
    texts = pc.fill_null(batch.column(column), "").cast(pa.large_binary())
    _, where, content = texts.buffers()
    ends = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(content, np.uint8) if content else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(ends, ends[row] + PIECE_BYTES, side="right")) - 1)
        yield row, to, data[ends[row] : ends[to]], ends[row : to + 1] - ends[row]
        row = to
