"""Sets of five-word shingles as sorted arrays of 64-bit hashes, computed in batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHINGLE = 5
BATCH_BYTES = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RANDOM = np.random.default_rng(20240104)
_LETTERS = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = _RANDOM.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Public 64-bit finaliser with two multiplications (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def batches(texts: list[bytes | None], most: int = BATCH_BYTES) -> Iterator[list[bytes]]:
    """The texts in order, in lists of bounded size (a longer text is its own)."""
    part, size = [], 0
    for text in texts:
        text = text or b""
        if part and size + len(text) > most:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text) + 1
    if part:
        yield part


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, sorted; A-Z are lower-cased.

    A text of fewer than five words has its whole sequence as its one shingle, a text
    without words has none.
    """
    joined = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    blank = _BLANK[joined]
    first = ~blank
    first[1:] &= blank[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in texts]
    ends = np.flatnonzero(blank & np.concatenate(([False], ~blank[:-1])))
    lengths = ends - starts
    powers = np.full(int(lengths.max()) + 1, _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    inside = np.flatnonzero(~blank)
    place = np.arange(len(inside)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    letters = _LETTERS[joined[inside]] * powers[place]
    words = mix(np.add.reduceat(letters, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.concatenate(([0], np.searchsorted(starts, text_ends)))
    whole = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE if len(whole) else 0):
        whole += words[k:k + len(whole)] * _PLACES[k]
    whole = mix(whole)
    found = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= SHINGLE:
            found.append(np.unique(whole[a:b - SHINGLE + 1]))
        elif b > a:
            short = (words[a:b] * _PLACES[:b - a]).sum(dtype=np.uint64, keepdims=True)
            found.append(mix(short + np.uint64(b - a)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found
