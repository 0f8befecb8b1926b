"""Sets of word shingles as 64-bit hashes, for many texts at once."""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Bytes that part words, and A-Z in lower case.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = _U(0x9FB21C651E98DF25)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A permutation of 64-bit integers whose bits all depend on all of the argument's."""
    x = x + _U((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (1 << 64) - 1)
    x = (x ^ x >> _U(30)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ x >> _U(27)) * _U(0x94D049BB133111EB)
    return x ^ x >> _U(31)


def shingle_sets(texts: list[str | None], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles of ``width`` words.

    Words are runs of bytes other than space, tab, line feed, vertical tab, form feed
    and carriage return, with A-Z in lower case.  A text with fewer words has its whole
    sequence as its one shingle; one without words, or null, has the empty set.
    """
    raw = [(t or "").encode() for t in texts]
    data = _LOWER[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
    ends = np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw)))
    inside = ~_SPACE[data]
    edges = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return [np.empty(0, np.uint64) for _ in texts]
    lengths = stops - starts
    chars = np.flatnonzero(inside)
    offsets = np.cumsum(lengths) - lengths
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
    place = np.arange(len(chars)) - np.repeat(offsets, lengths)
    words = mix(np.add.reduceat((data[chars].astype(np.uint64) + _U(1)) * powers[place], offsets), 1) ^ mix(lengths.astype(np.uint64), 2)
    first = np.searchsorted(starts, ends - np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw)))
    last = np.searchsorted(starts, ends)
    n = len(words)
    rolled = np.zeros(max(n - width + 1, 0), np.uint64)
    for i in range(width):
        rolled += mix(words[i : n - width + 1 + i], 3 + i) if len(rolled) else rolled
    rolled = mix(rolled)
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            short = sum((mix(words[a + i : a + i + 1], 40 + i) for i in range(b - a)), np.array([b - a], np.uint64))
            out.append(mix(short, 39))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def identity(found: np.ndarray, salt: int) -> int:
    """A hash of a set as a signed 64-bit integer."""
    return int(mix(mix(found, salt).sum(keepdims=True) + _U(len(found)), salt)[0].astype(np.int64))


SKETCH_LONGS = 8


def sketch(found: np.ndarray) -> np.ndarray:
    """For each of 512 cells, whether an odd number of elements falls into it.

    Sketches of two sets differ in no more cells than the sets differ in elements.
    """
    cells = (mix(found, 77) >> _U(55)).astype(np.int64)
    odd = (np.bincount(cells, minlength=512) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8")
