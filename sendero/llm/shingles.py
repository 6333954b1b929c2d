"""64-bit hashes of words and word windows, for many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

# A common 64-bit finaliser's multipliers and shifts.
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SHIFTS = np.uint64(30), np.uint64(27), np.uint64(31)
BASE, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
BYTE_VALUES = np.random.default_rng(11).integers(1, 2**63, 256, np.uint64) | np.uint64(1)
# The six ASCII characters that part words.
PARTING = np.zeros(256, bool)
PARTING[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> SHIFTS[0])) * MIX_1
    values = (values ^ (values >> SHIFTS[1])) * MIX_2
    return values ^ (values >> SHIFTS[2])


def powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(min(n, 1), np.uint64), np.full(max(n - 1, 0), base)]), dtype=np.uint64)


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of bytes."""
    inside = np.concatenate([[False], ~PARTING[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, counts)``: the words' hashes of all texts in a row, and how many each text has."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    starts, ends = word_places(data)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    limits = np.cumsum(sizes + 1)
    counts = np.diff(np.searchsorted(starts, limits), prepend=0)
    if not len(starts):
        return np.empty(0, np.uint64), counts
    lengths = ends - starts
    letters = BYTE_VALUES[data[~PARTING[data]]]
    first = np.cumsum(lengths) - lengths
    within = np.arange(len(letters)) - np.repeat(first, lengths)
    letters *= powers(BASE, int(lengths.max()))[within]
    return mix(np.add.reduceat(letters, first)), counts


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash per start of ``size`` consecutive words; windows that cross texts are for the caller to leave out."""
    n = max(len(words) - size + 1, 0)
    total = np.zeros(n, np.uint64)
    for offset, factor in enumerate(powers(STEP, size)):
        total += words[offset:offset + n] * factor
    return mix(total)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of ``[start, start + size)`` of each range, in a row."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, counts)``: each text's distinct shingles, sorted, in a row, and how many there are.

    A text with fewer words than ``size`` has its whole sequence as one shingle; one without words has none.
    """
    words, counts = word_hashes(texts)
    begins = np.cumsum(counts) - counts
    hashes = window_hashes(words, size)[ranges(begins, np.maximum(counts - size + 1, 0))]
    owners = np.repeat(np.arange(len(texts)), np.maximum(counts - size + 1, 0))
    short = np.flatnonzero((counts > 0) & (counts < size))
    whole = [mix(np.array([(words[b:b + n] * powers(STEP, n)).sum(dtype=np.uint64) + np.uint64(n)]))[0]
             for b, n in zip(begins[short], counts[short])]
    hashes = np.concatenate([hashes, np.array(whole, np.uint64)])
    owners = np.concatenate([owners, short])
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[new], np.bincount(owners[new], minlength=len(texts))
