"""Compressed bitmaps of 16-bit numbers with multiplicities, and rank queries on them.

A *cell* counts how often each of 65,536 numbers occurs. It is kept as planes: plane ``b`` is the set of numbers whose
count has bit ``b`` set. A set is stored in the shortest of three forms: its numbers, its runs, or 8 KB of bits.
"""

from __future__ import annotations

import numpy as np

WIDTH = 16
SIZE = 1 << WIDTH
# The first byte of each form.
NUMBERS, RUNS, BITS = b"n", b"r", b"b"


def pack(numbers: np.ndarray) -> bytes:
    """A set, given as sorted distinct numbers below 65,536."""
    breaks = np.flatnonzero(np.diff(numbers) != 1) + 1
    runs = len(breaks) + 1 if len(numbers) else 0
    sizes = {NUMBERS: 2 * len(numbers), RUNS: 4 * runs, BITS: SIZE // 8}
    form = min(sizes, key=sizes.get)
    if form == NUMBERS:
        return form + numbers.astype("<u2").tobytes()
    if form == RUNS:
        first = numbers[np.concatenate([[0], breaks])]
        last = numbers[np.concatenate([breaks - 1, [len(numbers) - 1]])]
        return form + np.stack([first, last]).astype("<u2").tobytes()
    bits = np.zeros(SIZE, bool)
    bits[numbers] = True
    return form + np.packbits(bits, bitorder="little").tobytes()


def unpack(packed: bytes) -> np.ndarray:
    """The numbers of a set, ascending."""
    form, body = packed[:1], packed[1:]
    if form == NUMBERS:
        return np.frombuffer(body, "<u2").astype(np.int64)
    if form == RUNS:
        first, last = np.frombuffer(body, "<u2").astype(np.int64).reshape(2, -1)
        sizes = last - first + 1
        return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return np.flatnonzero(np.unpackbits(np.frombuffer(body, np.uint8), bitorder="little"))


def popcount(packed: bytes) -> int:
    form, body = packed[:1], packed[1:]
    if form == NUMBERS:
        return len(body) // 2
    if form == RUNS:
        first, last = np.frombuffer(body, "<u2").astype(np.int64).reshape(2, -1)
        return int((last - first + 1).sum())
    return int(np.bitwise_count(np.frombuffer(body, "<u8")).sum())


def directory(packed: bytes) -> np.ndarray | None:
    """How many numbers lie before each 64-bit word of the bits, or before each run; plain numbers need none."""
    form, body = packed[:1], packed[1:]
    if form == NUMBERS:
        return None
    if form == RUNS:
        first, last = np.frombuffer(body, "<u2").astype(np.int64).reshape(2, -1)
        sizes = last - first + 1
    else:
        sizes = np.bitwise_count(np.frombuffer(body, "<u8")).astype(np.int64)
    return np.cumsum(sizes) - sizes


def rank(packed: bytes, before: np.ndarray | None, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each asked number, how many of the set are smaller, and whether it is in the set; ``before`` is the directory."""
    form, body = packed[:1], packed[1:]
    if form == NUMBERS:
        numbers = np.frombuffer(body, "<u2").astype(np.int64)
        at = np.searchsorted(numbers, asked)
        return at, np.searchsorted(numbers, asked, "right") > at
    if form == RUNS:
        first, last = np.frombuffer(body, "<u2").astype(np.int64).reshape(2, -1)
        run = np.searchsorted(first, asked, "right") - 1  # the last run that starts at or before the number
        held = np.maximum(run, 0)
        inside = (run >= 0) & (asked <= last[held])
        smaller = np.where(run < 0, 0, before[held] + np.minimum(asked - first[held], last[held] - first[held] + 1))
        return smaller, inside
    words = np.frombuffer(body, "<u8")[asked >> 6]
    bit = (asked & 63).astype(np.uint64)
    below = words & ((np.uint64(1) << bit) - np.uint64(1))
    return before[asked >> 6] + np.bitwise_count(below), (words >> bit & np.uint64(1)) == 1


def planes(numbers: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """A cell from its ascending distinct numbers and how often each occurs."""
    return [pack(numbers[(counts >> b) & 1 == 1]) for b in range(int(counts.max(initial=0)).bit_length())]


def merge(cells: list[list[bytes]]) -> list[bytes]:
    """The cell that counts what all the given ones count."""
    if len(cells) == 1:
        return cells[0]
    parts = [(unpack(plane), 1 << b) for cell in cells for b, plane in enumerate(cell)]
    numbers, at = np.unique(np.concatenate([held for held, _ in parts]), return_inverse=True)
    counts = np.zeros(len(numbers), np.int64)
    np.add.at(counts, at, np.repeat([weight for _, weight in parts], [len(held) for held, _ in parts]))
    return planes(numbers, counts)


def total(cell: list[bytes]) -> int:
    return sum(popcount(plane) << b for b, plane in enumerate(cell))


def ranks(cell: list[bytes], asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each asked number, the total count of smaller ones, and its own count."""
    smaller, own = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
    for b, plane in enumerate(cell):
        less, held = rank(plane, directory(plane), asked)
        smaller += less.astype(np.int64) << b
        own += held.astype(np.int64) << b
    return smaller, own
