"""An FM-index over the words of a shard of texts: suffix order, wavelet matrix, sampled positions.

The shard is one sequence of word numbers with a 0 after each text. ``build`` sorts its suffixes by
prefix doubling, where after each round only suffixes that still look alike take part; texts end in
marks that differ from each other, so no comparison goes on into the next text. What is kept is the
Burrows-Wheeler transform as bit planes, the vocabulary, and the positions of every ``RATE``-th word
and of the first word of each text. Searching works on many phrases at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

RATE = 16


def suffix_order(keys: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``keys`` in their order; the last key must come only once."""
    n, width = len(keys), max(1, int(keys.max()).bit_length())
    known = max(1, min(4, 62 // width))
    padded = np.concatenate([keys.astype(np.int64), np.zeros(known, np.int64)])
    packed = padded[:n].copy()
    for k in range(1, known):
        packed = (packed << width) | padded[k : k + n]
    order = np.argsort(packed)
    rank = np.empty(n, np.int64)
    slots, value = np.arange(n), packed[order]
    while len(slots):
        first = np.empty(len(slots), bool)
        first[0] = True
        np.not_equal(value[1:], value[:-1], out=first[1:])
        group = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        rank[order[slots]] = group
        alone = first.copy()
        alone[:-1] &= first[1:]
        slots, group = slots[~alone], group[~alone]
        starts = order[slots]
        value = group * n + rank[starts + known] if len(slots) else group
        new = np.argsort(value)
        order[slots], value = starts[new], value[new]
        known *= 2
    return order


class BitPlane:
    """Bits with the number of ones before any place."""

    def __init__(self, packed: bytes, n: int) -> None:
        self.words = np.frombuffer(packed.ljust((n // 64 + 1) * 8, b"\0"), "<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.zeros = n - int(ones.sum())

    @staticmethod
    def pack(bits: np.ndarray) -> bytes:
        return np.packbits(bits, bitorder="little").tobytes()

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0

    def ones(self, at: np.ndarray) -> np.ndarray:
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        word = at >> 6
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


@dataclass
class FMIndex:
    n: int
    vocabulary: list[bytes]  # word k has number k + 1
    planes: list[BitPlane]  # most significant bit first
    counts: np.ndarray  # occurrences of each number, 0 first
    sampled: BitPlane  # by row: is its position kept?
    positions: np.ndarray  # of the sampled rows, in order of the rows
    _starts: np.ndarray = field(init=False)
    _less: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self._less = np.cumsum(self.counts) - self.counts
        every = np.arange(len(self.counts))
        self._starts = self._follow(every, np.zeros(len(every), np.int64))

    def _follow(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Down the planes by each symbol's bits."""
        for k, plane in enumerate(self.planes):
            one = (symbols >> (len(self.planes) - 1 - k)) & 1
            ones = plane.ones(at)
            at = np.where(one == 1, plane.zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol comes in the transform before the place ``at``."""
        return self._follow(symbols, at) - self._starts[symbols]

    def step_back(self, rows: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that begin one word earlier."""
        symbols, at = np.zeros(len(rows), np.int64), rows
        for plane in self.planes:
            one, ones = plane.get(at), plane.ones(at)
            symbols = 2 * symbols + one
            at = np.where(one, plane.zeros + ones, at - ones)
        return self._less[symbols] + at - self._starts[symbols]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of a matrix of word numbers, a phrase a row; numbers under 1 never match.

        Gives the phrases found and the first and last-but-one of their rows.
        """
        alive = np.flatnonzero((phrases > 0).all(axis=1))
        low = np.zeros(len(alive), np.int64)
        high = np.full(len(alive), self.n, np.int64)
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbols = phrases[alive, column]
            low = self._less[symbols] + self.rank(symbols, low)
            high = self._less[symbols] + self.rank(symbols, high)
            on = low < high
            alive, low, high = alive[on], low[on], high[on]
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The positions of rows: back word by word to the next sampled one."""
        found = np.empty(len(rows), np.int64)
        going, steps = np.arange(len(rows)), 0
        while len(going):
            here = self.sampled.get(rows)
            at = self.positions[self.sampled.ones(rows[here])]
            found[going[here]] = at.astype(np.int64) + steps
            going, rows = going[~here], self.step_back(rows[~here])
            steps += 1
        return found

    def to_row(self) -> dict[str, bytes | int]:
        return {
            "n": self.n,
            "vocabulary": b" ".join(self.vocabulary),
            "planes": b"".join(p.words.tobytes() for p in self.planes),
            "counts": self.counts.astype("<u4").tobytes(),
            "sampled": self.sampled.words.tobytes(),
            "positions": self.positions.astype("<u4").tobytes(),
        }

    @classmethod
    def from_row(cls, row: dict) -> FMIndex:
        n, size = row["n"], (row["n"] // 64 + 1) * 8
        raw = row["planes"]
        return cls(
            n,
            row["vocabulary"].split(b" "),
            [BitPlane(raw[i : i + size], n) for i in range(0, len(raw), size)],
            np.frombuffer(row["counts"], "<u4").astype(np.int64),
            BitPlane(row["sampled"], n),
            np.frombuffer(row["positions"], "<u4"),
        )


def build(symbols: np.ndarray, vocabulary: Sequence[bytes], rate: int = RATE) -> FMIndex:
    """The index of texts of word numbers from 1, each text closed by a 0."""
    n, ends = len(symbols), symbols == 0
    texts = int(ends.sum())
    keys = symbols.astype(np.int64) + (texts - 1)
    keys[ends] = np.arange(texts)
    order = suffix_order(keys)
    transform = symbols[order - 1].astype(np.int64)

    kept = np.zeros(n, bool)
    kept[::rate] = True
    kept[1:] |= ends[:-1]
    mark = kept[order]

    planes, rest = [], transform
    for bit in range(max(1, len(vocabulary).bit_length()) - 1, -1, -1):
        one = (rest >> bit) & 1 == 1
        planes.append(BitPlane(BitPlane.pack(one), n))
        rest = np.concatenate([rest[~one], rest[one]])
    counts = np.bincount(symbols, minlength=len(vocabulary) + 1)
    return FMIndex(
        n,
        list(vocabulary),
        planes,
        counts.astype(np.int64),
        BitPlane(BitPlane.pack(mark), n),
        order[mark].astype(np.uint32),
    )
