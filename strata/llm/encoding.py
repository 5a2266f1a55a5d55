"""Token ids of whole texts by a tokenizers file, several times faster on running text.

A byte-level pre-tokenizer never joins what stands before a single space or line break with what
follows it, nor a letter or digit with the punctuation after it. So a text whose white space is
only single spaces and line breaks is cut there into units, each distinct unit goes to the library
once, and the ids are put together from a table of known units. Texts with other white space, or with
the string of an added token (such as ``<|endoftext|>``, which the library gives its own id), go to
the library whole. Both ways give the library's ids. All of it works on a batch's bytes at once.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Longer units are not remembered: their hashes are weaker, and they hardly come again.
_LONGEST = 64
#: Bytes of text worked through at a time, and new units encoded at a time.
_STRETCH, _NEW_UNITS = 1_000_000, 10_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_BYTE = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64)


def _classes() -> np.ndarray:
    """Of each byte: 1 space or line break, 2 letter or digit, 4 punctuation, 8 other white space.

    Other control characters count as white space too, which only sends more texts the long way.
    """
    kind = np.zeros(256, np.uint8)
    kind[:32] = kind[127] = 8
    kind[33:127] = 4
    for c in range(33, 127):
        if chr(c).isalnum():
            kind[c] = 2
    kind[[10, 32]] = 1
    return kind


_CLASS = _classes()

_LATIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else
    the next free one from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


def _wide_spaces(data: np.ndarray) -> np.ndarray:
    """Where white space beyond ASCII begins (U+0085, A0, 1680, 180E, 2000-200A, 2028 ...)."""
    at = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    a, b, c = data[at], padded[at + 1], padded[at + 2]
    general = (c >= 0x80) & (c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)
    hit = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    hit |= (a == 0xE1) & (((b == 0x9A) & (c == 0x80)) | ((b == 0xA0) & (c == 0x8E)))
    hit |= (a == 0xE2) & (((b == 0x80) & general) | ((b == 0x81) & (c == 0x9F)))
    hit |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    return at[hit]


class Encoder:
    """``limit`` bounds the units that are remembered (about 30 bytes each), nothing else."""

    def __init__(self, path: str, limit: int = 2_000_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._added = [t.content.encode() for t in added if t.content]
        self._limit = limit
        self._keys = np.empty(0, np.uint64)  # hashes of known units, sorted
        self._at = np.empty(0, np.int64)  # where their ids begin
        self._n = np.empty(0, np.int64)
        self._ids = np.empty(0, np.uint32)
        self._powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def vocabulary(self) -> int:
        return self._tokenizer.get_vocab_size()

    def _library(self, texts: list[str]) -> list[array]:
        out: list[array] = []
        for k in range(0, len(texts), 1000):  # the library's results are large
            found = self._tokenizer.encode_batch(texts[k : k + 1000], add_special_tokens=False)
            out += [array("I", e.ids) for e in found]
        return out

    def _words(self, units: list[str]) -> list[array]:
        """Ids of units; one word of Latin letters is one pre-token and goes to the model itself."""
        out: list[array | None] = [None] * len(units)
        word, model, rest = _LATIN.fullmatch, self._tokenizer.model.tokenize, []
        for i, unit in enumerate(units):
            if not word(unit):
                rest.append(i)
                continue
            known = unit.replace(" ", "Ġ", 1)
            if not unit.isascii():
                known = unit.encode().decode("latin-1").translate(_BYTE_LETTERS)
            out[i] = array("I", [t.id for t in model(known)])
        for i, ids in zip(rest, self._library([units[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def _power(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._powers[0]) < n:
            power, inverse = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
            power[0] = inverse[0] = 1
            self._powers = np.cumprod(power), np.cumprod(inverse)
        return self._powers

    def _hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each range of bytes, from one running sum over all of them."""
        power, inverse = self._power(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[: len(data)], out=total[1:])
        found = (total[ends] - total[starts]) * inverse[starts]
        return found ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def _units(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """For each unit where its ids begin in the returned table, and how many they are."""
        short = ends - starts <= _LONGEST
        hashes = self._hashes(data, starts, ends)
        # Long units keep apart by place: never equal to another, never remembered.
        keys, first, back, count = np.unique(
            np.where(short, hashes, np.arange(len(starts), dtype=np.uint64)),
            return_index=True, return_inverse=True, return_counts=True,
        )
        place = np.searchsorted(self._keys, keys)
        place[place == len(self._keys)] = 0
        known = (self._keys[place] == keys) & short[first] if len(self._keys) else keys != keys
        at, n = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        at[known], n[known] = self._at[place[known]], self._n[place[known]]
        new = np.flatnonzero(~known)
        raw, joined = memoryview(data), [self._ids]
        for k in range(0, len(new), _NEW_UNITS):
            block = new[k : k + _NEW_UNITS]
            a, b = starts[first[block]].tolist(), ends[first[block]].tolist()
            ids = self._words([str(raw[x:y], "utf-8") for x, y in zip(a, b, strict=True)])
            n[block] = [len(i) for i in ids]
            joined.append(np.frombuffer(b"".join([i.tobytes() for i in ids]), np.uint32))
        at[new] = len(self._ids) + np.cumsum(n[new]) - n[new]
        table = np.concatenate(joined)
        self._remember(keys, at, n, table, new[short[first[new]]], count)
        return at[back], n[back], table

    def _remember(self, keys, at, n, table, new, count) -> None:
        """Adds new units while there is room, those seen more than once in the batch first."""
        room = self._limit - len(self._keys)
        if room <= 0 or not len(new):
            return
        new = np.sort(new[np.argsort(-count[new], kind="stable")][:room])
        sizes = n[new]
        spread = np.repeat(at[new] - (np.cumsum(sizes) - sizes), sizes)
        own = table[spread + np.arange(len(spread))]
        begin = len(self._ids) + np.cumsum(sizes) - sizes
        self._ids = np.concatenate([self._ids, own])
        every = np.concatenate([self._keys, keys[new]])
        order = np.argsort(every, kind="stable")
        self._keys = every[order]
        self._at = np.concatenate([self._at, begin])[order]
        self._n = np.concatenate([self._n, sizes])[order]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one text after the other, and the number of ids of each text; NULL is empty."""
        flat, sizes = [np.empty(0, np.uint32)], [np.zeros(0, np.int64)]
        for found in self.stretches(texts):
            flat.append(found[0])
            sizes.append(found[1])
        return np.concatenate(flat), np.concatenate(sizes)

    def stretches(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """As ``encode``, for the next few texts at a time.

        Works through about ``_STRETCH`` bytes at a time, so its memory depends on the longest text
        and not on the batch.
        """
        texts = texts.fill_null("").cast(pa.large_string())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
        at = 0
        while at < len(texts):
            stop = int(np.searchsorted(bounds, bounds[at] + _STRETCH, side="right")) - 1
            stop = min(max(stop, at + 1), len(texts))
            if bounds[at] == bounds[stop]:
                yield np.empty(0, np.uint32), np.zeros(stop - at, np.int64)
            else:
                data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[at] : bounds[stop]]
                yield self._stretch(data, bounds[at : stop + 1] - bounds[at])
            at = stop

    def _added_tokens(self, data: np.ndarray) -> list[int]:
        """Where strings of added tokens begin; one that two texts form together does no harm."""
        raw, found = data.tobytes(), []
        for token in self._added:
            at = raw.find(token)
            while at >= 0:
                found.append(at)
                at = raw.find(token, at + 1)
        return found

    def _stretch(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin, end = bounds[:-1], bounds[1:]
        kind = _CLASS[data]
        space = kind == 1
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        odd = kind == 8
        odd[_wide_spaces(data)] = True
        odd[self._added_tokens(data)] = True
        odd[:-1] |= space[:-1] & (space[1:] | edge[1:-1])
        odd[-1] |= space[-1]
        odd |= space & edge[:-1]
        bad = np.concatenate([[0], np.cumsum(odd)])
        whole = bad[end] > bad[begin]
        # A unit begins with a text, a space or line break, or punctuation after a letter or digit.
        edge[:-1] |= space
        edge[1:-1] |= (kind[1:] == 4) & (kind[:-1] == 2)
        cuts = np.flatnonzero(edge)
        starts, ends = cuts[:-1], cuts[1:]
        owner = np.searchsorted(begin, starts, side="right") - 1
        if whole.any():
            starts, ends, owner = (x[~whole[owner]] for x in (starts, ends, owner))
        at, n, table = self._units(data, starts, ends)
        offsets = np.repeat(at - (np.cumsum(n) - n), n)
        offsets += np.arange(len(offsets))
        flat = table[offsets]
        sizes = np.bincount(owner, weights=n, minlength=len(begin)).astype(np.int64)
        if not whole.any():
            return flat, sizes
        odd_ones = np.flatnonzero(whole)
        raw = data.tobytes()
        found = self._library([raw[begin[i] : end[i]].decode() for i in odd_ones])
        before = np.cumsum(sizes) - sizes
        parts, last = [], 0
        for i, ids in zip(odd_ones, found, strict=True):
            parts += [flat[last : before[i]], np.frombuffer(ids.tobytes(), np.uint32)]
            last, sizes[i] = before[i], len(ids)
        return np.concatenate([*parts, flat[last:]]), sizes

    def lists(self, texts: list[str]) -> list[list[int]]:
        flat, sizes = self.encode(pa.array(texts, pa.string()))
        ends = np.cumsum(sizes)
        return [flat[e - s : e].tolist() for e, s in zip(ends, sizes, strict=True)]

    def encode_with_end(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with ``end_id`` after each text."""
        return _with_end(*self.encode(texts), end_id)

    def stretches_with_end(
        self, texts: pa.Array, end_id: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """As ``stretches``, with ``end_id`` after each text."""
        return (_with_end(*found, end_id) for found in self.stretches(texts))


def _with_end(flat: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.insert(flat, np.cumsum(sizes), end_id).astype("<u4", copy=False)
    return out, sizes + 1


def give_back() -> None:
    """Frees what the allocators keep: a worker that waits for its next task holds no more than
    it needs, since the executor works on beside it."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker, so that later tasks find known units."""
    return Encoder(path)
