"""Vectorised scanning and hashing of whole Arrow text columns.

A batch of texts is one UTF-8 buffer with offsets.  Words are found with a
256-entry separator table and hashed through prefix sums: with
``H[i] = sum(code[b[j]] * p**j for j < i)`` (mod 2**64), the bytes ``s..e`` hash
to ``(H[e] - H[s]) * p**-s``, wherever they stand.  So no Python object is made
for a word or a shingle.  Buffers are cut into slices of whole texts of about
``SLICE_BYTES`` so that memory doesn't follow the Arrow batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15 | 1)
_powers = np.ones(1, _U)
_inverse_powers = np.ones(1, _U)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit words."""
    x = np.asarray(x, _U).copy()
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse_powers
    if len(_powers) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        inverse = _U(pow(int(_MULTIPLIER), -1, 1 << 64))
        one = np.ones(size, _U)
        one[1:] = _MULTIPLIER
        _powers = np.cumprod(one, dtype=_U)
        one[1:] = inverse
        _inverse_powers = np.cumprod(one, dtype=_U)
    return _powers, _inverse_powers


def separators(kind: str) -> np.ndarray:
    """A table of 256: whether a byte separates words.

    ``space``: words are ``[^\\x20\\x09-\\x0D]+``; ``alnum``: words are
    ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of text with A-Z in lower case.
    """
    table = np.zeros(256, bool)
    if kind == "space":
        table[[0x20, *range(0x09, 0x0E)]] = True
    elif kind == "alnum":
        table[:128] = True
        for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
            table[low : high + 1] = False
    else:
        raise ValueError(kind)
    return table


def byte_codes(fold_ascii: bool = True) -> np.ndarray:
    """A pseudo-random code for each byte; A-Z share those of a-z if folded."""
    codes = mix64(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
    if fold_ascii:
        codes[0x41:0x5B] = codes[0x61:0x7B]
    return codes


@dataclass
class Slice:
    """Some whole texts of a batch: rows first..last (exclusive)."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


@dataclass
class Words:
    """The words of a slice: byte bounds, text number and prefix sums of hashes."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    first_of: np.ndarray
    sums: np.ndarray

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word."""
        return self.span_hashes(self.starts, self.ends, seed)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each span of bytes."""
        _, inverse = _tables(len(self.sums))
        raw = (self.sums[ends] - self.sums[starts]) * inverse[starts]
        return mix64(raw + (ends - starts).astype(_U) * _U(0xA24BAED4963EE407) + _U(seed))


def as_strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One array of 64-bit offset strings, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a column into runs of whole texts of about `limit` bytes; one longer text stands alone."""
    column = as_strings(column)
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, n + 1 + column.offset)[column.offset :]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        low, high = int(bounds[first]), int(bounds[last])
        yield Slice(first, last, whole[low:high], bounds[first : last + 1] - low)
        first = last


def scan_words(part: Slice, separates: np.ndarray, codes: np.ndarray) -> Words:
    """Find and hash the words of every text of a slice; no word crosses two texts."""
    data, offsets = part.data, part.offsets
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~separates[data]
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begins[edges] = inside[edges + 1]
    stops[edges - 1] = inside[edges]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    first_of = np.searchsorted(starts, offsets)
    powers, _ = _tables(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(codes[data] * powers[:n], dtype=_U, out=sums[1:])
    return Words(starts, ends, text, first_of, sums)


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for every `width` consecutive word hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = np.full(n, width * 0x632BE59BD9B4E019 & (1 << 64) - 1, _U)
    for i in range(width):
        total = (total ^ hashes[i : i + n]) * _U(0x9FB21C651E98DF25)
        total ^= total >> _U(29)
    return mix64(total)


def shingle_sets(part: Slice, words: Words, width: int) -> Iterator[np.ndarray]:
    """For each text of the slice its sorted distinct shingle hashes (63 bits).

    A text with fewer words than `width` has its whole word sequence as its one
    shingle; a text without words has none.
    """
    hashes = words.hashes()
    every = shingle_hashes(hashes, width) >> _U(1)
    first_of = words.first_of
    for i in range(part.last - part.first):
        low, high = int(first_of[i]), int(first_of[i + 1])
        if high - low >= width:
            found = np.sort(every[low : high - width + 1])
            if len(found) > 1:
                keep = np.empty(len(found), bool)
                keep[0] = True
                np.not_equal(found[1:], found[:-1], out=keep[1:])
                found = found[keep]
            yield found
        elif high > low:
            yield shingle_hashes(hashes[low:high], high - low) >> _U(1)
        else:
            yield np.zeros(0, _U)


def jaccard_counts(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and union of two sorted distinct arrays."""
    if not len(a) or not len(b):
        return 0, len(a) + len(b)
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    both = int(np.count_nonzero(b[at] == a))
    return both, len(a) + len(b) - both
