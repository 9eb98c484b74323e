"""Words, lines and their hashes for a whole Arrow batch at a time, in numpy.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r. Its hash is
polynomial over 64 bits: prefix sums of byte codes times powers of an odd base give
every substring's hash by one subtraction, one product with the inverse power and a
mixing step. Memory is bounded by cutting batches into pieces of about
``PIECE_BYTES`` (one text more where a single text is longer).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim
except (OSError, AttributeError):  # another C library: it decides itself
    _LIBC = None

_U = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_ROLL = _U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits depend on all input bits."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CODE = mix((np.arange(256, dtype=np.uint64) + _U(1)) * _U(_BASE)) | _U(1)
_CODE_FOLDED = _CODE.copy()
_CODE_FOLDED[65:91] = _CODE[97:123]

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, PIECE_BYTES)
        steps = np.full(n, _U(_BASE))
        steps[0] = 1
        _powers = np.cumprod(steps)
        steps[1:] = _U(pow(_BASE, -1, 1 << 64))
        _inverses = np.cumprod(steps)
    return _powers, _inverses


def spread(counts: np.ndarray) -> np.ndarray:
    """Running totals with a leading zero."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


@dataclass
class Piece:
    """Consecutive texts of a batch: ``first`` is the position of the first of them."""

    first: int
    data: np.ndarray  # bytes of all texts
    bounds: np.ndarray  # byte offset of each text, and the end
    starts: np.ndarray  # byte offset of each word
    ends: np.ndarray
    words: np.ndarray  # number of the first word of each text, and the count of all
    fold: bool

    @property
    def n_texts(self) -> int:
        return len(self.bounds) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.words)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), self.n_words)

    def hash_spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte spans; equal spans have equal hashes wherever they stand."""
        powers, inverses = _power_tables(len(self.data) + 1)
        codes = (_CODE_FOLDED if self.fold else _CODE)[self.data]
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * powers[: len(codes)], out=sums[1:])
        raw = (sums[ends] - sums[starts]) * inverses[starts]
        return mix(raw + (ends - starts).astype(np.uint64))

    def word_hashes(self) -> np.ndarray:
        return self.hash_spans(self.starts, self.ends)

    def total(self, of_bytes: np.ndarray) -> np.ndarray:
        """Sums of a per-byte flag or number, by text."""
        sums = spread(of_bytes)
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]


def give_back() -> None:
    """Return freed memory to the system: worker processes live on between tasks."""
    pa.default_memory_pool().release_unused()
    if _LIBC:
        _LIBC.malloc_trim(0)


def pieces(
    texts: pa.Array, fold: bool = False, limit: int = PIECE_BYTES, most: int | None = None
) -> Iterator[Piece]:
    """Cut an Arrow string array into pieces. A null is an empty text.

    ``fold`` makes A-Z and a-z hash alike. ``most`` bounds the texts of a piece.
    """
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    _, where, content = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    content = np.frombuffer(content, np.uint8) if content else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), len(texts), low + most if most else len(texts))
        bounds = offsets[low : high + 1] - offsets[low]
        yield _piece(low, content[offsets[low] : offsets[high]], bounds, fold)
        low = high


def _piece(first: int, data: np.ndarray, bounds: np.ndarray, fold: bool) -> Piece:
    inside = ~_SPACE[data]
    head = np.zeros(len(data) + 1, bool)  # where a text begins, words are cut
    head[bounds] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | head[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | head[1:-1]
    starts = np.flatnonzero(opens)
    return Piece(
        first, data, bounds, starts, np.flatnonzero(closes) + 1,
        np.searchsorted(starts, bounds), fold,
    )


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words, across text borders too."""
    count = max(0, len(words) - n + 1)
    rolled = np.full(count, _U(n))
    for k in range(n):
        rolled = rolled * _ROLL + words[k : k + count]
        rolled ^= rolled >> _U(29)
    return mix(rolled)


def windows_inside(texts: np.ndarray, n: int) -> np.ndarray:
    """Starts of the runs of ``n`` words that lie in one text."""
    count = max(0, len(texts) - n + 1)
    return np.flatnonzero(texts[:count] == texts[n - 1 : n - 1 + count])


def in_text(keys: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Keys that are equal only for equal keys of the same text."""
    return mix(keys + mix(texts.astype(np.uint64) + _U(1)))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Positions of the keys that occur twice or more.

    A plain sort of numbers is several times faster than one that yields positions.
    """
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(0, np.int64)
    low = _U((1 << 20) - 1)
    maybe = np.zeros(1 << 20, bool)
    maybe[twice & low] = True
    chosen = np.flatnonzero(maybe[keys & low])  # few are left to look up
    at = np.searchsorted(twice, keys[chosen])
    at[at == len(twice)] = 0
    return chosen[twice[at] == keys[chosen]]


def later(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Those positions of ``among`` whose key has stood at an earlier one of them."""
    chosen = keys[among]
    order = np.argsort(chosen, kind="stable")
    again = np.zeros(len(order), bool)
    again[order[1:]] = chosen[order[1:]] == chosen[order[:-1]]
    return among[again]
