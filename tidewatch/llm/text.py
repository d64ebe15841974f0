"""Words of whole texts as arrays: a batch of texts is hashed by a few passes over its bytes.

A word is a run of bytes other than space and tab to carriage return. A
word's hash is a polynomial in its bytes modulo 2^64, mixed afterwards; hashes
of word sequences are polynomials in the word hashes, so that the hash of any
window comes from two running sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PART_BYTES = 4 << 20  # texts hashed together; a longer text is hashed alone

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _inverse(p: int) -> int:
    return pow(p, -1, 1 << 64)


_BYTE_P = 0xD6E8FEB86659FD93
_WORD_P = 0xA3B195354A39B70F
_TABLE = mix64(np.arange(1, 257, dtype=_U) * _ODD)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SIGN = np.zeros(256, bool)  # separators where only letters and digits make words
_SIGN[[c for c in range(128) if not chr(c).isalnum()]] = True
_powers: dict[int, np.ndarray] = {}


def powers(p: int, n: int) -> np.ndarray:
    """p^0 .. p^(n-1) modulo 2^64; kept while short."""
    have = _powers.get(p)
    if have is None or len(have) < n:
        x = np.full(max(n, 1), p, _U)
        x[0] = 1
        np.multiply.accumulate(x, out=x)
        have = x
        if n <= 2 * PART_BYTES:
            _powers[p] = x
    return have[:n]


def polynomial(values: np.ndarray, p: int) -> np.ndarray:
    """Running sums c with c[j] - c[i] = sum of values[k] p^k for i <= k < j."""
    c = np.zeros(len(values) + 1, _U)
    np.cumsum(values * powers(p, len(values)), out=c[1:])
    return c


def window_hashes(c: np.ndarray, start: np.ndarray, end: np.ndarray, p: int) -> np.ndarray:
    """Hash of values[start:end] from the running sums of ``polynomial``."""
    return mix64((c[end] - c[start]) * powers(_inverse(p), len(c))[start] + (end - start).astype(_U) * _ODD)


class Words:
    """Words of some texts: hashes, byte ranges, and the first word of each text (n + 1 offsets).

    With ``lower``, A-Z count as a-z; with ``letters``, words are runs of ASCII
    letters, digits and bytes from 128 only.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, letters: bool = False):
        n = len(data)
        solid = ~(_SIGN if letters else _SPACE)[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0] = True
            before[1:] = ~solid[:-1]
            after[-1] = True
            after[:-1] = ~solid[1:]
        self.start = np.flatnonzero(solid & (before | edge[:n]))
        self.end = np.flatnonzero(solid & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        values = _TABLE[_LOWER[data]] if lower else _TABLE[data]
        self.hash = window_hashes(polynomial(values, _BYTE_P), self.start, self.end, _BYTE_P)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def windows(self, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows of k words inside one text, and their hashes."""
        last = np.repeat(self.first[1:], np.diff(self.first))
        start = np.flatnonzero(np.arange(len(self.hash)) + k <= last)
        h = mix64(self.hash + _U(salt) * _ODD) if salt else self.hash
        return start, window_hashes(polynomial(h, _WORD_P), start, start + k, _WORD_P)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column and n + 1 offsets; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = PART_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of texts of about ``most`` bytes; no text is cut."""
    data, offsets = buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j
