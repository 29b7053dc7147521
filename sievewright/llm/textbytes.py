"""Whole columns of text as byte arrays, with words and windows hashed by numpy at once.

Hashes are polynomials modulo 2**64 over a random value per byte, then mixed. The
hash of a span is a difference of running sums, so a word costs a few array operations
whatever its length. Texts are taken in slices of about ``SLICE`` bytes to stay in
cache; a longer text makes a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 19
U = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(20817).integers(0, 1 << 64, 256, dtype=U)
_powers = [np.ones(1, U), np.ones(1, U)]

#: Word separators of every contract here: blank and 0x09 to 0x0D.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators where punctuation counts as such: every ASCII byte but letters and digits.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Byte values with A-Z as a-z.
FOLDED = _BYTES.copy()
FOLDED[65:91] = _BYTES[97:123]
RAW = _BYTES


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, n at least."""
    if len(_powers[0]) < n:
        size = 1 << max(20, (n - 1).bit_length())
        for k, base in enumerate((_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64))):
            x = np.full(size, base, U)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the word."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of an Arrow string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = column.cast(pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string())
    if large.null_count:
        large = large.fill_null(b"" if pa.types.is_large_binary(large.type) else "")
    _, at, data = large.buffers()
    offsets = np.frombuffer(at, np.int64)[large.offset : large.offset + len(large) + 1] if len(large) else np.zeros(1, np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts with ``most`` bytes together, or of one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def running(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Running polynomial sums, n+1 long; see span_hash."""
    out = np.zeros(len(data) + 1, U)
    np.cumsum(values[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mixed hash of each span [start, end), the same wherever its bytes stand."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


def words(data: np.ndarray, offsets: np.ndarray, white: np.ndarray = WHITE, values: np.ndarray = FOLDED):
    """(starts, ends, hashes, first word of each text and the total) of the words of a slice."""
    n = len(data)
    inside = ~white[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    if n:
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < n)]
        before[cuts], after[cuts - 1] = False, False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, span_hash(running(data, values), starts, ends), np.searchsorted(starts, offsets)


def take_bytes(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """A matrix of ``width`` bytes from each start (which must fit)."""
    return np.lib.stride_tricks.sliding_window_view(data, width)[starts]


def binary_column(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def list_column(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of a matrix as a list column."""
    n, k = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(matrix.ravel(), kind))
