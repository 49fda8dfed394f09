"""Vectorised text primitives shared by the operators of this subpackage.

Everything works on Arrow string columns as flat UTF-8 byte buffers: one numpy
pass per step for a whole record batch, no Python loop over words. Hashes are
polynomial in a random odd base modulo 2**64 over prefix sums (so the hash of any
byte range is two gathers) and are then mixed by a finaliser, as the low bits of
an unmixed polynomial hash are weak.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse modulo 2**64
_INV = pow(BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: What a byte adds to the polynomial: fixed pseudo-random odd numbers.
BYTE_VALUE = (np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93)) ^ U64(0xA0761D6478BD642F)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE**0 .. BASE**(n-1) modulo 2**64, or those of its inverse."""
    key = "inverse" if inverse else "base"
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (max(n, 1) - 1).bit_length())
        have = np.full(size, _INV if inverse else BASE, dtype=U64)
        have[0] = 1
        _POWERS[key] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift rounds); works in place on a copy."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and len+1 offsets into them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums of byte value times BASE**position; len(data)+1 entries."""
    out = np.empty(len(data) + 1, U64)
    out[0] = 0
    step = BYTE_VALUE[data]
    step *= powers(len(data))
    np.cumsum(step, out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unmixed hash of each byte range, the same wherever the bytes stand."""
    return (prefix[ends] - prefix[starts]) * powers(len(prefix), inverse=True)[starts]


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes, first): words of all texts, and for each text the number of its first word.

    A word is a run of bytes other than space and \\x09-\\x0D; it never crosses a text's end.
    first has one entry more than there are texts. A-Z are lower-cased if asked.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~SPACE[data]
    begin = inside[1:-1] & ~inside[:-2]
    final = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    cuts = cuts[inside[cuts + 1] & inside[cuts]]  # a text's end between two bytes of words
    begin[cuts] = True
    final[cuts - 1] = True
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(final) + 1
    prefix = prefix_hashes(LOWER[data] if lower else data)
    hashes = mix(range_hashes(prefix, starts, ends))
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def owner(first: np.ndarray) -> np.ndarray:
    """For each word the number of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def crc32_of_ids(ids: np.ndarray) -> np.ndarray:
    """crc32 of each id written in decimal."""
    import zlib

    return np.fromiter((zlib.crc32(b"%d" % i) for i in ids.tolist()), np.int64, len(ids))
