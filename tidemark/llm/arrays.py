"""Text columns as flat byte arrays, and hashes of words and word n-grams, inside Arrow tasks.

Everything here works on one Arrow batch with numpy. Hashes are 64 bits wide; equal hashes are
taken as equal words or n-grams.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Blank characters of ``[^\x20\x09-\x0D]+``.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
# ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing: digits, letters, everything above ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX_1
        x = (x ^ (x >> np.uint64(27))) * _MIX_2
        return x ^ (x >> np.uint64(31))


def chain(h: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Hash of a sequence extended by one value."""
    with np.errstate(over="ignore"):
        return mix(h * _ODD + value + _MIX_2)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets of the texts; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = 1 << 19):
    """Ranges of neighbouring texts with about ``most`` bytes together, to bound working memory."""
    start = 0
    while start < len(offsets) - 1:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield start, end
        start = end


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes in ``kind``, and the n + 1 word offsets of the texts."""
    inside = kind[data]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[first] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[np.append(first[1:], len(data)) - 1 if len(first) else first] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at_byte = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    length = (ends - starts).astype(np.int64)
    h = mix(length.astype(np.uint64))
    at, todo = starts.astype(np.int64), np.arange(len(starts))
    left = length
    while len(todo):
        value = at_byte[at]
        short = np.minimum(left, 8)
        value &= np.where(short == 8, np.uint64(2**64 - 1), (np.uint64(1) << (short * 8).astype(np.uint64)) - np.uint64(1))
        h[todo] = chain(h[todo], value)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return h


def ngram_hashes(h: np.ndarray, word_offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each n consecutive words of one text, and the n + 1 offsets of the texts in it.

    A text with fewer words has none.
    """
    count = np.maximum(np.diff(word_offsets) - n + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(word_offsets[:-1] - offsets[:-1], count) + np.arange(offsets[-1])
    out = np.full(len(first), np.uint64(n))
    for k in range(n):
        out = chain(out, h[first + k])
    return out, offsets
