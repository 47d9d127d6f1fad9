"""Vectorised word shingling of whole Arrow batches.

Words are maximal runs of bytes other than space and 0x09-0x0D, after lower-casing A-Z.
Every word gets a 64-bit polynomial hash taken from one prefix sum over the batch's bytes,
and every shingle a mixed hash of its words' hashes, so no Python object is made per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_STEP = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
#: bytes that are hashed in one go; a batch is cut into such slices between documents
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.up) < n + 1:
        size = max(n + 1, 1 << 20)
        up, down = np.full(size, _P, np.uint64), np.full(size, _P_INV, np.uint64)
        up[0] = down[0] = 1
        _powers.up, _powers.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers.up, _powers.down


_powers.up = _powers.down = np.zeros(0, np.uint64)


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z and the capitals of UTF-8's Latin-1 letters in lower case."""
    out = _LOWER[raw]
    if len(raw) > 1:
        capital = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        out[1:][capital] += 32
    return out


def word_spans(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and for each document the index of its first word (one more than documents)."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separator[raw]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[cuts] = inside[cuts]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    finishes[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, offsets)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span."""
    n = len(raw)
    up, down = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[raw] * up[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z in lower case, and for each document the index of its first word (one more than documents)."""
    starts, ends, first = word_spans(raw, offsets)
    return span_hashes(_LOWER[raw], starts, ends), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle in order, and for each document the index of its first shingle.

    A document of fewer than ``width`` words has its whole word sequence as one shingle; one without words has none.
    """
    counts = np.diff(first)
    made = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(made)])
    total = int(bounds[-1])
    if not total:
        return np.zeros(0, np.uint64), bounds
    document = np.repeat(np.arange(len(counts)), made)
    begin = first[:-1][document] + (np.arange(total) - bounds[:-1][document])
    short = counts[document] < width
    out = np.zeros(total, np.uint64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    for k in range(width):
        w = padded[begin + k]
        if short.any():
            w = np.where(short & (counts[document] <= k), np.uint64(k + 1), w)
        out = mix(out * _STEP[k % 5] + w)
    return out, bounds


def slices(raw: np.ndarray, offsets: np.ndarray):
    """(first document, end document, bytes, offsets) of slices of about SLICE_BYTES."""
    begin = 0
    while begin < len(offsets) - 1:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + SLICE_BYTES, "right")) - 1)
        yield begin, end, raw[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
        begin = end


def shingle_sets(column: pa.Array, width: int = 5):
    """For each row of a string column its sorted distinct shingle hashes."""
    raw, offsets = utf8_buffers(column)
    for _, _, part, cut in slices(raw, offsets):
        hashes, bounds = shingle_hashes(*word_hashes(part, cut), width)
        for i in range(len(cut) - 1):
            yield np.unique(hashes[bounds[i] : bounds[i + 1]])
