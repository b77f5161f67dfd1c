"""Words and word shingles of whole Arrow batches as 64-bit hashes.

A word is a maximal run of bytes other than space and 0x09-0x0D, with A-Z in
lower case.  Texts are worked off in blocks of a few megabytes, so memory does
not depend on the size of a batch or of a text (a single word is one block).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

BLOCK = 2 << 20  # bytes of text worked on at once
SHINGLE = 5  # words of a shingle
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, hence invertible modulo 2**64
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = [np.uint64(x | 1) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                                    0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def bounded_batches(spark: SparkSession) -> None:
    """Hand Python a few megabytes at a time, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _power(base: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(str(base))
    if known is None or len(known) < n:
        factors = np.full(max(n, BLOCK + 1), base, dtype=np.uint64)
        factors[0] = 1
        known = np.cumprod(factors, dtype=np.uint64)
        if len(known) <= 4 * BLOCK:
            _powers[str(base)] = known
    return known[:n]


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 offsets into them; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def _hash_block(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``raw`` and, for each edge, the words before it."""
    space = _SPACE[raw]
    first = ~space
    first[1:] &= space[:-1]
    inner = edges[(edges > 0) & (edges < len(raw))]
    first[inner] |= ~space[inner]
    starts = np.flatnonzero(first)
    last = ~space
    last[:-1] &= space[1:]
    last[inner - 1] |= ~space[inner - 1]
    ends = np.flatnonzero(last) + 1
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[_LOWER[raw]] * _power(_BASE, len(raw)), out=total[1:])
    hashes = (total[ends] - total[starts]) * _power(_BASE_INVERSE, len(raw))[starts]
    return mix(hashes + (ends - starts).astype(np.uint64)), np.searchsorted(starts, edges)


def _cut(raw: np.ndarray, begin: int, end: int) -> int:
    """End of a block of one long text: after white space, or the whole rest."""
    stop = begin + BLOCK
    while stop < end:
        found = np.flatnonzero(_SPACE[raw[stop - BLOCK : stop]])
        if len(found):
            return stop - BLOCK + int(found[-1]) + 1
        stop += BLOCK
    return end


def word_hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, word hashes, bounds of the rows among them) of bounded blocks."""
    raw, offsets = byte_column(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        begin = int(offsets[row])
        end_row = max(row + 1, int(np.searchsorted(offsets, begin + BLOCK, side="right")) - 1)
        end_row = min(end_row, n)
        end = int(offsets[end_row])
        if end - begin <= BLOCK:
            edges = offsets[row : end_row + 1] - begin
            hashes, bounds = _hash_block(raw[begin:end], edges)
        else:  # one long text
            parts, at = [], begin
            while at < end:
                stop = end if end - at <= BLOCK else _cut(raw, at, end)
                parts.append(_hash_block(raw[at:stop], np.array([0, stop - at]))[0])
                at = stop
            hashes = np.concatenate(parts)
            bounds = np.array([0, len(hashes)])
        yield row, end_row, hashes, bounds
        row = end_row


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes); fewer words than a shingle make one, none make none."""
    for row, end_row, words, bounds in word_hashes(column):
        n = len(words) - SHINGLE + 1
        if n > 0:
            sums = words[:n] * _STEP[0]
            for k in range(1, SHINGLE):
                sums += words[k : k + n] * _STEP[k]
            sums = mix(sums)
        for i in range(end_row - row):
            low, high = int(bounds[i]), int(bounds[i + 1])
            if high - low >= SHINGLE:
                yield row + i, np.unique(sums[low : high - SHINGLE + 1])
            elif high > low:
                few = words[low:high] * np.array(_STEP[: high - low])
                whole = few.sum(dtype=np.uint64, keepdims=True) + np.uint64(high - low)
                yield row + i, mix(whole)
            else:
                yield row + i, np.zeros(0, dtype=np.uint64)
