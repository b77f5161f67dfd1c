"""Fill-in-middle: cut texts at unit ends and put the middle last.

The bytes of a batch become a sequence of character classes, held as wavelet matrices
over blocks of fixed size.  A unit (a line, a sentence, a word with the space behind it)
ends behind each character of some classes, so the unit ends up to any place are the sum
of the ranks of these classes there, and code points are the ranks of all classes but
continuation bytes.  The place behind the k-th unit end is found by the blocks' totals
and then by bisection on the ranks inside one block, for all texts of a batch at once.
Blocks ignore where texts begin, so a text of any length needs no more than its share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.llm.words import byte_column

BLOCK = 1 << 20  # bytes of a wavelet matrix
BITS = 3
CONTINUATION, FEED, SPACE, STOP, ALNUM, LEAD, OTHER = range(7)
#: classes behind whose characters a unit ends; the last unit of a text may lack its end
UNITS = {"line": (FEED,), "sentence": (FEED, STOP), "word": (FEED, SPACE)}
_CODE_POINTS = (FEED, SPACE, STOP, ALNUM, LEAD, OTHER)
PLAIN, PREFIX_FIRST, SUFFIX_FIRST = "plain", "psm", "spm"
_SCHEMA = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
)


@dataclass(frozen=True)
class FillParameters:
    unit: str = "line"
    seed: int = 7
    transformed: int = 100  # percent of the texts that are cut at all
    suffix_first: int = 50  # percent of those that show the suffix first
    prefix_mark: str = "<P>"
    suffix_mark: str = "<S>"
    middle_mark: str = "<M>"

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix_mark, self.suffix_mark, self.middle_mark


def _class_table() -> np.ndarray:
    table = np.full(256, OTHER, dtype=np.uint8)
    table[128:192] = CONTINUATION
    table[192:] = LEAD
    table[[9, 11, 12, 13, 32]] = SPACE
    table[10] = FEED
    for first, last in ("09", "AZ", "az"):
        table[ord(first) : ord(last) + 1] = ALNUM
    table[[ord(c) for c in ".!?"]] = STOP
    return table


_CLASS = _class_table()


class _Bits:
    """A bit sequence with the ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words), dtype=np.int32)
        np.cumsum(np.bitwise_count(words[:-1]), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Ranks of symbols below 2**BITS: one bit sequence per bit, stably sorted by the last."""

    def __init__(self, symbols: np.ndarray):
        self.levels: list[tuple[int, _Bits, int]] = []
        for shift in range(BITS - 1, -1, -1):
            ones = (symbols >> shift & 1).astype(bool)
            zeros = int(len(symbols) - np.count_nonzero(ones))
            self.levels.append((shift, _Bits(ones), zeros))
            if shift:
                symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before each place."""
        ends = np.append(at, 0)  # the range of the symbol begins where place 0 is led
        for shift, bits, zeros in self.levels:
            ones = bits.ones(ends)
            ends = zeros + ones if symbol >> shift & 1 else ends - ones
        return ends[:-1] - ends[-1]

    def count(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        return sum((self.rank(s, at) for s in symbols), np.zeros(len(at), dtype=np.int64))


class ClassRanks:
    """Counts and places of character classes over bytes, block by block."""

    def __init__(self, raw: np.ndarray, block: int = BLOCK):
        self.block, self.size = block, len(raw)
        starts = range(0, max(len(raw), 1), block)
        self.matrices = [WaveletMatrix(_CLASS[raw[s : s + block]]) for s in starts]
        self._before: dict[tuple[int, ...], np.ndarray] = {}

    def _length(self, number: int) -> int:
        return min(self.block, self.size - number * self.block)

    def before(self, symbols: tuple[int, ...]) -> np.ndarray:
        """Occurrences of the symbols before every block, and in all."""
        if symbols not in self._before:
            whole = [
                int(m.count(symbols, np.array([self._length(i)]))[0])
                for i, m in enumerate(self.matrices)
            ]
            self._before[symbols] = np.concatenate([[0], np.cumsum(whole, dtype=np.int64)])
        return self._before[symbols]

    def count(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """Occurrences before each place."""
        number = np.minimum(at // self.block, len(self.matrices) - 1)
        out = self.before(symbols)[number]
        for i in np.unique(number):
            own = number == i
            out[own] += self.matrices[i].count(symbols, at[own] - i * self.block)
        return out

    def behind(self, symbols: tuple[int, ...], nth: np.ndarray) -> np.ndarray:
        """The place just behind the n-th occurrence (from 1)."""
        before = self.before(symbols)
        number = np.searchsorted(before, nth, side="left") - 1
        out = np.zeros(len(nth), dtype=np.int64)
        for i in np.unique(number):
            own = number == i
            wanted = nth[own] - before[i]
            low = np.zeros(len(wanted), dtype=np.int64)
            high = np.full(len(wanted), self._length(i), dtype=np.int64)
            while (open_ := low < high).any():
                middle = (low + high) // 2
                reached = self.matrices[i].count(symbols, middle) >= wanted
                high = np.where(open_ & reached, middle, high)
                low = np.where(open_ & ~reached, middle + 1, low)
            out[own] = low + i * self.block
        return out


def _draws(ids: list[int | None], seed: int) -> np.ndarray:
    """Four 32-bit numbers per document, from its id alone."""
    drawn = np.empty((len(ids), 4), dtype=np.int64)
    for i, doc_id in enumerate(ids):
        digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
        drawn[i] = np.frombuffer(digest, dtype=">u4", count=4)
    return drawn


def _cut(batch: pa.RecordBatch, p: FillParameters) -> pa.RecordBatch:
    raw, offsets = byte_column(batch.column(1))
    base = int(offsets[0])
    raw, starts, ends = raw[base : int(offsets[-1])], offsets[:-1] - base, offsets[1:] - base
    ranks, ending = ClassRanks(raw), UNITS[p.unit]
    before = ranks.count(ending, starts)
    n = ranks.count(ending, ends) - before
    full = ends > starts
    n[full] += ~np.isin(_CLASS[raw[ends[full] - 1]], ending)

    drawn = _draws(batch.column(0).to_pylist(), p.seed)
    cuts = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
    places = []
    for k in (cuts[:, 0], cuts[:, 1]):
        place = np.where(k == 0, starts, ends)
        inner = (k > 0) & (k < n)
        place[inner] = ranks.behind(ending, before[inner] + k[inner])
        places.append(place)
    points = [ranks.count(_CODE_POINTS, place) for place in (starts, *places)]

    whole = raw.tobytes()
    marks = tuple(m.encode() for m in p.marks)
    forms, outputs = [], []
    for i, (a, b, c, d) in enumerate(
        zip(starts.tolist(), places[0].tolist(), places[1].tolist(), ends.tolist(), strict=True)
    ):
        text = whole[a:d]
        if not text or drawn[i, 2] % 100 >= p.transformed or any(m in text for m in marks):
            forms.append(PLAIN)
            outputs.append(text)
            continue
        prefix, middle, suffix = whole[a:b], whole[b:c], whole[c:d]
        if drawn[i, 3] % 100 < p.suffix_first:
            forms.append(SUFFIX_FIRST)
            parts = (marks[1], suffix, marks[0], prefix, marks[2], middle)
        else:
            forms.append(PREFIX_FIRST)
            parts = (marks[0], prefix, marks[1], suffix, marks[2], middle)
        outputs.append(b"".join(parts))
    plain = np.array([f == PLAIN for f in forms], dtype=bool)
    columns = [
        batch.column(0),
        pa.array(n),
        pa.array(forms, pa.string()),
        pa.array(points[1] - points[0], mask=plain),
        pa.array(points[2] - points[1], mask=plain),
        pa.array(outputs, pa.binary()).view(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCHEMA.split(", ")])


def _cut_all(batches: Iterator[pa.RecordBatch], p: FillParameters) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield _cut(batch, p)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   parameters: FillParameters = FillParameters()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``.

    ``n`` is the number of units.  Two draws from the id say behind how many units the
    prefix and the middle end; they may be equal, which leaves the middle empty.  Null
    and empty texts, texts that hold a mark and the share that is not to be cut come out
    ``plain`` and unchanged (null as empty), without lengths.  Rows of one id are cut by
    the same draws, each for itself; rows without id share theirs.  Texts of any length
    are cut as a whole; no rows give no rows; other columns are not read.
    """
    if parameters.unit not in UNITS:
        raise ValueError(f"no such unit: {parameters.unit}")
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return texts.mapInArrow(partial(_cut_all, p=parameters), _SCHEMA)


def restored(output: Column, form: Column, parameters: FillParameters = FillParameters()) -> Column:
    """The text an output was made from.  It holds no mark, so the marks divide the parts."""
    parts = F.split(output, "|".join("\\Q" + m + "\\E" for m in parameters.marks))
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(form == PREFIX_FIRST, F.concat(first, middle, second))
        .when(form == SUFFIX_FIRST, F.concat(second, middle, first))
        .otherwise(output)
    )
