"""Token counts of whole texts without their token ids.

A text is cut into pre-tokens no piece of the vocabulary crosses: before every run
of spaces and before every line feed.  Per document, pre-tokens are counted; a
pre-token's pieces are counted once, whatever the number of its occurrences; the
two meet in a join and are summed per document.

Frequent pre-tokens would make hot join keys, so a bounded number of short ones, found
over all texts, is joined by broadcast where documents are cut.  The rest is numbered
in a dictionary per block of documents: a block's documents keep numbers, its dictionary
holds every text once, and only dictionaries are shuffled by text.  The pieces come back
to the block as an array by number.  Which side a pre-token is on never changes a count.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.operators.sizing import durable

_PART = re.compile("\n[^ \n]*| *[^ \n]+| +")
#: a document with its packed numbers, or (``first`` given) a packed stretch of a dictionary
_CUT = "block long, doc_id long, n_bytes long, known long, packed binary, first int"
_RARE = "block long, number int, pretoken string"
_PIECES = "block long, number int, pieces int"
_STRETCH = 5_000  # entries of a dictionary packed together
_COUNTS = "doc_id long, n_bytes long, n_tokens long"


@dataclass(frozen=True)
class CountParameters:
    frequent: int = 200_000  # pre-tokens joined by broadcast, at most
    tracked: int = 1_000_000  # counters of a task that looks for them
    longest: int = 64  # characters of a pre-token joined by broadcast
    dictionary_bytes: int = 8 << 20  # text of a block's dictionary; one document may exceed it
    numbers_bytes: int = 16 << 20  # numbers of a block's documents
    limit: int = 4096


@lru_cache(maxsize=2)
def piece_counter(path: str) -> PieceCounter:
    return PieceCounter(path)


class PieceCounter:
    """Pieces per pre-token for a model whose pieces keep to pre-tokens."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        crossing = [p for p in pieces if "▁" in p.lstrip("▁") or "\n" in p]
        plain = self.model.encode(" a", out_type=str) == ["▁", "▁a"]
        if crossing or not plain:
            raise ValueError(f"{path}: pieces cross white space or white space is normalised")

    def counts(self, pretokens: list[str]) -> list[int]:
        # the model puts a space before every text, which a part after a line feed has not
        encoded = self.model.encode(pretokens, num_threads=1)
        return [
            len(ids) - (1 if p[:1] == "\n" else 0) if p else 1
            for p, ids in zip(pretokens, encoded, strict=True)
        ]


def pretokens(text: str) -> list[str]:
    """Parts of a text, each without the first of the spaces before it.

    The empty part is a single space without anything behind it.
    """
    if not text:
        return []
    text = text.replace("▁", " ")
    spaced = text.replace("\n", " \n")
    if "  " not in spaced and spaced[0] not in " " and spaced[-1] != " ":
        return spaced.split(" ")
    return [part if part[0] == "\n" else part[1:] for part in _PART.findall(" " + text)]


def _frequent(batches: Iterator[pa.RecordBatch], p: CountParameters) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0):
            if text.is_valid:
                seen.update(part for part in pretokens(text.as_py()) if len(part) <= p.longest)
            if len(seen) > p.tracked:
                seen = Counter(dict(seen.most_common(p.tracked // 2)))
    top = seen.most_common(p.frequent // 2)
    for at in range(0, len(top), 10_000):
        words, times = zip(*top[at : at + 10_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(times, pa.int64())],
                                         ["pretoken", "times"])


def _packed(raw: bytes) -> bytes:
    """Numbers mostly count on, and words share letters, so little is left of either."""
    return zlib.compress(raw, 1)


def _rows(block: int, rows: list[tuple]) -> pa.RecordBatch:
    ids, sizes, sums, packed, first = zip(*rows, strict=True)
    columns = [
        pa.array([block] * len(rows), pa.int64()), pa.array(ids, pa.int64()),
        pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(packed, pa.binary()),
        pa.array(first, pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _CUT.split(", ")])


def _cut(batches: Iterator[pa.RecordBatch], known, p: CountParameters) -> Iterator[pa.RecordBatch]:
    """Documents with the numbers of their rare pre-tokens, and the dictionary of each block.

    A number stands as often as its pre-token occurs.
    """
    pieces: dict[str, int] = known.value
    block = TaskContext.get().partitionId() << 32
    numbered: dict[str, int] = {}
    text_bytes = number_bytes = 0

    def dictionary() -> Iterator[pa.RecordBatch]:
        parts = list(numbered)
        for at in range(0, len(parts), _STRETCH):
            text = json.dumps(parts[at : at + _STRETCH], ensure_ascii=False).encode()
            yield _rows(block, [(None, None, None, _packed(text), at)])

    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            some = batch.slice(at, 500)
            rows: list[tuple] = []
            for doc_id, text in zip(
                some.column(0).to_pylist(), some.column(1).fill_null("").to_pylist(), strict=True
            ):
                total = 0
                numbers = array("I")
                for part, n in Counter(pretokens(text)).items():
                    own = pieces.get(part)
                    if own is not None:
                        total += n * own
                        continue
                    number = numbered.get(part)
                    if number is None:
                        number = numbered[part] = len(numbered)
                        text_bytes += len(part)
                    numbers.extend([number] * n)
                size = len(text) if text.isascii() else len(text.encode())
                rows.append((doc_id, size, total, _packed(numbers.tobytes()), None))
                number_bytes += 4 * len(numbers)
                if text_bytes >= p.dictionary_bytes or number_bytes >= p.numbers_bytes:
                    yield _rows(block, rows)
                    yield from dictionary()
                    rows = []
                    numbered.clear()
                    text_bytes = number_bytes = 0
                    block += 1
            if rows:
                yield _rows(block, rows)
    yield from dictionary()


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The dictionaries' pre-tokens, one a row."""
    for batch in batches:
        for block, packed, first in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(),
            strict=True,
        ):
            parts = json.loads(zlib.decompress(packed))
            columns = [
                pa.array([block] * len(parts), pa.int64()),
                pa.array(range(first, first + len(parts)), pa.int32()), pa.array(parts, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["block", "number", "pretoken"])


def _counted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Pieces of pre-tokens in their order: those of equal ones in a row are counted once."""
    counter = piece_counter(path)
    last: tuple[str | None, int] = (None, 0)
    for batch in batches:
        if not batch.num_rows:
            continue
        encoded = batch.column(2).dictionary_encode()
        parts = encoded.dictionary.to_pylist()
        if parts[0] == last[0]:
            pieces = [last[1], *counter.counts(parts[1:])]
        else:
            pieces = counter.counts(parts)
        last = parts[-1], pieces[-1]
        own = pa.array(np.array(pieces, dtype=np.int32)).take(encoded.indices)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), own], ["block", "number", "pieces"]
        )


def _summed(documents: pa.Table, counted: pa.Table) -> pa.Table:
    """Token counts of one block's documents."""
    n = counted.num_rows
    pieces = np.zeros(n, dtype=np.int64)
    pieces[counted.column("number").to_numpy()] = counted.column("pieces").to_numpy()
    lists = [np.frombuffer(zlib.decompress(x), "<u4") for x in documents.column("packed").to_pylist()]
    upto = np.concatenate([[0], np.cumsum(pieces[np.concatenate(lists)])])
    upto = upto[np.concatenate([[0], np.cumsum([len(x) for x in lists])])]
    total = documents.column("known").to_numpy() + np.diff(upto)
    return pa.table(
        {
            "doc_id": documents.column("doc_id"),
            "n_bytes": documents.column("n_bytes"),
            "n_tokens": pa.array(total, pa.int64()),
        }
    )


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 parameters: CountParameters = CountParameters()) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    Null and empty texts have no tokens.  Repeated rows and rows without id are
    counted each for itself.  No rows: no rows.
    """
    p = parameters
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )

    @F.pandas_udf("long")
    def pieces_of(words: pd.Series) -> pd.Series:
        return pd.Series(piece_counter(model_path).counts(words.tolist()), dtype="int64")

    top = (
        texts.select("text")
        .mapInArrow(partial(_frequent, p=p), "pretoken string, times long")
        .groupBy("pretoken")
        .agg(F.sum("times").alias("times"))
        .orderBy(F.desc("times"), "pretoken")
        .limit(p.frequent)
    )
    known = {
        r[0]: r[1] for r in top.select("pretoken", pieces_of("pretoken").alias("pieces")).collect()
    }
    cut = durable(
        texts.mapInArrow(partial(_cut, known=spark.sparkContext.broadcast(known), p=p), _CUT)
    )
    dictionaries = cut.where("first is not null").select("block", "packed", "first")
    # equal pre-tokens of several blocks come together, one behind the other
    rare = dictionaries.mapInArrow(_entries, _RARE).repartition("pretoken")
    counted = rare.sortWithinPartitions("pretoken").mapInArrow(
        partial(_counted, path=model_path), _PIECES
    )
    documents = cut.where("first is null").select("block", "doc_id", "n_bytes", "known", "packed")
    # a block is bounded by the size of its dictionary and of its numbers
    counts = documents.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(_summed, _COUNTS)
    return counts.withColumn("over_limit", F.col("n_tokens") > p.limit)
