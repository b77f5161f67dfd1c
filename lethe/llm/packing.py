"""Best-fit packing of token pieces into sequences of bounded length.

Hierarchical and by residuals: every partition packs its pieces best-fit, longest
first, and emits the bins that are nearly full.  Bins with room left become items
of the next round, in which eight partitions' bins are packed together, and so on
up a tree.  A partition hands at most ``carried`` bins up, those with most room; a
best-fit packing has at most one bin that is not half full, so what stays behind
is bins that would hardly take another.  No piece is dropped: a bin that is not
handed up is emitted as it is.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.llm.encode import encoder
from lethe.operators.sizing import durable, measured

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_BIN = ", sequence_id long, offset long, filled long, open boolean, slot long"


@dataclass(frozen=True)
class PackingParameters:
    capacity: int = 4096
    pieces_per_partition: int = 50_000
    fan_in: int = 8
    carried: int = 4096  # bins a partition hands up at most
    slack: int = 0  # room with which a bin still counts as full


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids and end id.

    Only documents longer than ``capacity`` are cut, every ``capacity`` ids.  A null or
    empty text has the end id alone.  Repeated rows and rows without id are
    documents of their own.
    """
    columns = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").cast("binary").alias("text"),
    )
    return columns.mapInArrow(
        partial(_pieces, path=tokenizer_path, capacity=capacity), PIECES
    )


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    words = encoder(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            some = batch.slice(at, 500)
            texts = some.column(1).fill_null(b"").to_pylist()
            rows, cuts = [], []
            for row, ids in enumerate(words.encode_all(texts)):
                numbers = words.with_end(ids)
                for piece, start in enumerate(range(0, len(numbers), capacity)):
                    own = numbers[start : start + capacity]
                    rows.append(row)
                    cuts.append((piece, start, len(own), zlib.crc32(own.tobytes())))
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0).take(pa.array(rows, pa.int64())),
                    *(
                        pa.array(values, kind)
                        for values, kind in zip(
                            zip(*cuts, strict=True),
                            (pa.int32(), pa.int64(), pa.int64(), pa.int64()),
                            strict=True,
                        )
                    ),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )


def pack(pieces: DataFrame, parameters: PackingParameters = PackingParameters()) -> DataFrame:
    """``pieces`` (any columns, among them ``length``) with sequence_id and offset.

    Lengths run from 1 to the capacity; every row is placed, in a sequence without
    gaps from offset 0 on.  Rows are told apart by position only, so repeated rows and
    nulls in other columns are placed like any.  No rows: no rows.  Other columns are
    kept whatever their names; own ones called sequence_id or offset give way.
    """
    p = parameters
    pieces = pieces.drop("sequence_id", "offset")
    kept = pieces.columns
    # by position, as a column may be named like one that is added on the way
    pieces = pieces.toDF(*(f"column{i}" for i in range(len(kept))))
    names = pieces.columns
    length = names[kept.index("length")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + _BIN
    known = measured(pieces)
    groups = max(1, -(-known.rows // p.pieces_per_partition))
    spread = F.pmod(F.xxhash64(*names), F.lit(groups)).cast("long")
    items = known.frame.select(
        "*",
        F.lit(None).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.col(length).cast("long").alias("filled"),
        F.lit(True).alias("open"),
        spread.alias("slot"),
    )
    done, level = [], 0
    while True:
        last = groups == 1
        packed = durable(
            items.repartition(groups, "slot").mapInArrow(
                partial(_packed, p=p, level=level, last=last, fan_in=p.fan_in), schema
            )
        )
        done.append(packed.where(~F.col("open")))
        if last:
            break
        items, groups, level = packed.where("open"), -(-groups // p.fan_in), level + 1
    result = done[0]
    for more in done[1:]:
        result = result.union(more)
    return result.select(*names, "sequence_id", "offset").toDF(*kept, "sequence_id", "offset")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin of each item, its offset there, fill of each bin); longest items first."""
    where = np.zeros(len(lengths), dtype=np.int64)
    offset = np.zeros(len(lengths), dtype=np.int64)
    fill: list[int] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms: list[int] = []  # ascending, those with bins
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        k = bisect_left(rooms, n)
        if k < len(rooms):
            room = rooms[k]
            own = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(k)
        else:
            room, own = capacity, len(fill)
            fill.append(0)
        where[i], offset[i] = own, fill[own]
        fill[own] += n
        room -= n
        if room:
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append(own)
    return where, offset, fill


def _packed(batches: Iterator[pa.RecordBatch], p: PackingParameters, level: int, last: bool,
            fan_in: int) -> Iterator[pa.RecordBatch]:
    table = [b for b in batches if b.num_rows]
    if not table:
        return
    rows = pa.Table.from_batches(table)
    first = level == 0
    order = [(c, "ascending") for c, f in zip(rows.column_names, rows.schema.types, strict=True)
             if not pa.types.is_nested(f)]
    if not first:
        order = [("sequence_id", "ascending"), ("offset", "ascending")]
    rows = rows.sort_by(order).combine_chunks()  # the same on every retry
    filled = rows.column("filled").to_numpy()
    slot = rows.column("slot").to_numpy()
    if first:
        item = np.arange(len(filled))
        lengths, slots = filled, slot
    else:
        own = rows.column("sequence_id").to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        item = np.cumsum(np.concatenate(([False], own[1:] != own[:-1])))
        lengths, slots = filled[starts], slot[starts]
    where, offset, fill = best_fit(lengths, p.capacity)
    fills = np.array(fill)
    opened = np.flatnonzero(p.capacity - fills > p.slack) if not last else np.zeros(0, dtype=int)
    if len(opened) > p.carried:
        opened = opened[np.argsort(fills[opened], kind="stable")[: p.carried]]
    is_open = np.zeros(len(fills), dtype=bool)
    is_open[opened] = True
    up = np.zeros(len(fills), dtype=np.int64)
    up[where] = slots // fan_in
    number = (level << 56) + (TaskContext.get().partitionId() << 32) + np.arange(len(fills))
    of = where[item]
    shifted = rows.column("offset").to_numpy() + offset[item]
    for name, values in (
        ("sequence_id", number[of]),
        ("offset", shifted),
        ("filled", fills[of]),
        ("open", is_open[of]),
        ("slot", up[of]),
    ):
        rows = rows.set_column(rows.column_names.index(name), name, pa.array(values))
    yield from rows.to_batches(max_chunksize=10_000)
