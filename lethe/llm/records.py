"""Length-delimited binary records of token ids, with an offset index.

Record: length (8 bytes), masked checksum of these, payload, masked checksum of the
payload; little-endian.  The payload is doc_id (8 bytes, signed), a flag byte (1: the
id is null) and the ids in the width the header record names.  The first record of a
shard is its header, a JSON object.  Beside ``shard-N.rec`` lies ``shard-N.idx``, the
8-byte offsets of the records in order, so that a reader can visit them in any
order.  A checksum is CRC-32, rotated right by 15 bits and added to a constant, so that
checksums of data that hold checksums stay meaningful.
"""

from __future__ import annotations

import json
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lethe.llm.encode import encoder
from lethe.operators.sizing import durable, shuffle_partitions

MANIFEST = "shard long, path string, first_id long, documents long, tokens long"
RECORDS = "shard long, position long, doc_id long, n_tokens long, ids_crc32 long, before long"
_MASK = 0xA282EAD8
_BUFFER = 4 << 20


class CorruptRecord(ValueError):
    """A frame whose length or payload does not match its checksum."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(head)) + payload + struct.pack("<I", masked(payload))


def unframed(source) -> bytes | None:
    """The payload of the frame at the position of ``source``; None at its end."""
    head = source.read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise CorruptRecord("damaged length")
    size = struct.unpack("<Q", head[:8])[0]
    body = source.read(size + 4)
    if len(body) < size + 4 or struct.unpack("<I", body[size:])[0] != masked(body[:size]):
        raise CorruptRecord("damaged payload")
    return body[:size]


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        fs.LocalFileSystem(), path)


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Write every text's ids and end id in ascending doc_id order; returns the manifest.

    ``folder`` has to be shared by all executors.  Rows without id come first; a null
    or empty text is the end id alone; equal ids are ordered by text.  A task writes its
    shard under a name of its own and the manifest names the files that count, so a
    repeated task leaves unnamed files at worst.  No documents: an empty manifest.
    """
    columns = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").cast("binary").alias("text"),
    )
    shards = shuffle_partitions(docs.sparkSession)
    ordered = columns.repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    write = partial(_write_shard, folder=folder, path=tokenizer_path)
    return durable(ordered.mapInArrow(write, MANIFEST))


def _write_shard(batches: Iterator[pa.RecordBatch], folder: str, path: str) -> Iterator[pa.RecordBatch]:
    words = encoder(path)
    shard = TaskContext.get().partitionId()
    store, root = _store(folder)
    out = index = None
    offsets: list[int] = []
    at = documents = tokens = 0
    first = None
    name = posixpath.join(root, f"shard-{shard:05d}-{uuid.uuid4().hex}")
    try:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                some = batch.slice(begin, 500)
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{name}.rec", buffer_size=_BUFFER)
                    index = store.open_output_stream(f"{name}.idx", buffer_size=_BUFFER)
                    head = frame(json.dumps({"ids": words.kind.str, "end": 1}).encode())
                    out.write(head)
                    at = len(head)
                    first = some.column(0)[0].as_py()
                texts = some.column(1).fill_null(b"").to_pylist()
                ids = some.column(0).to_pylist()
                end = np.array([1], dtype=words.kind).tobytes()
                for doc, body in zip(ids, words.encode_all(texts), strict=True):
                    payload = struct.pack("<qB", doc or 0, doc is None) + body + end
                    offsets.append(at)
                    at += out.write(frame(payload))
                    documents += 1
                    tokens += len(body) // words.kind.itemsize + 1
                index.write(np.array(offsets, dtype="<u8").tobytes())
                offsets = []
    finally:
        for file in (out, index):
            if file is not None:
                file.close()
    if out is not None:
        where = folder.rstrip("/") + "/" + posixpath.basename(name)
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "path": where, "first_id": first, "documents": documents, "tokens": tokens}],
            schema=pa.schema([("shard", pa.int64()), ("path", pa.string()), ("first_id", pa.int64()),
                              ("documents", pa.int64()), ("tokens", pa.int64())]),
        )


def read_records(manifest: DataFrame, shuffle_seed: int | None = None, with_ids: bool = False) -> DataFrame:
    """(shard, position, doc_id, n_tokens, ids_crc32, before[, ids]) of every record, checked.

    ``before`` counts the ids of the shard's earlier records.  With a seed, the records
    of a shard come in an order drawn from it, read by the offset index.  One task
    reads one shard at a time, record by record.
    """
    schema = RECORDS + (", ids binary" if with_ids else "")
    spread = manifest.repartition(shuffle_partitions(manifest.sparkSession), "shard")
    return spread.select("shard", "path").mapInArrow(
        partial(_read_shards, seed=shuffle_seed, with_ids=with_ids), schema
    )


def _read_shards(batches: Iterator[pa.RecordBatch], seed: int | None, with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows: list[tuple] = []
            size = 0
            for row in _shard_rows(path, seed):
                rows.append((shard, *(row if with_ids else row[:-1])))
                size += len(row[-1])
                if size > 8 << 20:
                    yield _record_batch(rows, with_ids)
                    rows, size = [], 0
            if rows:
                yield _record_batch(rows, with_ids)


def _record_batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = [part.split()[0] for part in RECORDS.split(", ")] + ["ids"] * with_ids
    kinds = [pa.int64()] * (len(names) - with_ids) + [pa.binary()] * with_ids
    columns = zip(zip(*rows, strict=True), kinds, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns], names)


def _shard_rows(path: str, seed: int | None) -> Iterator[tuple]:
    """(position, doc_id, n_tokens, ids_crc32, before, ids); shuffled, ``before`` is null."""
    store, local = _store(path)
    if seed is None:
        source = store.open_input_stream(f"{local}.rec", buffer_size=_BUFFER)
        order = None
    else:
        with store.open_input_stream(f"{local}.idx") as index:
            offsets = np.frombuffer(index.read(), dtype="<u8")
        source = store.open_input_file(f"{local}.rec")
        order = np.random.default_rng([seed, zlib.crc32(path.encode())]).permutation(len(offsets))
    with source:
        kind = np.dtype(json.loads(unframed(source))["ids"])
        before, position = 0, -1
        while True:
            if order is None:
                position += 1
            else:
                if not len(order):
                    return
                position, order = int(order[0]), order[1:]
                source.seek(int(offsets[position]))
            payload = unframed(source)
            if payload is None:
                return
            doc, missing = struct.unpack_from("<qB", payload)
            ids = np.frombuffer(payload, dtype=kind, offset=9).astype("<u4")
            raw = ids.tobytes()
            yield (position, None if missing else doc, len(ids), zlib.crc32(raw),
                   before if order is None else None, raw)
            before += len(ids)


def record_positions(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """Records with ``start``, the ids of all documents before them."""
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.select(  # one row per shard
        F.col("shard").alias("of"), F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base")
    )
    placed = records.join(shards, F.col("shard") == F.col("of"))
    return placed.withColumn("start", F.col("base") + F.col("before"))


def new_folder(spark: SparkSession, shared: str) -> str:
    return f"{shared.rstrip('/')}/records-{uuid.uuid4().hex}"
