"""Ranked lexical search by scanning documents with an automaton of the items' terms.

There is no index of the documents.  The terms of all items become one Aho-Corasick
automaton, broadcast to the tasks; each pattern carries a space on both sides and texts
are brought to single-byte separators, so only whole terms match.  One scan gives every
document's length and the occurrences of each item term in it.  From the scan come the
collection's figures and with them the weights of the terms; a second pass over the
scan's numbers, not the texts, adds up the scores.  A term's output leads to the items
that ask for it, and a task keeps only the best documents of each item it has seen.

Items whose terms would exceed the bound of one automaton go to further automata, each
with a scan of its own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lethe.llm.words import byte_column
from lethe.operators.parallel import in_parallel
from lethe.operators.sizing import durable

_SCAN = "doc_id long, n long, terms array<int>, times array<int>"
_SCORED = "item_id long, doc_id long, score long"
_PAIRS = 4_000_000  # (document, item) contributions added up at once


@dataclass(frozen=True)
class SearchParameters:
    best: int = 10  # documents of an item
    length_share: int = 90  # of 100: how far a document's length counts
    saturation: int = 8
    unit: int = 1_000_000_000
    automaton_bytes: int = 16 << 20  # of the items' terms in one automaton


def _term_table() -> np.ndarray:
    """Bytes as they are scanned: separators as spaces, A-Z in lower case."""
    table = np.arange(256, dtype=np.uint8)
    kept = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
    table[[b for b in range(256) if b not in set(kept)]] = 0x20
    table[0x41:0x5B] += 0x20
    return table


_TABLE = _term_table()


def terms_of(text: str | None) -> list[str]:
    """Terms of one text in their order."""
    lowered = _TABLE[np.frombuffer((text or "").encode(), dtype=np.uint8)].tobytes().decode()
    return re.findall("[^ ]+", lowered)


@lru_cache(maxsize=4)
def automaton(terms: tuple[str, ...]):
    """Matches every term between two spaces; its value is its number."""
    import ahocorasick

    made = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        made.add_word(f" {term} ", number)
    if terms:
        made.make_automaton()
    return made


def _scan(batches: Iterator[pa.RecordBatch], terms) -> Iterator[pa.RecordBatch]:
    found = automaton(terms.value)
    for batch in batches:
        if not batch.num_rows:
            continue
        raw, offsets = byte_column(batch.column(1))
        base = int(offsets[0])
        edges = offsets - base
        lowered = _TABLE[raw[base : int(offsets[-1])]]
        inside = lowered != 0x20
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = edges[:-1][edges[:-1] < edges[1:]]
        first[begins] |= inside[begins]
        counted = np.concatenate([[0], np.cumsum(first, dtype=np.int64)])[edges]
        whole = lowered.tobytes()
        numbers, times, bounds = [], [], [0]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if a < b and len(found):
                text = f" {whole[a:b].decode(errors='replace')} "
                hits = Counter([number for _, number in found.iter(text)])
                numbers.extend(hits.keys())
                times.extend(hits.values())
            bounds.append(len(numbers))
        at = pa.array(bounds, pa.int32())
        columns = [
            batch.column(0),
            pa.array(np.diff(counted)),
            pa.ListArray.from_arrays(at, pa.array(numbers, pa.int32())),
            pa.ListArray.from_arrays(at, pa.array(times, pa.int32())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "times"])


def _holders(batches: Iterator[pa.RecordBatch], n_terms: int) -> Iterator[pa.RecordBatch]:
    """(term, documents of this task that hold it)."""
    held = np.zeros(n_terms, dtype=np.int64)
    for batch in batches:
        held += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
    some = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["term", "documents"])


class _Best:
    """The best documents of every item among those seen."""

    def __init__(self, names: np.ndarray, best: int):
        self.names = names
        self.scores = np.zeros((len(names), best), dtype=np.int64)  # descending; 0: a free place
        self.ids = np.zeros((len(names), best), dtype=np.int64)
        self.best = best

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        last, last_id = self.scores[item, -1], self.ids[item, -1]
        better = (score > last) | ((score == last) & (score > 0) & (doc < last_id))
        item, doc, score = item[better], doc[better], score[better]
        if not len(item):
            return
        touched = np.unique(item)
        item = np.concatenate([item, np.repeat(touched, self.best)])
        doc = np.concatenate([doc, self.ids[touched].ravel()])
        score = np.concatenate([score, self.scores[touched].ravel()])
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        place = np.arange(len(item)) - np.searchsorted(item, item, side="left")
        kept = place < self.best
        self.scores[item[kept], place[kept]] = score[kept]
        self.ids[item[kept], place[kept]] = doc[kept]

    def rows(self) -> pa.RecordBatch:
        item, place = np.nonzero(self.scores)
        columns = [self.names[item], self.ids[item, place], self.scores[item, place]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], ["item_id", "doc_id", "score"]
        )


def _score(batches: Iterator[pa.RecordBatch], figures, p: SearchParameters) -> Iterator[pa.RecordBatch]:
    weights, asked, bounds, names, factor = figures.value
    n_items = len(names)
    best = _Best(names, p.best)
    fan = np.diff(bounds)
    for batch in batches:
        batch = batch.filter(batch.column(0).is_valid())  # a row without id cannot be named
        lists = batch.column(2)
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        terms = lists.flatten().to_numpy()
        times = batch.column(3).flatten().to_numpy().astype(np.int64)
        ids = batch.column(0).to_numpy()
        doc = np.repeat(np.arange(len(ids)), lengths)
        m = 100 - p.length_share + factor(batch.column(1).to_numpy())
        part = weights[terms] * (p.unit * times // (1000 * times + p.saturation * m[doc]))
        # documents in runs whose contributions stay within the bound
        pairs = np.concatenate([[0], np.cumsum(np.bincount(doc, fan[terms], len(ids)))])
        row = 0
        while row < len(ids):
            end = max(row + 1, int(np.searchsorted(pairs, pairs[row] + _PAIRS, side="right")) - 1)
            low, high = np.searchsorted(doc, [row, end])
            if high > low:
                some, own = terms[low:high], fan[terms[low:high]]
                starts = np.repeat(bounds[some] - np.concatenate([[0], np.cumsum(own)[:-1]]), own)
                item = asked[starts + np.arange(own.sum())]
                cell = (np.repeat(doc[low:high], own) - row) * n_items + item
                total = np.zeros((end - row) * n_items, dtype=np.int64)
                np.add.at(total, cell, np.repeat(part[low:high], own))
                scored = np.flatnonzero(total)
                best.add(scored % n_items, ids[row + scored // n_items], total[scored])
            row = end
    yield best.rows()


@dataclass(frozen=True)
class _LengthFactor:
    """(share * n * N) div L, for the lengths of documents."""

    share: int
    documents: int
    length: int

    def __call__(self, n: np.ndarray) -> np.ndarray:
        return self.share * n.astype(np.int64) * self.documents // max(self.length, 1)


def _batches_of_items(items: DataFrame, item_col: str, text_col: str, p: SearchParameters):
    """Lists of (item id, its terms), each list's terms within the bound of an automaton.

    Items are read in the order of their ids, one partition at a time.
    """
    rows = (
        items.where(F.col(item_col).isNotNull())
        .select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("t"))
        .repartitionByRange("item_id")
        .sortWithinPartitions("item_id")
    )
    some: dict[int, set[str]] = {}
    size = 0
    for row in rows.toLocalIterator():
        own = set(terms_of(row["t"]))
        if size and size + sum(map(len, own)) > p.automaton_bytes and row["item_id"] not in some:
            yield some
            some, size = {}, 0
        some.setdefault(row["item_id"], set()).update(own)
        size += sum(map(len, own))
    if some:
        yield some


def ranked_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                     parameters: SearchParameters = SearchParameters()) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of every item, scores above 0.

    Equal scores go by ascending doc_id.  Null texts have no terms.  Rows of ``docs``
    are documents each for itself, also where an id repeats; those without id count in
    the collection's figures but are not ranked.  Rows of one item id are one item with
    the terms of all; items without id or terms have no rows.  No documents or no items
    give no rows; texts of any length are scanned whole; other columns are not read.
    """
    p = parameters
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    found = None
    for some in _batches_of_items(items, item_col, item_text_col, p):
        own = _scored(texts, some, p)
        found = own if found is None else found.unionByName(own)
    if found is None:
        found = docs.sparkSession.createDataFrame([], _SCORED)
    ranked = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= p.best)
        .select("item_id", "rank", "doc_id", "score")
    )


def _scored(texts: DataFrame, items: dict[int, set[str]], p: SearchParameters) -> DataFrame:
    """The best documents of each task for every item of one automaton."""
    spark = texts.sparkSession
    context = spark.sparkContext
    terms = tuple(sorted(set().union(*items.values())))
    number = {term: i for i, term in enumerate(terms)}
    scanned = durable(texts.mapInArrow(partial(_scan, terms=context.broadcast(terms)), _SCAN))

    def collection():
        lengths = scanned.select("n").where("n > 0")
        return lengths.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()

    def holders():
        held = scanned.select("terms").mapInArrow(
            partial(_holders, n_terms=len(terms)), "term long, documents long"
        )
        return held.groupBy("term").agg(F.sum("documents").alias("df"))

    (n_documents, length), held = in_parallel([collection, holders])
    ratio = F.lit(2.0 * n_documents + 2.0) / (F.col("df") * 2 + 1)
    # one row per term of this automaton, whose bytes are bounded
    weighed = held.select("term", F.floor(F.ln(ratio) * 1000).cast("long").alias("w")).collect()
    weights = np.zeros(len(terms), dtype=np.int64)
    for row in weighed:
        weights[row["term"]] = row["w"]

    ids = sorted(items)
    pairs = sorted((number[t], at) for at, i in enumerate(ids) for t in items[i])
    of_term = np.array([t for t, _ in pairs], dtype=np.int64)
    asked = np.array([at for _, at in pairs], dtype=np.int64)
    bounds = np.searchsorted(of_term, np.arange(len(terms) + 1))
    factor = _LengthFactor(p.length_share, n_documents, length)
    names = np.array(ids, dtype=np.int64)
    figures = context.broadcast((weights, asked, bounds, names, factor))
    return scanned.mapInArrow(partial(_score, figures=figures, p=p), _SCORED)
