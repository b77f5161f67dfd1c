"""Fill-in-middle, source mixing and ranked search against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lethe.llm.fill_middle import (
    FEED,
    LEAD,
    SPACE,
    ClassRanks,
    FillParameters,
    _CLASS,
    fill_in_middle,
    restored,
)
from lethe.llm.lexical import SearchParameters, ranked_documents, terms_of
from lethe.llm.mixing import MixParameters, mix_sources, sources_with_targets

_UNIT = {"line": r"[^\n]*\n|[^\n]+", "sentence": r"[^\n.!?]*[\n.!?]|[^\n.!?]+",
         "word": r"[^\n \t\x0b\f\r]*[\n \t\x0b\f\r]|[^\n \t\x0b\f\r]+"}


# -- fill in middle ---------------------------------------------------------------


def test_ranks_and_places_equal_a_scan():
    raw = np.frombuffer(random.Random(5).randbytes(5_000), dtype=np.uint8)
    for block in (64, 1_000, 1 << 20):
        ranks = ClassRanks(raw, block)
        for symbols in ((FEED,), (FEED, SPACE), (LEAD,)):
            hit = np.isin(_CLASS[raw], symbols)
            at = np.arange(len(raw) + 1)
            assert (ranks.count(symbols, at) == np.concatenate([[0], np.cumsum(hit)])).all()
            nth = np.arange(1, hit.sum() + 1)
            assert (ranks.behind(symbols, nth) == np.flatnonzero(hit) + 1).all()
    assert ClassRanks(np.zeros(0, np.uint8)).count((FEED,), np.array([0])).tolist() == [0]


def expected_cut(doc_id, text, p):
    text = text or ""
    units = re.findall(_UNIT[p.unit], text)
    digest = hashlib.sha256(f"{p.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in p.marks) or h[2] % 100 >= p.transformed:
        return doc_id, len(units), "plain", None, None, text, text
    x, y, z = p.marks
    if h[3] % 100 < p.suffix_first:
        form, output = "spm", y + suffix + x + prefix + z + middle
    else:
        form, output = "psm", x + prefix + y + suffix + z + middle
    return doc_id, len(units), form, len(prefix), len(middle), output, text


@pytest.mark.parametrize(
    "p",
    [FillParameters(), FillParameters("word", 3, 60, 30), FillParameters("sentence", 1)],
)
def test_cuts_equal_a_plain_split(spark, documents, odd, p):
    marked = [(50 + i, t) for i, t in enumerate(
        ["a\n<P>\nb", "<\n<S\nx>", "日本\n語 é\r\n\n\n", "\n", "<", "S>\n<M\n>", "no feed", "\n\n\nx"])]
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    rows += [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()] + marked
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit("x"))
    cut = fill_in_middle(frame, parameters=p)
    got = cut.withColumn("back", restored(F.col("output"), F.col("form"), p)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        (expected_cut(i, t, p) for i, t in rows), key=repr
    )


def test_very_long_text_and_no_rows(spark):
    text = "".join(f"line {i} é\n" for i in range(300_000))
    frame = spark.createDataFrame([(9, text)], "doc_id long, text string")
    (row,) = fill_in_middle(frame).collect()
    assert tuple(row) == expected_cut(9, text, FillParameters())[:6]
    assert fill_in_middle(frame.where("doc_id < 0")).collect() == []
    with pytest.raises(ValueError):
        fill_in_middle(frame, parameters=FillParameters("page"))


# -- mixing ------------------------------------------------------------------------


def shares(sizes, p):
    """Targets by sharing the excess anew until none is above."""
    weights = {s: p.weights[i % len(p.weights)] for i, s in enumerate(sizes)}
    left, open_, out = sum(sizes.values()) * p.percent / 100, set(sizes), dict.fromkeys(sizes, 0.0)
    while open_ and left > 1e-9:
        whole = sum(weights[s] for s in open_)
        step, left = left, 0.0
        for s in sorted(open_, key=str):
            out[s] += step * weights[s] / whole
            if out[s] >= p.epochs * sizes[s]:
                left += out[s] - p.epochs * sizes[s]
                out[s] = float(p.epochs * sizes[s])
                open_.discard(s)
    return out


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 900, "c": 5, "d": 0, "é": 70, None: 40},
    {"a": 0, "b": 0}, {"a": 7}, {f"s{i:03}": i * i % 97 for i in range(60)},
])
def test_targets_share_the_excess_by_weight(spark, sizes):
    p = MixParameters()
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in sources_with_targets(frame, p).collect()}
    want = shares(sizes, p)
    assert got.keys() == want.keys()
    for source, target in want.items():
        assert got[source] == pytest.approx(target, rel=1e-9, abs=1e-6)


def mixed_by_hand(rows, p):
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = shares({s: sizes[s] for s in order}, p)
    taken = []
    for source in order:
        own = [r for r in rows if r["source"] == source]

        def key(r):
            name = "" if r["doc_id"] is None else r["doc_id"]
            u = (int(hashlib.md5(f"{p.seed}:{name}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return -math.log(u) / r["weight"], name == "", name, r["size"]

        epochs = min(int(targets[source] // sizes[source]), p.epochs) if sizes[source] else 0
        rest, before = targets[source] - epochs * sizes[source], 0
        for r in sorted(own, key=key):
            again = 2 * before + r["size"] <= 2 * rest
            taken.append((r["doc_id"], r["size"], r["size"] * (epochs + again)))
            before += r["size"]
    return sorted(taken, key=repr)


def test_mix_equals_a_plain_one_and_comes_near_its_targets(spark, documents, odd, no_broadcast):
    p = MixParameters()
    frame = documents.select("doc_id", "text", "source").unionByName(
        odd.where("doc_id is not null").select("doc_id", "text", "source")
    )
    frame = frame.withColumns({"size": F.lit("clash"), "of": F.lit(1), "_value": F.lit(2)})
    rows = [r.asDict() for r in mix_sources(frame).collect()]
    words = {}
    for r in frame.collect():
        words.setdefault(r.doc_id, set()).add(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))
    assert all(r["size"] in words[r["doc_id"]] for r in rows) and len(rows) == frame.count()
    assert sorted(((r["doc_id"], r["size"], r["taken"]) for r in rows), key=repr) == mixed_by_hand(rows, p)
    again = [r.asDict() for r in mix_sources(frame).collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        off = abs(sum(r["taken"] for r in own) - own[0]["target"])
        assert off <= max(r["size"] for r in own) / 2 + 1e-6
    assert all(r["taken"] <= 2 * r["size"] for r in rows)


def test_heavier_documents_are_drawn_more_often(spark):
    docs = spark.range(4_000).select(
        F.col("id").alias("doc_id"), F.lit("w w w").alias("text"), F.lit("a").alias("source")
    )
    weight = F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)
    half = MixParameters(percent=50)
    mixed = mix_sources(docs, size=F.lit(1), weight=weight, parameters=half)
    found = {r.even: r.n for r in mixed.groupBy((F.col("doc_id") % 2 == 0).alias("even"))
             .agg(F.sum("taken").alias("n")).collect()}
    assert found[True] + found[False] == 2_000
    # without replacement at half the mass: 1 - x**3 against 1 - x with x + x**3 = 1
    assert 1_300 < found[True] < 1_420


def test_mix_without_rows_and_without_ids(spark, odd):
    assert mix_sources(odd.where("false")).collect() == []
    got = mix_sources(odd.where("doc_id is null")).collect()
    assert sorted((r.size, r.taken) for r in got) == [(0, 0), (8, 16)]


# -- search ------------------------------------------------------------------------

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def best_by_hand(docs, items, best=10):
    found = [(i, Counter(_TERM.findall((t or "").translate(_LOWER)))) for i, t in docs]
    n_docs = sum(1 for _, c in found if c)
    length = sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    asked = {}
    for item_id, text in items:
        if item_id is not None:
            asked.setdefault(item_id, set()).update(_TERM.findall((text or "").translate(_LOWER)))
    out = []
    for item_id, terms in asked.items():
        scored = []
        for doc_id, c in found:
            if doc_id is None or not c:
                continue
            m = 10 + (90 * sum(c.values()) * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id))
        out += [(item_id, r, d, -s) for r, (s, d) in enumerate(sorted(scored)[:best], start=1)]
    return sorted(out)


def test_terms_are_the_maximal_runs():
    text = "Aé-B_c9 日本語's İSTANBUL\x00ẞ x y`z{|}~\x7f0"
    assert terms_of(text) == _TERM.findall(text.translate(_LOWER))
    assert terms_of(None) == terms_of("") == terms_of(" \n") == []


@pytest.mark.parametrize("bound", [16 << 20, 200])
def test_ranks_equal_brute_force(spark, documents, odd, bound):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").union(
        odd.select("doc_id", "text")).collect()]
    rows += [(1_000 + i, "tie one TWO two") for i in range(15)]
    asked = [tuple(r) for r in items.collect()] + [
        (900, "Two"), (900, "tie"), (901, None), (902, " - "), (None, "two"), (903, "nowhere-else-found"),
        (904, "一 日本 é w29999"), (905, "two " * 50_000),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rank", F.lit("x"))
    frame = spark.createDataFrame(asked, "item_id long, text string").withColumn("n", F.lit(1))
    p = SearchParameters(automaton_bytes=bound)
    got = ranked_documents(docs.repartition(3), frame, parameters=p).collect()
    assert sorted(map(tuple, got)) == best_by_hand(rows, asked)


def test_search_without_documents_or_items(spark, documents):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_documents(documents.where("false"), items).collect() == []
    assert ranked_documents(documents, items.where("false")).collect() == []
    assert ranked_documents(documents, items.withColumn("text", F.lit(" "))).collect() == []
