"""Operators over documents, against brute force."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lethe.llm.components import connected_components
from lethe.llm.decontam import contained_items
from lethe.llm.encode import WordEncoder
from lethe.llm.hyperminhash import (
    NearParameters,
    estimated_jaccard,
    near_duplicates,
    registers,
)
from lethe.llm.licence_scan import TEMPLATES, find_licences
from lethe.llm.packing import PackingParameters, best_fit, pack, token_pieces
from lethe.llm.quality import quality_scores
from lethe.llm.records import (
    CorruptRecord,
    new_folder,
    read_records,
    record_positions,
    write_records,
)
from lethe.llm.token_counts import CountParameters, token_counts
from lethe.llm.words import mix
from lethe.session import shared_folder

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(sets):
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in sets}


def test_near_duplicates_equal_brute_force(documents):
    sets = {r.doc_id: shingles(r.text) for r in documents.collect()}
    want = components(sets)
    got = {r.doc_id: r for r in near_duplicates(documents).collect()}
    assert {k: r.component_id for k, r in got.items()} == want
    assert {k: r.n_shingles for k, r in got.items()} == {k: len(s) for k, s in sets.items()}
    assert all(r.kept == (k == r.component_id) for k, r in got.items())


def test_near_duplicates_of_short_texts_and_a_large_group(spark, no_broadcast):
    rng = np.random.default_rng(3)
    words = [f"v{i}" for i in range(40)]
    rows = []
    for i in range(250):  # texts a few words apart, around the threshold
        own = list(words)
        for k in rng.integers(0, 40, rng.integers(0, 3)):
            own[k] = f"x{i}"
        rows.append((i, " ".join(own)))
    for i in range(250, 420):  # short texts with a common line
        rows.append((i, " ".join(words[: rng.integers(3, 16)] + [f"y{i % 60}"] * rng.integers(0, 3))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert got == components({k: shingles(t) for k, t in rows})


@pytest.mark.parametrize("owners", [2])
def test_near_duplicates_with_edits_that_few_share(spark, owners):
    rng = np.random.default_rng(owners)
    words = [f"v{i}" for i in range(150)]
    rows = []
    for i in range(200):  # some link with nothing, though they share bands with all others
        own = list(words)
        place = np.random.default_rng(i // owners)
        for k in place.integers(0, 150, place.integers(0, 9)):
            own[k] = f"x{i // owners}"
        rows.append((i, " ".join(own + [f"z{i}"] * rng.integers(0, 2))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert got == components({k: shingles(t) for k, t in rows})
    # an id with two texts keeps the links of both
    twice = docs.unionByName(spark.createDataFrame([(0, " ".join(f"q{k}" for k in range(600)))], docs.schema))
    again = {r.doc_id: r.component_id for r in near_duplicates(twice).collect()}
    assert again == got


def test_near_duplicates_odd_rows(spark, odd):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in near_duplicates(odd).collect())
    by_id = {g[0]: g for g in got if g[0]}
    assert len(got) == 12
    assert by_id[1] == (1, 0, 1, True) and by_id[3] == (3, 0, 3, True)
    assert by_id[5] == (5, 1, 4, False) and by_id[7][2:] == (6, False)
    assert [g for g in got if g[0] == 8] == [(8, 4, 8, True)] * 2
    assert [g for g in got if not g[0]] == [(0, 0, 0, True), (0, 4, 0, True)]
    empty = near_duplicates(odd.where("false"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_estimates_are_corrected_for_collisions():
    p = NearParameters(mantissa_bits=1)
    rng = np.random.default_rng(1)
    a, b = (np.sort(mix(rng.integers(0, 1 << 62, 5000).astype(np.uint64))) for _ in range(2))
    sketches = [registers(x, p)[None] for x in (a, b)]
    size = np.array([5000])
    raw = (sketches[0] == sketches[1]).mean()
    found, used = estimated_jaccard(*sketches, size, size, p)
    assert used[0] == 128 and raw > 0.1 and found[0] < 0.5 * raw


def test_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 2000), (2000, 1500), (7, 7), (None, 3)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(5)
    got = {r.node: r.component for r in connected_components(frame).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1500: 1000, 2000: 1000}


def test_contained_items(spark, documents, odd):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    low = lambda t: shingles(t.lower() if t else t)
    held = {r.doc_id: low(r.text) for r in documents.collect()}
    wanted = {r.item_id: low(r.text) for r in items.collect()}
    want = {
        (d, i, len(w), len(h & w))
        for d, h in held.items()
        for i, w in wanted.items()
        if len(h & w) * 100 >= 75 * len(w)
    }
    got = contained_items(documents, items).collect()
    assert {(r.doc_id, r.item_id, r.item_shingles, r.matched) for r in got} == want and want
    plan = contained_items(documents, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    few = spark.createDataFrame(
        [(1, None), (2, ""), (3, "w7 w8 w9 w10 w11 w12 w13"), (3, "w7 w8 w9 w10 w11 w12 w13"), (None, "one two"), (4, "ONE two"), (5, "c d e f g q")],
        "item_id long, text string",
    )
    odd_hits = sorted((r.doc_id, r.item_id, r.containment) for r in contained_items(odd, few).collect())
    assert odd_hits == [(4, 4, 1.0), (5, 4, 1.0), (6, 3, 1.0), (7, 3, 1.0)]
    assert contained_items(odd, few.where("false")).count() == 0
    assert contained_items(odd.where("false"), few).count() == 0


def test_short_items_in_long_documents(spark, no_broadcast):
    rng = np.random.default_rng(3)
    docs = [(d, [f"w{x}" for x in rng.integers(0, 5000, int(rng.integers(40, 700)))]) for d in range(60)]
    items = []
    for i in range(240):
        words = docs[i % 60][1]
        size = 5 + i % 12
        at = int(rng.integers(0, len(words) - size))
        items.append((i, " ".join(words[at : at + size] + ["tail"] * (i % 2))))
    items += [(900, " ".join(docs[0][1][:40])), (901, " ".join(docs[1][1]))]  # and longer ones
    docs = [(d, " ".join(words)) for d, words in docs]
    held = {d: shingles(text) for d, text in docs}
    wanted = {i: shingles(text) for i, text in items}
    want = {(d, i, len(h & w)) for d, h in held.items() for i, w in wanted.items() if 4 * len(h & w) >= 3 * len(w)}
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = contained_items(*frames).collect()
    assert {(r.doc_id, r.item_id, r.matched) for r in got} == want and len(want) > 150
    assert {r.item_id for r in contained_items(frames[0], frames[1].where("item_id < 120")).collect()} == {i for _, i, _ in want if i < 120}


def test_words_are_encoded_as_by_the_tokenizer():
    words = WordEncoder(WORD)
    assert words.direct
    texts = ["don't Stop!'s", "<|endoftext|>x <|STARTOFTEXT|>", "É!! ß ÿ÷ naïve'll µ é İx ﬁ 日本", "it''s ..'re a\x1cb \x7f ½ a\xa0b", "", "  \n x1y22"]
    whole = Tokenizer.from_file(WORD).encode_batch(texts, add_special_tokens=False)
    got = words.encode_all([t.encode() for t in texts])
    assert [np.frombuffer(g, words.kind).tolist() for g in got] == [e.ids for e in whole]


@pytest.fixture(scope="module")
def encoded(documents):
    rows = documents.select("doc_id", "text").collect()
    found = Tokenizer.from_file(WORD).encode_batch([r.text or "" for r in rows], add_special_tokens=False)
    return {r.doc_id: np.array([*e.ids, 1], dtype="<u4") for r, e in zip(rows, found, strict=True)}


def test_packing_places_every_piece(documents, encoded, odd):
    rows = pack(token_pieces(documents, WORD), PackingParameters(pieces_per_partition=20)).collect()
    sequences: dict[int, list] = {}
    for r in rows:
        own = encoded[r.doc_id][r.start : r.start + r.length]
        assert r.start == 4096 * r.piece and zlib.crc32(own.tobytes()) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = sum(map(len, encoded.values()))
    assert sum(r.length for r in rows) == total
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= -(-total // 4096) + 2
    assert pack(token_pieces(odd, WORD)).select("length").where("length < 1").count() == 0
    assert pack(token_pieces(odd, WORD)).select("doc_id").where("doc_id is null").count() == 2
    assert pack(token_pieces(odd.where("false"), WORD)).count() == 0


def test_best_fit_takes_the_tightest_bin():
    where, offset, fill = best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert fill == [10, 10] and where.tolist() == [0, 1, 0, 1, 1] and offset.tolist() == [0, 0, 6, 5, 8]


def test_records_round_trip(spark, documents, encoded, odd):
    folder = new_folder(spark, shared_folder(spark))
    manifest = write_records(documents, folder, WORD)
    rows = record_positions(read_records(manifest, with_ids=True), manifest).orderBy("start").collect()
    at = 0
    for r in rows:
        assert r.start == at and r.ids == encoded[r.doc_id].tobytes() and zlib.crc32(r.ids) == r.ids_crc32
        at += r.n_tokens
    assert [r.doc_id for r in rows] == sorted(encoded)
    mixed = read_records(manifest, shuffle_seed=5)
    assert {(r.doc_id, r.ids_crc32) for r in mixed.collect()} == {(r.doc_id, r.ids_crc32) for r in rows}
    strange = write_records(odd, new_folder(spark, shared_folder(spark)), WORD)
    assert read_records(strange).where("doc_id is null").count() == 2 and read_records(strange).count() == 12
    none = write_records(odd.where("false"), new_folder(spark, shared_folder(spark)), WORD)
    assert record_positions(read_records(none), none).count() == 0


def test_damaged_records_are_noticed(spark, documents):
    manifest = write_records(documents, new_folder(spark, shared_folder(spark)), WORD)
    path = manifest.first().path.removeprefix("file:") + ".rec"
    with open(path, "r+b") as file:
        file.seek(200)
        byte = file.read(1)
        file.seek(200)
        file.write(bytes([byte[0] ^ 1]))
    with pytest.raises(Exception, match=CorruptRecord.__name__):
        read_records(manifest).collect()


def test_token_counts_equal_the_library(spark, documents, odd):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECE)
    extra = ["a  b", " a", "a \n b", "\n", " ", "  ", "<s>x</s>", "a\tb\n\n c ", "a▁b", "x ", "a\n ", "\n a"]
    more = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    frame = documents.select("doc_id", "text").unionByName(more).unionByName(odd.select("doc_id", "text"))
    want = sorted(
        (r.doc_id or -1, len((r.text or "").encode()), len(model.encode(r.text or ""))) for r in frame.collect()
    )
    for frequent in (5, 100_000):
        rows = token_counts(frame, PIECE, parameters=CountParameters(frequent=frequent)).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows) == want
        assert all(r.over_limit == (r.n_tokens > 4096) for r in rows)
    assert token_counts(odd.where("false"), PIECE).count() == 0


def test_quality_of_documents_without_a_label_in_training(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    shown = labels.where("doc_id % 3 != 0")
    held = quality_scores(docs, shown).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    right = sum(r.kept == (r.quality == 1) for r in held)
    assert right >= 0.97 * len(held)
    good = [r for r in held if r.quality == 1]
    assert sum(r.kept for r in good) >= 0.99 * len(good)


def test_quality_of_odd_rows(spark, odd, documents):
    labels = spark.createDataFrame([(4, 1), (None, 1), (5, None), (8, 0)], "doc_id long, quality int")
    rows = quality_scores(odd, labels.where("false")).collect()
    assert len(rows) == 12 and all(r.kept and r.score is None for r in rows)
    assert quality_scores(odd, labels).count() == 12
    assert quality_scores(odd.where("false"), labels).count() == 0
    known = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    both = documents.unionByName(odd.select(documents.columns))
    scores = quality_scores(both, known).collect()
    assert len(scores) == documents.count() + 12 and all(0 <= r.score <= 1 for r in scores)


def test_licences(spark, odd):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    variants = [(20_000 + i, "First line\n\n" + t.upper()) for i, (_, t) in enumerate(TEMPLATES)]
    frame = docs.unionByName(spark.createDataFrame(variants, "doc_id long, text string")).unionByName(
        odd.select("doc_id", "text")
    )
    found = find_licences(frame)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = found.where("confirmed").collect()
    families = {r.doc_id: r.family for r in rows if r.doc_id and r.doc_id >= 20_000 and r.paragraph == 2}
    right = sum(families.get(20_000 + i) == f for i, (f, _) in enumerate(TEMPLATES))
    assert right >= len(TEMPLATES) - 2
    lines = {(r.doc_id, k): line for r in docs.collect() for k, line in enumerate(r.text.split("\n"))}
    notices = {k for k, line in lines.items() if re.search("icense|rights reserved", line)}
    assert {(r.doc_id, r.paragraph) for r in rows if (r.doc_id, r.paragraph) in lines} == notices
    assert find_licences(odd.where("false")).count() == 0


def test_pack_keeps_columns_named_like_its_own(spark):
    rows = [(i, 100 * (i % 40) + 1, "f", i % 2 == 0, "s", 7, -1) for i in range(300)]
    plain = spark.createDataFrame(rows, "id long, length long, filled string, open boolean, slot string, offset int, sequence_id int")
    got = pack(plain).collect()
    assert set(got[0].asDict()) == set(plain.columns)
    assert sorted((r.id, r.length, r.filled, r.open, r.slot) for r in got) == [r[:5] for r in rows]
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
