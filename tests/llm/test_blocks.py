"""Near duplicates of buckets that are compared in several blocks, against brute force."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from lethe.llm.hyperminhash import NearParameters, _joined_components, common_shingles, near_duplicates


def sets_of(rows):
    out = {}
    for key, text in rows:
        words = text.split()
        out[key] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return out


def smallest_reachable(sets):
    least = {k: k for k in sets}
    links = [(a, b) for a, b in combinations(sets, 2) if 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def templates(seed, n=220):
    """96 words, 60 of them common to all, three of 40 shared edits each."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = [f"c{k}" for k in range(60)] + [f"t{k}" for k in range(36)]
        for k in rng.choice(40, 3, replace=False):
            words[60 + k * 36 // 40] = f"e{k}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("block", [600, 5000, 1 << 18])
def test_blocks_of_a_template_equal_brute_force(spark, block):
    rows = templates(block)
    rows += [(1000 + i, t + f" z{i} z z") for i, t in rows[:60]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs, parameters=NearParameters(block=block, each=1)).collect()}
    assert got == smallest_reachable(sets_of(rows))


def test_common_shingles_of_sets():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 4000, rng.integers(1, 900))).astype(np.uint64) for _ in range(70)]
    some = np.array([0, 7, 69])
    got = common_shingles(sets, some)
    want = [[len(np.intersect1d(sets[i], other)) for other in sets] for i in some]
    off = ~np.eye(70, dtype=bool)[some]
    assert (got[off] == np.array(want)[off]).all()


def test_a_task_may_span_batches():
    base = np.arange(100, dtype=np.uint64)
    rows = [(1, 10 + i, False, (base + i).tobytes()) for i in range(5)] + [(2, 50, False, base.tobytes())]
    rows += [(3, 60, True, base.tobytes()), (3, 61, True, base.tobytes())]  # the largest component alone
    names = ["task", "component", "main", "shingles"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True))]) for r in rows]
    found = [(r["a"], r["b"]) for out in _joined_components(iter(batches), NearParameters()) for r in out.to_pylist()]
    ends = {x for pair in found for x in pair}
    assert ends == {10, 11, 12, 13, 14} and len(found) == 4
