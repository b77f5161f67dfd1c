"""Pages, vectors, conversations and the pipeline, against brute force."""

from __future__ import annotations

import itertools
import math
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lethe.llm import quality
from lethe.llm.chat import RepairCosts, repair_conversations, repaired_roles
from lethe.llm.html_extract import extract_main_text, main_text
from lethe.llm.vectors import PassParameters, near_vectors

SF = "/root/testdata/sf0.001"


def test_main_text_without_the_rest():
    page = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><!-- <p>no</p> -->
    <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use</div>
    <div class="row"><div class="post-content col8"><h1>A &amp; B</h1><p>One&nbsp;two
    <b>three<p>Four<br>five <a href="x">six</a><script>if (a<b) "</p>"</script><form><input>Send</form>
    <div class="ad">Buy</div><ul><li>x<li>y</ul><div id="comments"><p>Reader says</p></div></div>
    <aside>Other</aside></div><footer>&copy;</footer>"""
    assert main_text(page, None) == "A & B\nOne two three\nFour five six\nx\ny"
    assert main_text("", None) == "" and main_text("<p", None) == ""
    assert main_text("plain words", None) == "plain words"


def test_hosts_agree_on_a_path(spark):
    body = "<p>" + "word " * 60 + "</p>"
    side = "<div class='box'><p>" + "other " * 80 + "</p></div>"
    pages = [(i, "https://H.example/x", f"<body><div class='story s{i}'>{body}</div><div class='box'><p>b</p></div></body>") for i in range(9)]
    pages.append((9, "https://h.example:80/y", f"<body><div class='story s9'><p>short one</p></div>{side}</body>"))
    pages += [(10, None, "<p>lone</p>"), (11, "", None), (None, "nohost", ""), (12, "https://h.example/z", "<body><main>else</main></body>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("path", F.lit(1))
    got = {r.page_id: r for r in extract_main_text(frame).collect()}
    assert got[9].text == "short one" and got[9].path == "/body/div.s.story"
    assert got[0].text == ("word " * 60).strip() and got[0].n_chars == len(got[0].text)
    assert got[10].text == "lone" and got[11].text == "" and got[None].text == "" and got[12].text == "else"
    assert len(got) == 14 and extract_main_text(frame.where("false")).count() == 0


def test_pages_give_their_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in extract_main_text(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inner = r.html.split("<article>")[1].split("</article>")[0]
        assert r.text == main_text(f"<article>{inner}</article>", None)
        assert r.html.split('class="ad">')[1].split("<")[0] not in r.text


def neighbours(vectors):
    ids = list(vectors)
    linked = {i: set() for i in ids}
    for a, b in itertools.combinations(ids, 2):
        x, y = (np.array(vectors[i], dtype=float) for i in (a, b))
        if len(x) == len(y) and x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= 0.95:
            linked[a].add(b)
            linked[b].add(a)
    return linked


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = {}
    for centre in range(6):
        c = rng.standard_normal(24)
        for k in range(30):  # around the threshold
            rows[100 * centre + k] = (c + rng.standard_normal(24) * 0.05 * (1 + k % 6)).astype(np.float32).tolist()
    rows |= {900 + k: [1.0] * 24 for k in range(40)} | {950: [2.0] * 24, 960: [1.0, 1.0], 961: [3.0, 3.0]}
    odd = [(970, None), (971, [0.0] * 24), (972, [1.0, None] * 12), (973, [float("nan")] * 24), (974, [float("inf")] * 24), (975, []), (None, [1.0] * 24)]
    frame = spark.createDataFrame([*rows.items(), *odd], "vec_id long, embedding array<float>")
    for name in ("label", "unit", "component", "rep"):
        frame = frame.withColumn(name, F.lit(1))
    linked = neighbours(rows)
    out = near_vectors(frame, parameters=PassParameters(block=16))
    got = {r.vec_id: r for r in out.collect()}
    assert len(got) == len(rows) + len(odd)
    for i, own in linked.items():
        seen, todo = {i}, [i]
        while todo:
            fresh = linked[todo.pop()] - seen
            seen |= fresh
            todo += fresh
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(own), min(seen), i == min(seen))
    assert all((got[i].n_links, got[i].component_id) == (0, i) for i, _ in odd)
    assert near_vectors(frame.where("false")).count() == 0


@pytest.mark.parametrize("direct", [32_768, 500])
def test_links_in_a_dense_direction(spark, direct):
    rng = np.random.default_rng(11)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    side = lambda n, c: unit(rng.standard_normal((n, 64)) @ (np.eye(64) - np.outer(c, c)))
    c = unit(rng.standard_normal(64))
    cone = math.sqrt(0.9) * c + math.sqrt(0.1) * side(6000, c)  # cosine of about 0.9 to each other
    for k in range(100):  # planted pairs: a cone vector turned to cosine 0.952
        x = cone[k]
        cone[5999 - k] = 0.952 * x + math.sqrt(1 - 0.952**2) * side(1, x)[0]
    rows = np.concatenate((cone, unit(rng.standard_normal((4000, 64)))))
    links = rows @ rows.T >= 0.95
    own = np.arange(len(rows))
    while (new := np.where(links, own[None, :], len(rows)).min(axis=1)).tolist() != own.tolist():
        own = new
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    got = near_vectors(frame, parameters=PassParameters(direct=direct, direct_block=1000)).collect()
    wrong = [r.vec_id for r in got if (r.n_links, r.component_id) != (links[r.vec_id].sum() - 1, own[r.vec_id])]
    assert len(got) == len(rows) and not wrong, len(wrong)


def cheapest(roles, c=RepairCosts()):
    """All ways, by exhaustive search."""
    legal = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}

    def search(i, state, inserted):
        if i == len(roles):
            best = 0 if state == "assistant" else math.inf
        else:
            best = math.inf
            for to in ("system", "user", "assistant"):
                change = 0 if to == roles[i] else c.relabel if roles[i] in legal and roles[i] else c.name
                if to in legal[state]:
                    best = min(best, change + search(i + 1, to, 0))
                if to == state:
                    best = min(best, change + c.merge + search(i + 1, to, 0))
        if inserted < 3:
            best = min(best, *(c.insert + search(i, to, inserted + 1) for to in legal[state]))
        return best

    return search(0, "", 0)


def test_repairs_cost_least():
    for n in range(1, 5):
        for roles in itertools.product(("system", "user", "assistant", "tool"), repeat=n):
            cost, turns = repaired_roles(list(roles))
            assert abs(cost - cheapest(list(roles))) < 1e-9, roles
            kept = [r for r, action in turns if not action.startswith("merge")]
            assert kept[-1] == "assistant" and "system" not in kept[1:]
            assert all(a != b for a, b in itertools.pairwise(kept))


def test_conversations_over_many_partitions(spark):
    rng = np.random.default_rng(2)
    names = ["system", "User", "assistant", "human", None, "tool"]
    rows = [(7, i, names[rng.integers(0, 6)], f"t{i}") for i in range(700)]  # spans partitions
    rows += [(c, i, names[rng.integers(0, 6)], f"t{c}.{i}") for c in range(20, 60) for i in range(rng.integers(1, 6))]
    rows += [(None, None, "user", None), (70, 1, "user", "same"), (70, 1, "user", "same"), (71, None, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = defaultdict(list)
    for r in repair_conversations(frame.withColumn("seq", F.lit(0)).withColumn("cells", F.lit(0))).collect():
        got[r.conv_id].append(r)
    source = defaultdict(list)
    for r in frame.orderBy("conv_id", "turn", "role", "text").collect():
        source[r.conv_id].append(r)
    assert got.keys() == source.keys()
    for key, turns in source.items():
        cost, want = repaired_roles([r.role for r in turns])
        own = sorted(got[key], key=lambda r: (r.seq, r.turn or 0, r.action.startswith("merge")))
        if key != 7:
            assert [(r.role, r.action) for r in own] == want
        kept = [r for r in own if not r.action.startswith("merge")]  # ties may be broken otherwise
        assert len(kept) == sum(not a.startswith("merge") for _, a in want) == own[-1].seq + 1
        assert all(a.role != b.role for a, b in itertools.pairwise(kept))
        roles = iter(r.role for r in turns)
        spent = 0.0
        for r in own:
            role = None if r.action == "insert" else next(roles)
            spent += 2.5 * (r.action == "insert") + 1.0 * r.action.startswith("merge")
            spent += 0 if "relabel" not in r.action else 0.5 if role in (None, "tool") else 2.0
        assert abs(spent - cost) < 1e-6
        text = "".join(r.rendered for r in own)
        assert text.count("<|end|>") == own[-1].seq + 1 and text.endswith("<|end|>\n")
        assert all((r.text or "") in text for r in turns)
    assert repair_conversations(frame.where("false")).count() == 0


def test_pipeline_stages(spark, documents, odd):
    known = spark.read.parquet(f"{SF}/labels.parquet")
    docs = documents.unionByName(odd.select(documents.columns))
    outputs = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).checkpoint()
        outputs.append(docs)
    good = {r.doc_id for r in known.where("quality = 1").collect()}
    kept = {r.doc_id for r in outputs[0].collect()}
    assert len(good - kept) <= 0.02 * len(good) and outputs[0].columns == documents.columns
    assert {r.doc_id for r in known.where("quality = 0").collect()} & kept == set()
    assert outputs[1].count() < outputs[0].count() and outputs[2].count() < outputs[1].count()
    assert {r.doc_id for r in outputs[3].collect()} == {r.doc_id for r in outputs[2].collect()}
    assert outputs[1].where("doc_id is null").count() == outputs[0].where("doc_id is null").count()
    empty = documents.where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_stages_keep_columns_named_like_those_of_a_join(spark, tmp_path, broadcast):
    rows = [(1, "a", 5), (1, "b", 6), (2, "c", 7), (None, "d", 8), (3, "e", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, _value string, _match int")
    docs = docs.withColumns({"_spread": F.lit("x"), "_copy": F.lit("y"), "column0": F.lit("z")})
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    rejected = spark.createDataFrame([(1,), (9,)], "doc_id long")
    if not broadcast:
        spark.conf.set("lethe.broadcast.rows", "0")
    try:
        left = corpus_pipeline._without(docs, rejected)
        assert left.columns == docs.columns
        got = {(r.doc_id, r._value, r._match, r._copy, r.column0) for r in left.collect()}
    finally:
        spark.conf.unset("lethe.broadcast.rows")
    assert got == {(2, "c", 7, "y", "z"), (None, "d", 8, "y", "z"), (3, "e", 9, "y", "z")}


def test_the_fit_holds_the_wide_features_of_few_rows_at_once():
    rng = np.random.default_rng(3)
    rows = np.column_stack([rng.integers(0, 256, 20_000), rng.integers(0, 32, 20_000), rng.random(20_000)])
    y = (rows[:, 0] % 2 == 0).astype(float)
    tracemalloc.start()
    model = quality.fit_logistic(rows, y, 1.0, quality._meta_view)
    logits = quality.logits_of(model, rows, quality._meta_view)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 << 20  # the features of all rows are 44 MB
    assert ((logits > 0) == (y > 0.5)).all()
    whole = quality.fit_logistic(quality._meta_view(rows), y, 1.0)
    assert np.allclose(model.weights, whole.weights) and np.isclose(model.bias, whole.bias)
