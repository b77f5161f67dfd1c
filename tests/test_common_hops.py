"""Key paths of all groups resolved together: what they share is read once."""

from __future__ import annotations

import pytest

from lethe.config import Hop, KeyPath
from lethe.operators import reach
from lethe.operators.reach import Reacher, prepare_together
from lethe.operators.sizing import VALUE, sized

ORDER = Hop("order_id", "orders", "id")
PERSON = Hop("person", "people", "id")


@pytest.fixture(autouse=True)
def no_runtime_filter(spark):
    """Spark may read a small parent once more for a Bloom filter of its own."""
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")
    yield
    spark.conf.unset("spark.sql.optimizer.runtime.bloomFilter.enabled")


@pytest.fixture
def tables(spark, tmp_path):
    people = spark.range(20).selectExpr("id", "id % 5 AS nation", "concat('P', id) AS code")
    # one person has a third of all orders; some orders have nobody
    orders = spark.range(90).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 <> 1 THEN id % 20 END AS person", "id % 4 AS kind"
    )
    out = {}
    for name, frame in (("people", people), ("orders", orders)):
        frame.write.parquet(str(tmp_path / name))
        out[name] = spark.read.parquet(str(tmp_path / name))
    return out


def reacher(spark, tables, keys, as_of=None):
    rows = [(str(k), c) for k, c in keys]
    frame = spark.createDataFrame(rows, "key_no string, chunk_no int")
    return Reacher.over(sized(frame), tables, as_of)


def found(reacher, path):
    return {r[VALUE]: r.chunk_no for r in reacher.values(path).frame.collect()}


def scans(monkeypatch, columns):
    """Counts how often a parent is read; the columns name it."""
    seen = []
    for name in ("durable", "measured"):
        plain = getattr(reach, name)

        def spy(frame, plain=plain):
            plan = frame._jdf.queryExecution().optimizedPlan().toString()
            seen.append(any(f"{c}#" in plan for c in columns) and plan.count("Relation ["))
            return plain(frame)

        monkeypatch.setattr(reach, name, spy)
    return seen


def brute(tables, keys, by):
    people = [r.asDict() for r in tables["people"].collect()]
    orders = [r.asDict() for r in tables["orders"].collect()]
    chunk = dict(keys)
    if by == "nation":
        owner = {p["id"]: chunk.get(p["nation"]) for p in people}
    else:
        owner = chunk
    return {o["id"]: owner[o["person"]] for o in orders if owner.get(o["person"]) is not None}


NATION = [(1, 4), (2, 9)]
PEOPLE = [(7, 2), (8, 5), (19, 1), (400, 1)]


@pytest.mark.parametrize("mode", ["broadcast", "shuffle"])
def test_groups_share_a_hop(spark, tables, mode, request, monkeypatch):
    if mode == "shuffle":
        request.getfixturevalue("no_broadcast")
    seen = scans(monkeypatch, ["kind", "person"])
    nation, people = reacher(spark, tables, NATION), reacher(spark, tables, PEOPLE)
    far = KeyPath("nation", "bigint", (ORDER, PERSON))
    near = KeyPath("person", "bigint", (Hop("another_column", "orders", "id"),))
    middle = KeyPath("nation", "bigint", (PERSON,))
    prepare_together([(nation, far), (people, near), (nation, middle)])
    assert sum(seen) == 1  # one scan of orders for both groups, though one gets there later
    assert found(nation, far) == brute(tables, NATION, "nation")
    assert found(people, near) == brute(tables, PEOPLE, "person")
    assert set(found(nation, middle)) == {i for i in range(20) if i % 5 in (1, 2)}
    assert sum(seen) == 1


def test_ways_to_one_parent_by_different_columns(spark, tables, monkeypatch):
    seen = scans(monkeypatch, ["nation", "code"])
    numbers, texts = reacher(spark, tables, NATION), reacher(spark, tables, [("p3", 6), ("P6", 3), ("zz", 1)])
    by_nation = KeyPath("nation", "bigint", (PERSON,))
    by_code = KeyPath("code", None, (PERSON,), ignore_case=True)
    prepare_together([(numbers, by_nation), (texts, by_code)])
    assert sum(seen) == 1
    assert found(texts, by_code) == {3: 6, 6: 3}
    assert found(numbers, by_nation) == {i: {1: 4, 2: 9}[i % 5] for i in range(20) if i % 5 in (1, 2)}


def test_hops_that_wait_for_each_other_end(spark, tables):
    """A path through a table twice, and one the other way round."""
    a, b = reacher(spark, tables, PEOPLE), reacher(spark, tables, [(3, 1), (5, 2)])
    to_people = Hop("x", "people", "id")
    one = KeyPath("person", "bigint", (to_people, Hop("id", "orders", "person")))
    other = KeyPath("id", "bigint", (Hop("x", "orders", "person"), Hop("person", "people", "id")))
    twice = KeyPath("id", "bigint", (to_people, to_people.__class__("id", "people", "id")))
    prepare_together([(a, one), (b, other), (b, twice)])
    assert found(a, one) == {p: 5 if p == 8 else c for p, c in _orders_by_person(tables, PEOPLE).items()}
    assert set(found(b, other)) == {3, 5} & set(_persons(tables))
    assert found(b, twice) == {3: 1, 5: 2}


def _persons(tables):
    return [r.person for r in tables["orders"].collect() if r.person is not None]


def _orders_by_person(tables, keys):
    return {k: c for k, c in keys if k in _persons(tables)}


def test_conditions_keep_scans_apart(spark, tables):
    some, every = reacher(spark, tables, PEOPLE), reacher(spark, tables, PEOPLE)
    part = KeyPath("person", "bigint", (Hop("order_id", "orders", "id", where="kind = 2"),))
    whole = KeyPath("person", "bigint", (ORDER,))
    prepare_together([(some, part), (every, whole)])
    everything = brute(tables, PEOPLE, "person")
    assert found(every, whole) == everything
    assert found(some, part) == {i: c for i, c in everything.items() if i % 4 == 2}


def test_nothing_reached(spark, tables):
    a, b = reacher(spark, tables, [(999, 1)]), reacher(spark, tables, [])
    path = KeyPath("person", "bigint", (ORDER,))
    prepare_together([(a, path), (b, path)])
    assert found(a, path) == found(b, path) == {}
    assert a.values(path).rows == 0
