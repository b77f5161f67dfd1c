"""Only files that hold reached rows are written anew, whatever partitions they lie in."""

from __future__ import annotations

import datetime
import threading
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lethe.config import (
    DeletionConfig,
    DeletionRule,
    Group,
    KeyPath,
    MaskingConfig,
    MaskingRule,
)
from lethe.operators.masking import mask_apply, mask_steps
from lethe.operators.positions import parts_of_frame, reached_rows
from lethe.operators.purge import survivors
from lethe.operators.reach import Reacher
from lethe.plans import erasure
from lethe.plans import masking as mask_plan
from lethe.sources.snapshots import SnapshotStore, Transaction

PURGE = DeletionConfig([Group("G", "T", chunk_size=2)], [DeletionRule("G", "t", 1, KeyPath("id", "bigint"))])


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"))


def purge(spark, store, keys, config=PURGE, batch="B"):
    frame = spark.createDataFrame([("T", str(k)) for k in keys], "key_type string, key_no string")
    erasure.ingest(store, frame, batch)
    erasure.run_deletion_dry_run(store, config, batch)
    erasure.run_deletion(store, config, batch)


VALUES = {
    "boolean": [True, False, None],
    "int": [1, -7, None],
    "bigint": [1 << 40, 0, None],
    "double": [0.0, 0.5, 1e300, float("nan"), None],
    "float": [0.1, -2.5, None],
    "decimal(10,3)": [Decimal("1.500"), Decimal("-0.001"), None],
    "date": [datetime.date(1950, 2, 28), datetime.date(2024, 2, 29), None],
    "timestamp": [datetime.datetime(2020, 1, 1, 3, 4, 5, 123456), datetime.datetime(1999, 12, 31), None],
    "string": ["a b", "x/y=z%2F", "é:日本", "__x", "{}[]^#'\"\\", "tab\there", "007", None],
}


def test_every_partition_type_loses_the_doomed_rows_only(spark, store):
    names = {f"t{n}": kind for n, kind in enumerate(VALUES)}
    path = KeyPath("id", "bigint")
    config = DeletionConfig(
        [Group("G", "T", chunk_size=2)],
        [DeletionRule("G", name, n, path) for n, name in enumerate(names, start=1)],
    )
    with store.begin() as change:
        for name, kind in names.items():
            rows = [(3 * i + j, v) for i, v in enumerate(VALUES[kind]) for j in range(3)]
            frame = spark.createDataFrame(rows, f"id bigint, p {kind}").coalesce(1)
            change.overwrite(name, frame, ("p",))

    def content():
        # as text: not a number equals nothing
        return {n: sorted(repr(tuple(r)) for r in store.read(n).collect()) for n in names}

    before = content()
    doomed = [0, 3, 8, 9, 22]
    purge(spark, store, doomed, config)
    after = content()
    for name in names:
        assert after[name] == [r for r in before[name] if int(r[1:].split(",")[0]) not in doomed]
        assert len(after[name]) < len(before[name])
    audit = store.read(erasure.AUDIT).agg(F.sum("deleted_row_count")).first()[0]
    assert audit == sum(len(before[n]) - len(after[n]) for n in names)
    store.expire(keep_last=1)
    assert content() == after


def test_files_without_a_hit_are_neither_read_nor_written(spark, store, tmp_path):
    store.put("t", spark.range(800).withColumn("wide", F.lit("x")).repartitionByRange(8, "id"))
    (top,) = store.tables()["t"].dirs
    files = store.file_names(top)
    assert len(files) == 8
    purge(spark, store, [5, 6, 790])
    state = store.tables()["t"]
    assert len(state.dropped) == 2 and state.dirs[0] == top
    assert sum(len(store.file_names(d)) for d in state.dirs[1:]) <= 2
    assert sorted(r.id for r in store.read("t").collect()) == sorted(set(range(800)) - {5, 6, 790})
    rest = sum(r.count() for r in store.parts(state)[:1])
    assert rest == 797
    gone = store.expire(keep_last=1)["removed"]
    assert sum(name in path for path in gone for name in files) == 2
    assert store.file_names(top) < files and store.read("t").count() == 797
    purge(spark, store, range(100, 300), batch="C")  # whole files
    assert store.read("t").count() == 597


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rows_do_not_move_beyond_the_broadcast_bound(spark, tmp_path, no_broadcast):
    folder = str(tmp_path / "t")
    spark.range(400).selectExpr("id", "id % 7 AS k", "'wide' AS w").repartition(4).write.parquet(folder)
    table = spark.read.parquet(folder)
    keys = spark.createDataFrame([("2", 1), ("5", 2), ("99", 3)], "key_no string, chunk_no int")
    rule = DeletionRule("G", "t", 1, KeyPath("k", "bigint"))
    left = survivors([rule], Reacher(keys, {"t": table}))
    assert sorted(r.id for r in left.collect()) == [i for i in range(400) if i % 7 not in (2, 5)]
    wide = [line for line in plan_of(left).splitlines() if "Exchange" in line and "w#" in line]
    assert wide == []
    assert "SortMergeJoin" not in plan_of(left) and "ShuffledHashJoin" not in plan_of(left)

    masks = [
        MaskingRule("G", "t", "w", "concat(w, '-', id)", KeyPath("k", "bigint")),
        MaskingRule("G", "t", "k", "k + 100", KeyPath("k", "bigint"), 2),
        MaskingRule("G", "t", "w", "upper(w)", KeyPath("id", "bigint"), 3),
    ]
    masked = mask_apply(table, mask_steps(masks), Reacher(keys, {"t": table}))
    want = {}
    for i in range(400):
        hit = i % 7 in (2, 5)
        word = f"wide-{i}" if hit else "wide"
        want[i] = (i % 7 + 100 * hit, word.upper() if i in (2, 5, 99) else word)
    assert {r.id: (r.k, r.w) for r in masked.collect()} == want
    assert not [x for x in plan_of(masked).splitlines() if "Exchange" in x and "w#" in x]


def test_slices_cover_every_file_once(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.range(1_000).selectExpr("id", "id % 2 AS k").repartitionByRange(10, "id").write.parquet(folder)
    table = spark.read.parquet(folder)
    keys = spark.createDataFrame([("1", 1)], "key_no string, chunk_no int")
    spark.conf.set("lethe.broadcast.rows", "120")
    try:
        reached = reached_rows(parts_of_frame(table), [KeyPath("k", "bigint")], Reacher(keys, {}))
        parts = list(reached.without())
        assert len(parts) > 3 and sum(reached.files.values()) == 500
        assert sorted(r.id for part in parts for r in part.collect()) == list(range(0, 1_000, 2))
        folders = list(reached._folders)
        reached.release()
        assert folders and not reached._folders
    finally:
        spark.conf.unset("lethe.broadcast.rows")


@pytest.mark.parametrize(("step", "side_by_side"), [(2, True), (64, False)])
def test_slices_whose_words_fit_together_are_written_side_by_side(
    spark, store, monkeypatch, step, side_by_side
):
    """Reached rows that share words are few words; far apart each is one of its own."""
    store.put("t", spark.range(1_280).selectExpr("id", "0 AS k").repartitionByRange(4, "id"))
    running, most = [], []
    write = Transaction._write

    def watched(change, name, frame, partition_by):
        if name != "t":
            return write(change, name, frame, partition_by)
        running.append(threading.get_ident())
        most.append(len(running))
        time.sleep(1)
        try:
            return write(change, name, frame, partition_by)
        finally:
            running.remove(threading.get_ident())

    monkeypatch.setattr(Transaction, "_write", watched)
    doomed = range(0, 1_280, step)
    spark.conf.set("lethe.broadcast.rows", str(len(doomed) // 4 + 1))
    try:
        purge(spark, store, doomed)
    finally:
        spark.conf.unset("lethe.broadcast.rows")
    assert len(most) == 4 and (max(most) > 1) == side_by_side
    assert {r.id for r in store.read("t").collect()} == set(range(1_280)) - set(doomed)
    audit = store.read(erasure.AUDIT).collect()
    assert sum(r.deleted_row_count for r in audit) == len(doomed)


def test_an_adopted_partitioned_table_stays_partitioned(spark, store, tmp_path):
    source = str(tmp_path / "source dir")
    spark.range(60).selectExpr("id", "concat('p ', id % 3) AS p").repartition(2).write.partitionBy(
        "p"
    ).parquet(source)
    store.adopt("t", source)
    assert store.tables()["t"].partition_by == ["p"]
    purge(spark, store, [0, 3, 4])
    state = store.tables()["t"]
    assert state.partition_by == ["p"] and state.adopted == [source]
    assert state.dirs and all("/p=p " in d for d in state.dirs)
    assert {r.id for r in store.read("t").collect()} == set(range(60)) - {0, 3, 4}
    left = store.left_behind()
    assert left and len(left) == len(state.dropped)  # the owner's files with purged rows
    assert not any(r.older_copies_removed for r in erasure.certificate(store, "B").collect())
    for name in left:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        assert store._fs.delete(path, False)
    store.expire(keep_last=1)
    assert all(r.older_copies_removed for r in erasure.certificate(store, "B").collect())
    assert store.read("t").count() == 57
    purge(spark, store, range(60), batch="C")
    assert store.read("t").count() == 0 and store.tables()["t"].adopted == []


def test_masking_leaves_tables_without_hits_alone(spark, store):
    store.put("a", spark.range(40).selectExpr("id", "'n' AS name", "id % 2 = 0 AS p").repartition(4), ("p",))
    store.put("b", spark.range(100, 140).selectExpr("id", "'n' AS name"))
    path = KeyPath("id", "bigint")
    config = MaskingConfig(
        [Group("G", "T")],
        [MaskingRule("G", "a", "name", "concat(name, id)", path), MaskingRule("G", "b", "name", "NULL", path),
         MaskingRule("G", "a", "p", "NOT p", path, 2)],
    )
    before = store.tables()["b"]
    keys = spark.createDataFrame([("T", "1"), ("T", "7"), ("T", "8")], "key_type string, key_no string")
    mask_plan.ingest(store, keys, "B")
    mask_plan.run_masking_dry_run(store, config, "B")
    mask_plan.run_masking(store, config, "B")
    assert store.tables()["b"] == before
    got = {r.id: (r.name, r.p) for r in store.read("a").collect()}
    hit = (1, 7, 8)
    assert got == {i: (f"n{i}" if i in hit else "n", (i % 2 == 0) != (i in hit)) for i in range(40)}
    audit = store.read(mask_plan.AUDIT).collect()
    assert sum(r.masked_row_count for r in audit if r.target_table == "a") == 6
    assert sum(r.masked_row_count for r in audit if r.target_table == "b") == 0
