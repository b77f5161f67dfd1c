"""Keys that come later, groups that fail, relations in a circle, copies that are left."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lethe.config import (
    DeletionConfig,
    DeletionRule,
    Group,
    KeyPath,
    MaskingConfig,
    MaskingRule,
    Relation,
)
from lethe.functions import masks
from lethe.operators import checks, reports
from lethe.operators.reach import Reacher
from lethe.operators.tally import tallied_audit, tallied_estimates
from lethe.plans import erasure
from lethe.plans import masking as mask_plan
from lethe.sources.snapshots import SnapshotStore

BY_ID = KeyPath("id", "bigint")


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"))


def keys(spark, *names, kind="T"):
    return spark.createDataFrame([(kind, str(n)) for n in names], "key_type string, key_no string")


def test_later_runs_of_a_batch_add_up(spark, store):
    config = DeletionConfig([Group("G", "T", chunk_size=1)], [DeletionRule("G", "t", 1, BY_ID)])
    store.put("t", spark.range(20))
    erasure.ingest(store, keys(spark, 1, 2), "B")
    erasure.run_deletion_dry_run(store, config, "B")
    erasure.run_deletion(store, config, "B")
    erasure.ingest(store, keys(spark, 3), "B")
    erasure.run_deletion_dry_run(store, config, "B")
    erasure.run_deletion_dry_run(store, config, "B")  # again: nothing counts twice
    assert erasure.take_requests(store, config, keys(spark, 3, 4, 5, 99), "B") == 3
    assert erasure.take_requests(store, config, keys(spark, 3, 4, 5, 99), "B") == 0
    erasure.run_deletion(store, config, "B")
    audit = store.read(erasure.AUDIT)
    assert sorted(r.chunk_no for r in audit.collect()) == [1, 2, 3, 4, 5]
    (row,) = reports.reconcile(store.read(erasure.SUMMARY), audit).collect()
    assert (row.dry_run_estimated, row.actual_deleted) == (5, 5)
    assert store.read("t").count() == 15


def test_further_requests_leave_earlier_tasks_alone(spark, store):
    config = DeletionConfig(
        [Group("G", "T"), Group("H", "U")],
        [DeletionRule("G", "t", 1, BY_ID), DeletionRule("H", "t", 1, BY_ID)],
    )
    store.put("t", spark.range(20))
    erasure.take_requests(store, config, keys(spark, 1, 77), "B")
    before = store.tables()[erasure.TASKS]
    store.put("t", spark.range(100))  # 77 is there now, but nobody looks again
    erasure.take_requests(store, config, keys(spark, 2).union(keys(spark, 3, kind="U")), "B")
    after = store.tables()[erasure.TASKS]
    assert set(before.dirs) < set(after.dirs) and not after.dropped
    status = {(r.group_code, r.key_no): r.status for r in store.read(erasure.TASKS).collect()}
    assert status == {("G", "1"): "VALIDATED", ("G", "77"): "NOT_FOUND", ("G", "2"): "VALIDATED",
                      ("H", "3"): "VALIDATED"}
    estimates = {r.group_code: r.estimated_rows_to_delete for r in store.read(erasure.SUMMARY).collect()}
    assert estimates == {"G": 2, "H": 1}


def test_a_failing_group_is_recorded_and_the_others_run(spark, store):
    config = DeletionConfig(
        [Group("A", "T"), Group("B", "T")],
        [DeletionRule("A", "t", 1, KeyPath("id", "bigint", where="1 / (id - 3) > 0")),
         DeletionRule("A", "u", 2, BY_ID), DeletionRule("B", "u", 1, BY_ID)],
    )
    store.put("t", spark.range(3))
    store.put("u", spark.range(10))
    erasure.ingest(store, keys(spark, 1, 3), "X")
    erasure.run_deletion_dry_run(store, config, "X")
    store.put("t", spark.range(10))  # now a row on which the condition fails
    assert erasure.run_deletion(store, config, "X") == 1
    assert store.read("t").count() == 10 and store.read("u").count() == 8
    failed = reports.failed_tasks(store.read(erasure.TASKS)).collect()
    assert {(r.group_code, r.key_no) for r in failed} == {("A", "1"), ("A", "3")}
    assert all("DIVIDE_BY_ZERO" in r.error_message for r in failed)
    store.put("t", spark.range(3))
    erasure.reopen_failed(store, "X")
    assert erasure.run_deletion(store, config, "X") == 1
    assert {r.status for r in store.read(erasure.TASKS).collect()} == {"COMPLETED"}


def test_masking_survives_malformed_json_and_is_certified(spark, store):
    texts = ['{"a": 1, "b": "x"}', "not json", "[1]", None, "{}"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id bigint, j string")
    merged = frame.select(masks.mask_json_merge("j", {"a": '"***"'}).alias("m")).collect()
    only = {"a": "***"}
    assert [r.m and json.loads(r.m) for r in merged] == [{**only, "b": "x"}, only, only, None, only]
    store.put("t", frame)
    config = MaskingConfig(
        [Group("G", "T"), Group("H", "T")],
        [MaskingRule("G", "t", "j", "to_json(parse_json(j))", BY_ID), MaskingRule("H", "t", "j", "'x'", BY_ID)],
    )
    mask_plan.ingest(store, keys(spark, 0, 1), "B")
    with pytest.warns(UserWarning, match="no preview"):
        mask_plan.run_masking_dry_run(store, config, "B")
    assert mask_plan.run_masking(store, config, "B") == 1  # G fails on a value, H runs
    status = {r.group_code: r.status for r in store.read(mask_plan.TASKS).collect()}
    assert status == {"G": "FAILED", "H": "COMPLETED"}
    assert not any(r.older_copies_removed for r in mask_plan.certificate(store, "B").collect())
    store.expire(keep_last=1)
    shown = mask_plan.certificate(store, "B").collect()
    assert shown and all(r.older_copies_removed for r in shown)


def test_cascades_follow_circles(spark):
    tables = {
        "staff": spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, 5), (6, None)], "id bigint, boss bigint"),
        "note": spark.createDataFrame([(1, 4), (2, 4), (3, 5), (4, None)], "id bigint, who bigint"),
        "firm": spark.createDataFrame([(7, 1)], "id bigint, head bigint"),
    }
    config = DeletionConfig([Group("G", "T")], [DeletionRule("G", "firm", 1, BY_ID)])
    relations = [
        Relation("staff", "id", "firm", "head"), Relation("staff", "boss", "staff", "id"),
        Relation("note", "who", "staff", "id"),
    ]
    asked = spark.createDataFrame([("7", 1)], "key_no string, chunk_no int")
    found = checks.cascade_scope(config, "G", relations, Reacher(asked, tables)).collect()
    # 1 goes with the firm, 2 with 1, 3 with 2, 4 with 3, and the notes of 4
    assert {(r.parent_table, r.child_table): r.rows_outside_rules for r in found} == {
        ("firm", "staff"): 1, ("staff", "staff"): 3, ("staff", "note"): 2
    }


def test_fingerprints_find_planted_changes(spark):
    before = spark.range(5_000).selectExpr("id", "string(id % 7) AS v")
    dup = before.union(before.where("id = 17"))
    assert reports.differing_buckets(before, before.orderBy(F.desc("id"))) == []
    changed = before.withColumn("v", F.when(F.col("id") == 99, "x").otherwise(F.col("v")))
    assert [r.id for r in reports.untouched(before, changed).collect()] == [99]
    assert len(reports.differing_buckets(before, changed)) in (1, 2)
    (row,) = reports.untouched(dup, before).collect()
    assert (row.id, row.rows_before, row.rows_after) == (17, 2, 1)
    assert reports.untouched(before, dup).isEmpty()
    plan = reports.untouched(before, before)
    assert plan.isEmpty()


@pytest.mark.parametrize("mode", ["broadcast", "shuffle"])
def test_one_scan_counts_all_rules_of_a_table(spark, tmp_path, mode, request):
    if mode == "shuffle":
        request.getfixturevalue("no_broadcast")
    folder = str(tmp_path / "t")
    spark.range(200).selectExpr("id", "id % 5 AS k", "id % 3 AS m").write.parquet(folder)
    tables = {"t": spark.read.parquet(folder)}
    reachers = {
        "A": Reacher(spark.createDataFrame([("1", 1), ("2", 2), ("x", 2)], "key_no string, chunk_no int"), tables),
        "B": Reacher(spark.createDataFrame([("1", 3), ("9", 1)], "key_no string, chunk_no int"), tables),
    }
    rules = [
        DeletionRule("A", "t", 1, KeyPath("k", "bigint")), DeletionRule("A", "t", 2, KeyPath("m", "bigint")),
        DeletionRule("B", "t", 1, KeyPath("k", "bigint")), DeletionRule("B", "t", 2, KeyPath("id", "bigint", where="m = 0")),
    ]
    claims = [(r, reachers[r.group_code]) for r in rules]
    estimates = tallied_estimates(claims)
    assert estimates._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {(r.group_code, r.execution_order): r.estimated_rows_to_delete for r in estimates.collect()}
    rows = [(i, i % 5, i % 3) for i in range(200)]
    assert got == {
        ("A", 1): sum(k in (1, 2) for _, k, _ in rows), ("A", 2): sum(m in (1, 2) for *_, m in rows),
        ("B", 1): sum(k == 1 for _, k, _ in rows), ("B", 2): sum(m == 0 and i in (1, 9) for i, _, m in rows),
    }
    audit = {(r.group_code, r.execution_order, r.chunk_no): r.deleted_row_count
             for r in tallied_audit(claims).collect()}
    want = dict.fromkeys([("A", o, c) for o in (1, 2) for c in (1, 2)] + [("B", o, c) for o in (1, 2) for c in (1, 3)], 0)
    for i, k, m in rows:
        a = [(c, o) for o, v in ((1, k), (2, m)) for key, c in ((1, 1), (2, 2)) if v == key]
        b = [(3, 1)] if k == 1 else []
        b += [(1, 2)] if m == 0 and i == 9 else []
        for group, found in (("A", a), ("B", b)):
            if found:
                chunk, order = min(found)
                want[group, order, chunk] += 1
    assert audit == want
