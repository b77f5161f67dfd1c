"""Cases in which rows or requests were lost, doubled or certified too early."""

from __future__ import annotations

import pytest

from lethe.config import DeletionConfig, DeletionRule, Group, Hop, KeyPath
from lethe.operators import reports
from lethe.operators.masking import bind_parameters
from lethe.plans import erasure
from lethe.sources.snapshots import SnapshotStore


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"))


def ingested(store, config, keys):
    rows = [(config.groups[0].key_type, k) for k in keys]
    frame = store.spark.createDataFrame(rows, "key_type string, key_no string")
    erasure.ingest(store, frame, "B")


def dry_run(store, config, as_of=None):
    erasure.run_deletion_dry_run(store, config, "B", as_of=as_of)
    return {(r.key_no, r.status) for r in store.read(erasure.TASKS).collect()}


def test_text_keys_meet_numbers(spark, store):
    store.put("t", spark.range(8, 13).toDF("id"))
    config = DeletionConfig([Group("G", "T")], [DeletionRule("G", "t", 1, KeyPath("id"))])
    ingested(store, config, ["9", "10"])
    assert dry_run(store, config) == {("9", "VALIDATED"), ("10", "VALIDATED")}
    erasure.run_deletion(store, config, "B")
    assert {r.id for r in store.read("t").collect()} == {8, 11, 12}
    audit = store.read(erasure.AUDIT).collect()
    assert sum(r.deleted_row_count for r in audit) == 2


def test_hop_from_text_to_number_counts_what_is_deleted(spark, store):
    store.put("p", spark.createDataFrame([("a", "9"), ("a", "10"), ("b", "11")], "k string, ref string"))
    store.put("c", spark.range(8, 13).toDF("id"))
    path = KeyPath("k", hops=(Hop("id", "p", "ref"),))
    config = DeletionConfig(
        [Group("G", "T")], [DeletionRule("G", "c", 1, path), DeletionRule("G", "p", 2, KeyPath("k"))]
    )
    ingested(store, config, ["a"])
    dry_run(store, config)
    erasure.run_deletion(store, config, "B")
    counted = {r.target_table: r.deleted_row_count for r in store.read(erasure.AUDIT).collect()}
    assert counted == {"c": 2, "p": 2} and store.read("c").count() == 3


def test_dated_parent_in_a_hop(spark, store):
    rows = [("a", 1, "2019-01-01"), ("a", 2, "2024-01-01")]
    store.put("p", spark.createDataFrame(rows, "k string, ref long, d string"))
    store.put("c", spark.range(1, 4).toDF("id"))
    hop = Hop("id", "p", "ref", where="d < {as_of}")
    config = DeletionConfig(
        [Group("G", "T")],
        [DeletionRule("G", "c", 1, KeyPath("k", hops=(hop,))), DeletionRule("G", "p", 2, KeyPath("k", where="d < {as_of}"))],
    )
    ingested(store, config, ["a"])
    dry_run(store, config, "2020-01-01")
    erasure.run_deletion(store, config, "B", as_of="2020-01-01")
    assert {r.id for r in store.read("c").collect()} == {2, 3} and store.read("p").count() == 1


def test_resuming_goes_on_behind_what_is_done(spark, store):
    store.put("x", spark.range(5).selectExpr("string(id) AS k"))
    store.put("y", spark.range(5).selectExpr("string(id) AS k"))
    config = DeletionConfig(
        [Group("G", "T")], [DeletionRule("G", "x", 1, KeyPath("k")), DeletionRule("G", "y", 2, KeyPath("k"))]
    )
    ingested(store, config, ["1", "2"])
    dry_run(store, config)
    erasure.run_deletion(store, config, "B", up_to_order=1)
    shown = reports.progress(store.read(erasure.TASKS), config.rules_frame(spark)).collect()
    assert {r.execution_status for r in shown} == {"INCOMPLETE / HAS FAILURES"}
    before = store.tables(store.version)["x"].dirs
    erasure.run_deletion(store, config, "B")
    assert store.tables(store.version)["x"].dirs == before
    assert {r.status for r in store.read(erasure.TASKS).collect()} == {"COMPLETED"}
    audit = [(r.target_table, r.deleted_row_count) for r in store.read(erasure.AUDIT).collect()]
    assert sorted(audit) == [("x", 2), ("y", 2)]


def test_certificate_of_an_adopted_table(spark, store, tmp_path):
    source = tmp_path / "source"
    spark.range(5).selectExpr("string(id) AS k").write.parquet(str(source))
    store.adopt("t", str(source))
    config = DeletionConfig([Group("G", "T")], [DeletionRule("G", "t", 1, KeyPath("k"))])
    ingested(store, config, ["1"])
    dry_run(store, config)
    erasure.run_deletion(store, config, "B")
    store.expire(keep_last=1)
    assert not any(r.older_copies_removed for r in erasure.certificate(store, "B").collect())
    source.rename(tmp_path / "elsewhere")
    assert all(r.older_copies_removed for r in erasure.certificate(store, "B").collect())


def test_a_table_without_hits_is_not_written(spark, store):
    store.put("x", spark.range(5).selectExpr("string(id) AS k"))
    store.put("y", spark.range(5, 9).selectExpr("string(id) AS k"))
    config = DeletionConfig(
        [Group("G", "T")], [DeletionRule("G", "y", 1, KeyPath("k")), DeletionRule("G", "x", 2, KeyPath("k"))]
    )
    ingested(store, config, ["1"])
    dry_run(store, config)
    before = store.tables(store.version)["y"].dirs
    erasure.run_deletion(store, config, "B")
    assert store.tables(store.version)["y"].dirs == before and store.read("x").count() == 4


def test_parameters_leave_text_and_variant_paths_alone(spark):
    given = {"salt": "s"}
    row = spark.range(1).selectExpr("'x' AS x", "'{\"cvv\": 7}' AS p")
    text = row.select(bind_parameters("concat('note:done ', x, :salt)", given)).first()[0]
    path = row.select(bind_parameters("concat(parse_json(p):cvv::string, :salt)", given)).first()[0]
    assert (text, path) == ("note:done xs", "7s")
    with pytest.raises(ValueError):
        bind_parameters("concat(x, :other)", given)
