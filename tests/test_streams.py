"""Streaming jobs, repeated micro-batches included."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lethe.config import DeletionConfig, DeletionRule, Group, KeyPath
from lethe.operators.sizing import VALUE, sized
from lethe.plans import erasure
from lethe.sources.snapshots import SnapshotStore
from lethe.streaming.audit_rate import RateParts, audit_rate, read_rates, start_audit_rate
from lethe.streaming.requests import read_requests, start_intake
from lethe.streaming.suppress import read_output, start_suppression


def test_intake_takes_each_request_once(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.put("t", spark.range(5).select(F.col("id").cast("string").alias("k")))
    config = DeletionConfig([Group("G", "T")], [DeletionRule("G", "t", 1, KeyPath("k"))])
    drop = tmp_path / "drop"
    drop.mkdir()

    def put(name, *keys):
        lines = [f"T,{k},2025-01-01T00:00:00" for k in keys]
        (drop / name).write_text("key_type,key_no,requested_at\n" + "\n".join(lines) + "\n")

    def run(checkpoint="c1"):
        start_intake(
            store, config, read_requests(spark, str(drop), 1), "B", str(tmp_path / checkpoint)
        ).awaitTermination()
        return {(r["key_no"], r["status"]) for r in store.read(erasure.TASKS).collect()}

    put("a.csv", "1", " 1 ", "2")
    put("b.csv", "2", "9")
    expected = {("1", "VALIDATED"), ("2", "VALIDATED"), ("9", "NOT_FOUND")}
    assert run() == expected
    put("c.csv", "3")
    expected |= {("3", "VALIDATED")}
    assert run() == expected
    assert run("fresh") == expected  # everything again, without the stream's memory
    assert store.read(erasure.ITEMS).count() == 4
    (drop / "late.csv").write_text("key_type,key_no,requested_at\nT,4,2020-01-01T00:00:00\n")
    expected |= {("4", "VALIDATED")}
    assert run() == expected  # years older than what was taken before


@pytest.mark.parametrize("mode", ["broadcast", "shuffle"])
def test_suppression(spark, tmp_path, mode, request):
    if mode == "shuffle":
        request.getfixturevalue("no_broadcast")
    source = str(tmp_path / "events")
    rows = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 10 == 1, None)
        .otherwise(F.col("id")).alias("who"),
        F.lit("x").alias("v"),
    )
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    erased = sized(spark.createDataFrame([(1,), (2,)], f"{VALUE} long"))

    def run(name, masks=None):
        out = str(tmp_path / name)
        start_suppression(stream, F.col("who"), lambda: erased, out, out + "-c", masks
                          ).awaitTermination()
        return read_output(spark, out)

    plain = [r["who"] for r in rows.collect()]
    kept = sorted(map(str, (r["who"] for r in run("dropped").collect())))
    assert kept == sorted(str(w) for w in plain if w not in (1, 2))
    masked = run("masked", {"v": F.lit("gone")})
    assert masked.count() == 300
    assert masked.where("v = 'gone'").count() == sum(w in (1, 2) for w in plain)


def test_suppression_with_a_trigger_of_its_own(spark, tmp_path):
    source, out = str(tmp_path / "events"), str(tmp_path / "out")
    rows = spark.range(10).select(F.col("id").alias("who"))
    rows.write.parquet(source)
    erased = sized(spark.createDataFrame([(1,)], f"{VALUE} long"))
    query = start_suppression(
        spark.readStream.schema(rows.schema).parquet(source), F.col("who"), lambda: erased,
        out, out + "-c", trigger={"processingTime": "1 second"},
    )
    try:
        query.processAllAvailable()
        rows.write.mode("append").parquet(source)
        query.processAllAvailable()  # goes on with what arrives later
    finally:
        query.stop()
    assert read_output(spark, out).count() == 18


def test_audit_rate_as_stream_and_batch(spark, tmp_path):
    source, out = str(tmp_path / "audit"), str(tmp_path / "rates")
    audit = spark.range(100).select(
        F.lit("G").alias("group_code"),
        F.col("id").alias("deleted_row_count"),
        F.timestamp_seconds(F.col("id") * 7 + 1_700_000_000).alias("executed_at"),
    )
    audit.repartition(5).write.option("maxRecordsPerFile", 10).parquet(source)
    stream = (
        spark.readStream.schema(audit.schema).option("maxFilesPerTrigger", 3).parquet(source)
    )
    start_audit_rate(stream, out, str(tmp_path / "c")).awaitTermination()
    got = sorted(map(tuple, read_rates(spark, out).collect()))
    assert got == sorted(map(tuple, audit_rate(audit).collect()))


def test_late_audit_rows_are_counted(spark, tmp_path):
    source = tmp_path / "audit"
    out, checkpoint = str(tmp_path / "rates"), str(tmp_path / "c")
    schema = "group_code string, deleted_row_count long, executed_at timestamp"
    for hour in (12, 15, 9):  # the last file is hours late
        rows = [("G", 5, f"2025-01-01 {hour:02}:00:30")]
        frame = spark.createDataFrame(rows, "group_code string, deleted_row_count long, t string")
        frame.selectExpr("group_code", "deleted_row_count", "timestamp(t) AS executed_at").write.mode(
            "append"
        ).parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        start_audit_rate(stream, out, checkpoint).awaitTermination()
    assert read_rates(spark, out).count() == 3


RATE_AUDIT = "group_code string, deleted_row_count long, executed_at timestamp"


def _rate_run(spark, folder, files, fan=3):
    """One micro-batch a file; (stream starter, expected rates)."""
    source, out, checkpoint = (str(folder / n) for n in ("audit", "rates", "c"))
    audit = spark.range(files * 4).select(
        F.concat(F.lit("G"), F.col("id") % 2).alias("group_code"),
        F.col("id").alias("deleted_row_count"),
        # every fourth row is hours late
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 7 - F.when(F.col("id") % 4 == 0, 9000).otherwise(0)).alias(
            "executed_at"
        ),
    )
    audit.repartitionByRange(files, "deleted_row_count").write.parquet(source)

    def run(checkpoint=checkpoint):
        stream = spark.readStream.schema(RATE_AUDIT).option("maxFilesPerTrigger", 1).parquet(source)
        start_audit_rate(stream, out, checkpoint, fan=fan).awaitTermination()
        return sorted(map(tuple, read_rates(spark, out).collect()))

    return run, RateParts(spark, out), sorted(map(tuple, audit_rate(audit).collect()))


def test_rates_are_folded_and_counted_once(spark, tmp_path):
    run, parts, expected = _rate_run(spark, tmp_path, 12)
    assert run() == expected
    # 12 micro-batches: 0 to 8 in one part, the others not yet folded
    assert parts.cover() == [(0, 8), (9, 9), (10, 10), (11, 11)]
    # what 0-8 holds stays until the next fold; folds of the time before are gone
    assert not [s for s in parts.spans() if s[0] == s[1] and s[0] < 6]
    before = parts.spans()
    parts.fold(9, 3)  # repeated
    assert parts.cover() == [(0, 8), (9, 9), (10, 10), (11, 11)] and len(parts.spans()) <= len(before)
    assert sorted(map(tuple, read_rates(spark, parts.out).collect())) == expected


def test_folded_micro_batches_are_not_counted_again(spark, tmp_path):
    run, parts, expected = _rate_run(spark, tmp_path, 7)
    assert run() == expected
    assert (0, 2) in parts.cover() and parts.holds(1) and not parts.holds(6)
    assert run(str(tmp_path / "restored")) == expected  # the same micro-batches from the start


def test_interrupted_fold_is_not_read(spark, tmp_path):
    run, parts, expected = _rate_run(spark, tmp_path, 5, fan=100)
    assert run() == expected
    parts.read([(0, 0), (1, 1)]).write.parquet(parts.folder((0, 3)))
    mark = parts._path(f"{parts.folder((0, 3))}/_SUCCESS")
    parts._fs.delete(mark, False)  # as a writer that was killed leaves it
    assert sorted(map(tuple, read_rates(spark, parts.out).collect())) == expected
    parts.fold(4, 4)  # the repeat writes it whole
    assert parts.cover() == [(0, 3), (4, 4)]
    assert sorted(map(tuple, read_rates(spark, parts.out).collect())) == expected
