"""Verification and compliance reports.

All take the batch's items, tasks, rules, summary and audit rows and join them
on group and order as well as table, so a table named by two groups is not
counted twice.  Rules are configuration and broadcast; tasks are counted per
group and status before they meet the rules, so a large group is a few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lethe.config import KeyPath
from lethe.operators.purge import union_all
from lethe.operators.reach import found_keys
from lethe.operators.sizing import sized_groups
from lethe.operators.tasks import (
    COMPLETED,
    FAILED,
    NOT_FOUND,
    PARTIAL_COMPLETED,
    PENDING,
    VALIDATED,
)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, two decimals; NULL for an empty whole."""
    return F.round(F.try_divide(part * 100.0, whole), 2).cast("double")


def seconds_between(first: Column, last: Column) -> Column:
    return (F.unix_micros(last) - F.unix_micros(first)) / 1e6


def _rate(rows: Column, seconds: Column, digits: int) -> Column:
    return F.round(F.try_divide(rows, seconds), digits).cast("double")


def _tasks_by_status(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("batch_id", "group_code", "status").agg(F.count(F.lit(1)).alias("_n"))


def _count(*statuses: str) -> Column:
    chosen = F.when(F.col("status").isin(*statuses), F.col("_n")) if statuses else F.col("_n")
    return F.coalesce(F.sum(chosen), F.lit(0))


def _per_rule(tasks: DataFrame, rules: DataFrame):
    rule = rules.select("group_code", "target_table", "execution_order")
    joined = _tasks_by_status(tasks).join(F.broadcast(rule), "group_code")
    return joined.groupBy("batch_id", "group_code", "target_table", "execution_order")


def ingest_mapping(items: DataFrame, tasks: DataFrame, rules: DataFrame) -> DataFrame:
    """Per rule: master keys, mapped tasks and first ingest."""
    keys = ["batch_id", "key_type", "key_no"]
    counted = (
        items.select(*keys, "created_at")
        .join(tasks.select(*keys, "group_code"), keys)
        .groupBy("group_code", "key_type")
        .agg(
            # a key is one task of a group, so tasks of a group are distinct keys
            F.count(F.lit(1)).alias("mapped_tasks_count"),
            F.min("created_at").alias("ingested_at"),
        )
    )
    rule = rules.select("group_code", "target_table", "execution_order")
    return (
        counted.join(F.broadcast(rule), "group_code")
        .select(
            "group_code", "target_table", "execution_order", "key_type",
            F.col("mapped_tasks_count").alias("master_keys_count"),
            "mapped_tasks_count", "ingested_at",
        )
        .orderBy("group_code", "execution_order")
    )


def match_rate(tasks: DataFrame, rules: DataFrame) -> DataFrame:
    valid, total = _count(VALIDATED, COMPLETED), _count()
    return (
        _per_rule(tasks, rules)
        .agg(
            total.alias("total_tasks"),
            valid.alias("valid_matched_keys"),
            _count(NOT_FOUND).alias("not_found_keys"),
            _count(PENDING).alias("pending_tasks"),
            percent(valid, total).alias("match_rate_pct"),
        )
        .drop("batch_id")
        .orderBy("group_code", "execution_order")
    )


def estimates(summary: DataFrame) -> DataFrame:
    return summary.orderBy("batch_id", "group_code", "execution_order")


def signoff(
    items: DataFrame, tasks: DataFrame, rules: DataFrame, summary: DataFrame
) -> DataFrame:
    """Per rule: key statistics of the batch, matches and estimated rows."""
    per_key = items.groupBy("batch_id", "key_no").agg(F.collect_set("key_type").alias("types"))
    batch = per_key.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total_master_keys"),
        # few key types exist; the set stays small however many keys there are
        F.array_join(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("types")))), ", "
        ).alias("key_types"),
    )
    valid, total = _count(VALIDATED, COMPLETED), _count()
    stats = _per_rule(tasks, rules).agg(
        valid.alias("valid_matched_keys"),
        _count(NOT_FOUND).alias("not_found_keys"),
        percent(valid, total).alias("match_rate_pct"),
    )
    on = ["batch_id", "group_code", "target_table", "execution_order"]
    estimated = summary.select(*on, "estimated_rows_to_delete")
    return (
        stats.join(batch, "batch_id")
        .join(estimated, on, "left")
        .select(
            *on, "key_types", "total_master_keys", "valid_matched_keys", "not_found_keys",
            "match_rate_pct",
            F.coalesce("estimated_rows_to_delete", F.lit(0)).alias("estimated_rows_to_purge"),
        )
        .orderBy("group_code", "execution_order")
    )


def signoff_totals(summary: DataFrame, tasks: DataFrame) -> DataFrame:
    """Rows per table, per group and overall; skipped keys per group and overall."""
    rows = summary.rollup("group_code", "target_table").agg(
        F.sum("estimated_rows_to_delete").alias("rows_to_purge")
    )
    skipped = (
        _tasks_by_status(tasks).rollup("group_code").agg(_count(NOT_FOUND).alias("skipped_keys"))
    )
    left, right = rows.alias("r"), skipped.alias("s")
    same_group = F.col("r.group_code").eqNullSafe(F.col("s.group_code"))
    return left.join(
        right, same_group & F.col("r.target_table").isNull(), "left"
    ).select("r.group_code", "r.target_table", "rows_to_purge", "skipped_keys")


def progress(tasks: DataFrame, rules: DataFrame) -> DataFrame:
    total = _count()
    # partly done tasks are picked up again, so they are open like pending ones
    remaining, failed = _count(PENDING, VALIDATED, PARTIAL_COMPLETED), _count(FAILED)
    return (
        _per_rule(tasks, rules)
        .agg(
            total.alias("total_tasks"),
            _count(COMPLETED).alias("completed_tasks"),
            remaining.alias("remaining_tasks"),
            _count(NOT_FOUND).alias("skipped_not_found"),
            failed.alias("failed_errors"),
            percent(_count(COMPLETED, NOT_FOUND), total).alias("progress_pct"),
            F.when((remaining == 0) & (failed == 0), F.lit("PASSED: 100% COMPLETED"))
            .otherwise(F.lit("INCOMPLETE / HAS FAILURES"))
            .alias("execution_status"),
        )
        .drop("batch_id")
        .orderBy("group_code", "execution_order")
    )


def reconcile(summary: DataFrame, audit: DataFrame) -> DataFrame:
    """Estimated against deleted rows per rule, also where only one side exists."""
    on = ["batch_id", "group_code", "target_table", "execution_order"]
    actual = audit.groupBy(*on).agg(F.sum("deleted_row_count").alias("_actual"))
    estimated = F.coalesce("estimated_rows_to_delete", F.lit(0))
    deleted = F.coalesce("_actual", F.lit(0))
    return (
        summary.select(*on, "estimated_rows_to_delete")
        .join(actual, on, "full_outer")
        .select(
            *on,
            estimated.alias("dry_run_estimated"),
            deleted.alias("actual_deleted"),
            (deleted - estimated).alias("variance"),
            F.when(estimated == deleted, F.lit("MATCH (100%)"))
            .otherwise(F.lit("MISMATCH - CHECK REQUIRED"))
            .alias("reconciliation_status"),
        )
        .orderBy("group_code", "execution_order")
    )


def residual(
    tasks: DataFrame, roots: dict[str, tuple[str, KeyPath]], tables: dict[str, DataFrame],
    as_of: str | None = None,
) -> DataFrame:
    """Per group: completed keys that still reach a row of the group's root table."""
    completed = tasks.where(F.col("status") == COMPLETED)
    sized = sized_groups(completed.select("group_code", "key_no"), "group_code", list(roots))
    leaks = [
        found_keys(path, tables[table], sized[code], tables, as_of)
        .agg(F.count(F.lit(1)).alias("leaked_residual_keys"))
        .select(F.lit(code).alias("group_code"), F.lit(table).alias("target_table"), "*")
        for code, (table, path) in sorted(roots.items())
    ]
    checked = completed.groupBy("batch_id", "group_code").agg(
        F.count(F.lit(1)).alias("completed_keys_checked")
    )
    return checked.join(union_all(leaks), "group_code").select(
        "batch_id", "group_code", "target_table", "completed_keys_checked",
        "leaked_residual_keys",
        F.when(F.col("leaked_residual_keys") == 0, F.lit("CLEAN (0 RESIDUAL)"))
        .otherwise(F.lit("FAIL: RESIDUAL DATA DETECTED"))
        .alias("sanity_status"),
    )


def throughput(audit: DataFrame) -> DataFrame:
    first, last = F.min("started_at"), F.max("executed_at")
    rows, duration = F.sum("deleted_row_count"), seconds_between(first, last)
    return (
        audit.groupBy("group_code", "target_table")
        .agg(
            F.count(F.lit(1)).alias("chunk_batches"),
            rows.alias("total_rows_deleted"),
            first.alias("first_chunk_at"),
            last.alias("last_chunk_at"),
            F.round(duration, 2).cast("double").alias("duration_seconds"),
            _rate(rows, duration, 2).alias("rows_per_second"),
        )
        .orderBy("first_chunk_at", "group_code", "target_table")
    )


def certificate(audit: DataFrame, tasks: DataFrame) -> DataFrame:
    """Certificate of destruction per rule."""
    keys = tasks_by_group(tasks)
    on = ["batch_id", "group_code"]
    return (
        audit.groupBy(*on, "target_table", "execution_order")
        .agg(
            F.sum("deleted_row_count").alias("total_purged_rows"),
            F.min("started_at").alias("purge_started_at"),
            F.max("executed_at").alias("purge_completed_at"),
        )
        .join(keys, on, "left")
        .select(
            *on, "target_table", "execution_order", "total_purged_rows", "purge_started_at",
            "purge_completed_at",
            F.coalesce("completed_keys_count", F.lit(0)).alias("completed_keys_count"),
            F.coalesce("missing_keys_count", F.lit(0)).alias("missing_keys_count"),
        )
        .orderBy("group_code", "execution_order")
    )


def tasks_by_group(tasks: DataFrame) -> DataFrame:
    return (
        _tasks_by_status(tasks)
        .groupBy("batch_id", "group_code")
        .agg(
            _count(COMPLETED).alias("completed_keys_count"),
            _count(NOT_FOUND).alias("missing_keys_count"),
        )
    )


def status_plain(tasks: DataFrame) -> DataFrame:
    return (
        tasks.groupBy("batch_id", "group_code", "status")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy("batch_id", "group_code", "status")
    )


def status_share(tasks: DataFrame) -> DataFrame:
    """Tasks per group and status, with the share of the group."""
    counted = tasks.groupBy("group_code", "status").agg(F.count(F.lit(1)).alias("task_count"))
    whole = F.sum("task_count").over(Window.partitionBy("group_code"))
    return counted.withColumn("pct", percent(F.col("task_count"), whole)).orderBy(
        "group_code", "status"
    )


def status_times(tasks: DataFrame) -> DataFrame:
    return (
        tasks.groupBy("group_code", "status")
        .agg(
            F.count(F.lit(1)).alias("total_tasks"),
            F.min("processed_at").alias("first_processed"),
            F.max("processed_at").alias("last_processed"),
        )
        .orderBy("group_code", "status")
    )


def mask_audit_summary(audit: DataFrame) -> DataFrame:
    rows, duration = F.sum("masked_row_count"), F.sum("duration_sec").cast("double")
    return (
        audit.groupBy("group_code", "target_table", "columns_masked")
        .agg(
            F.count(F.lit(1)).alias("total_chunks"),
            rows.alias("total_rows_masked"),
            F.round(F.avg("masked_row_count"), 1).alias("avg_rows_per_chunk"),
            F.round(duration, 2).alias("total_duration_seconds"),
            F.when(duration > 0, F.round(rows / duration, 0))
            .otherwise(F.lit(0.0))
            .alias("rows_per_second"),
        )
        .orderBy("group_code", "target_table")
    )


def chunk_timeline(audit: DataFrame, rows: int = 100) -> DataFrame:
    """The first audit rows by chunk."""
    return (
        audit.select(
            "chunk_number", "group_code", "target_table", "execution_order", "columns_masked",
            "masked_row_count", "duration_sec", "processed_at",
        )
        .orderBy("chunk_number", "group_code", "target_table", "execution_order",
                 "columns_masked")
        .limit(rows)
    )


def failed_tasks(tasks: DataFrame) -> DataFrame:
    return tasks.where(F.col("status") == FAILED).select(
        "group_code", "key_no", "error_message", "processed_at"
    )


def not_found_sample(tasks: DataFrame, rows: int = 50) -> DataFrame:
    """The first keys that were not found."""
    return (
        tasks.where(F.col("status") == NOT_FOUND)
        .select("group_code", "key_no", "status", "created_at")
        .orderBy("group_code", "key_no")
        .limit(rows)
    )


def audit_trail(audit: DataFrame) -> DataFrame:
    return audit.orderBy("batch_id", "group_code", "executed_at", "execution_order", "chunk_no")


def audit_totals(audit: DataFrame, by: list[str], rows: str) -> DataFrame:
    return audit.groupBy(*by).agg(F.sum(rows).alias("total_rows"), F.count(F.lit(1)).alias("chunks"))


BUCKETS = 4096  # fingerprints of a table


def _with_bucket(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_hash", F.xxhash64(*rows.columns)).withColumn(
        "_bucket", F.pmod("_hash", F.lit(BUCKETS)).cast("int")
    )


def fingerprints(rows: DataFrame) -> DataFrame:
    """Per bucket of rows a fingerprint that does not depend on their order.

    Rows fall into buckets by their hash.  The number of rows, the sums of both halves
    of their hashes, the exclusive or, and the sum of a second hash are aggregated where
    the rows are; at most ``BUCKETS`` rows a task are shuffled.
    """
    second = F.hash(*rows.columns).cast("long")
    low = F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("_hash", 32)
    return (
        _with_bucket(rows)
        .withColumn("_second", second)
        .groupBy("_bucket")
        .agg(
            F.count(F.lit(1)).alias("rows"), F.sum(low).alias("low"), F.sum(high).alias("high"),
            F.bit_xor("_hash").alias("mixed"), F.sum("_second").alias("second"),
        )
    )


def differing_buckets(before: DataFrame, after: DataFrame) -> list[int]:
    """Buckets whose fingerprints differ; at most ``BUCKETS``."""
    names = ("rows", "low", "high", "mixed", "second")
    was = fingerprints(before).select("_bucket", F.struct(*names).alias("was"))
    now = fingerprints(after).select("_bucket", F.struct(*names).alias("now"))
    both = was.join(now, "_bucket", "full").where(~F.col("was").eqNullSafe(F.col("now")))
    return [r["_bucket"] for r in both.select("_bucket").collect()]


def untouched(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of ``before`` (those outside the key file) missing from ``after``.

    Fingerprints are compared first, and rows only in the buckets in which they differ:
    there both sides are counted per distinct row, many copies of one row as one count
    per task.
    """
    columns = before.columns
    types = {f.name: f.dataType for f in before.schema.fields}
    after = after.select(*[F.col(c).cast(types[c]).alias(c) for c in columns])
    buckets = differing_buckets(before, after)
    before, after = (
        _with_bucket(f).where(F.col("_bucket").isin(buckets)).select(*columns)
        for f in (before, after)
    )
    was = before.groupBy(*columns).agg(F.count(F.lit(1)).alias("_was"), F.lit(0).alias("_is"))
    now = after.groupBy(*columns).agg(F.lit(0).alias("_was"), F.count(F.lit(1)).alias("_is"))
    return (
        was.unionByName(now)
        .groupBy(*columns)
        .agg(F.sum("_was").alias("rows_before"), F.sum("_is").alias("rows_after"))
        .where("rows_before > rows_after")
    )


def row_counts(before: DataFrame, after: DataFrame, removed: DataFrame) -> DataFrame:
    """(rows_before, rows_removed, rows_after, balanced); ``removed`` has row_count."""
    names = ("rows_before", "rows_removed", "rows_after")
    counts = (
        before.agg(F.count(F.lit(1)).alias("n")),
        removed.agg(F.sum("row_count").alias("n")),
        after.agg(F.count(F.lit(1)).alias("n")),
    )
    return side_by_side(dict(zip(names, counts, strict=True))).withColumn(
        "balanced", F.col("rows_before") - F.col("rows_removed") == F.col("rows_after")
    )


def side_by_side(numbers: dict[str, DataFrame]) -> DataFrame:
    """One row with a column per single-number frame."""
    tagged = union_all(
        [f.toDF("n").withColumn("name", F.lit(name)) for name, f in numbers.items()]
    )
    return tagged.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("name") == name, F.col("n"))), F.lit(0)).alias(name)
            for name in numbers
        ]
    )
