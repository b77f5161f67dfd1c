"""Masking runs over a snapshot store: ingest, dry run, real run."""

from __future__ import annotations

import time
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.config import MaskingConfig, MaskingRule
from lethe.operators import reports
from lethe.operators.configtables import replace_scope
from lethe.operators.masking import (
    PREVIEW_SCHEMA,
    estimate_mask,
    mask_preview,
    mask_steps,
    masked_files,
    reached_mask_audit,
)
from lethe.operators.parallel import in_parallel
from lethe.operators.purge import union_all
from lethe.operators.reach import Reacher
from lethe.operators.sizing import Measured, durable
from lethe.operators.tasks import (
    TASK_SCHEMA,
    complete_tasks,
    expand_tasks,
    group_scope,
    is_runnable,
    validate_first,
)
from lethe.plans import erasure
from lethe.plans.erasure import batch_rows, conform, now, read_or_empty, replace_batch
from lethe.sources.keyfile import ITEM_SCHEMA, MASKING_FALLBACK
from lethe.sources.snapshots import SnapshotStore, Transaction

ITEMS, TASKS, SUMMARY, AUDIT = (
    "masking_items", "masking_tasks", "masking_summary", "masking_audit",
)
_SUMMARY_TEXT = (
    "batch_id string, group_code string, target_table string, column_name string, "
    "execution_order int, mask_expression string, estimated_rows_to_mask bigint, "
    "created_at timestamp"
)
SUMMARY_SCHEMA = f"{_SUMMARY_TEXT}, sample_preview {PREVIEW_SCHEMA}"
AUDIT_SCHEMA = (
    "batch_id string, group_code string, target_table string, columns_masked string, "
    "execution_order int, masked_row_count bigint, chunk_number int, "
    "duration_sec decimal(10,3), processed_at timestamp"
)


def ingest(
    store: SnapshotStore, keys: DataFrame, batch_id: str, key_type: str | None = None
) -> DataFrame:
    return erasure.ingest(store, keys, batch_id, key_type, ITEMS, MASKING_FALLBACK)


def require_batch(items: DataFrame, batch_id: str) -> None:
    if items.isEmpty():
        raise ValueError(f"batch {batch_id} has no keys")


def run_masking_dry_run(
    store: SnapshotStore, config: MaskingConfig, batch_id: str, group_code: str | None = None,
    as_of: str | None = None, parameters: dict[str, str] | None = None,
) -> int:
    """Expand, validate, estimate and preview; returns the number of groups."""
    spark = store.spark
    items = batch_rows(read_or_empty(store, ITEMS, ITEM_SCHEMA), batch_id)
    require_batch(items, batch_id)
    tasks = batch_rows(read_or_empty(store, TASKS, TASK_SCHEMA), batch_id)
    groups = config.groups_frame(spark)
    added = conform(expand_tasks(items, groups, tasks, group_code=group_code), TASK_SCHEMA)
    tasks = durable(conform(tasks, TASK_SCHEMA).unionByName(added))

    wanted = {g.group_code for g in config.active_groups(group_code=group_code)}
    scope = [r.group_code for r in group_scope(tasks, groups).collect()]
    scope = [code for code in scope if code in wanted and config.rules_of(code)]
    if not scope:
        return 0
    tables = erasure.target_tables(store, [r for c in scope for r in config.rules_of(c)])
    tasks = durable(validate_first(tasks, config, tables, scope, as_of))

    sized = erasure.dry_run_keys(tasks, scope)

    def summarise(code: str) -> DataFrame:
        rules = config.rules_of(code)
        reacher = Reacher.over(sized[code], tables, as_of)
        previews = mask_preview(rules, reacher, parameters)  # one row per rule
        return estimate_mask(rules, reacher).join(
            F.broadcast(previews), ["group_code", "target_table", "column_name"]
        )

    parts = in_parallel(partial(summarise, code) for code in scope if sized[code].rows)

    old = batch_rows(read_or_empty(store, SUMMARY, SUMMARY_SCHEMA), batch_id)
    if group_code is not None:
        old = old.where(F.col("group_code") != group_code)
    else:
        old = old.where(F.lit(False))
    columns = [c.split()[0] for c in _SUMMARY_TEXT.split(", ")] + ["sample_preview"]
    old = old.select(*columns)
    if parts:
        new = union_all(parts).withColumns({"batch_id": F.lit(batch_id), "created_at": now()})
        old = replace_scope(old, durable(new.select(*columns)), ["batch_id", "group_code"])
    with store.begin() as change:
        replace_batch(change, TASKS, tasks, batch_id)
        replace_batch(change, SUMMARY, old, batch_id)
    return len(scope)


def run_masking(
    store: SnapshotStore, config: MaskingConfig, batch_id: str, group_code: str | None = None,
    max_order: int | None = None, as_of: str | None = None,
    parameters: dict[str, str] | None = None,
) -> int:
    """Mask what the batch's validated tasks reach; returns the number of groups."""
    scope = [g.group_code for g in config.active_groups(group_code=group_code)]
    scope = [code for code in scope if config.rules_of(code)]
    all_tasks = batch_rows(read_or_empty(store, TASKS, TASK_SCHEMA), batch_id)
    if not scope or all_tasks.isEmpty():
        return 0
    audit = batch_rows(read_or_empty(store, AUDIT, AUDIT_SCHEMA), batch_id)
    stages = erasure.chunked_keys(all_tasks, config, scope, audit, "chunk_number")
    done = 0
    for code in scope:
        last = config.rules_of(code)[-1].execution_order
        up_to = last if max_order is None else min(max_order, last)
        # a task partly masked before goes on behind the order it has reached
        orders = sorted(o for c, o in stages if c == code and not o >= up_to > 0)
        try:
            for order in orders:
                keys = stages[code, order]
                _run_stage(store, config, batch_id, code, order, up_to, keys, as_of, parameters)
        except erasure.FAILURES as failure:
            erasure.record_failure(store, TASKS, batch_id, code, failure)
        else:
            done += bool(orders)
    return done


def _run_stage(
    store: SnapshotStore, config: MaskingConfig, batch_id: str, code: str, order: int,
    up_to: int, keys: Measured, as_of: str | None, parameters: dict[str, str] | None,
) -> None:
    """Tables, audit and tasks of a group's keys that have reached ``order``, in one commit."""
    last = config.rules_of(code)[-1].execution_order
    rules = [r for r in config.rules_of(code, up_to) if r.execution_order > order]
    which = is_runnable(code) & (F.coalesce("done_order", F.lit(0)) == order)
    tasks = batch_rows(store.read(TASKS), batch_id).where(F.col("group_code") == code)
    with store.begin() as change:
        change.note = {"masked_batch": batch_id, "group_code": code}
        writes = []
        if rules:
            reacher = Reacher.over(keys, erasure.target_tables(store, rules), as_of)
            entries = _mask_group(change, batch_id, reacher, rules, parameters)
            writes.append(partial(change.append, AUDIT, entries, ("batch_id",)))
        tasks = conform(complete_tasks(tasks, which, now(), up_to, last), TASK_SCHEMA)
        writes.append(partial(replace_batch, change, TASKS, tasks, batch_id, code))
        in_parallel(writes)


def certificate(store: SnapshotStore, batch_id: str) -> DataFrame:
    """What was masked, and whether the unmasked values are gone for good.

    A version from before the masking still holds them, and so do adopted folders and
    files the tables were written from; ``older_copies_removed`` is true once none is left.
    """
    audit = batch_rows(store.read(AUDIT), batch_id)
    removed = F.lit(erasure.copies_removed(store, "masked_batch", batch_id))
    return reports.mask_audit_summary(audit).withColumn("older_copies_removed", removed)


def _mask_group(
    change: Transaction, batch_id: str, reacher: Reacher, rules: list[MaskingRule],
    parameters: dict[str, str] | None,
) -> DataFrame:
    """Write the tables with what the rules reach masked; returns the audit."""
    steps = mask_steps(rules)
    reacher.prepare([s.path for s in steps])  # all hits before any table changes
    chunks = reacher.keys.select(F.col("chunk_no").alias("chunk_number")).distinct()
    n_chunks = reacher.keys.select("chunk_no").distinct().count()

    def rewrite(name: str) -> DataFrame:
        began = time.monotonic()
        own = [s for s in steps if s.target_table == name]
        reached = erasure.reached_in(change, name, [s.path for s in own], reacher)
        if reached.files:  # a table in which nothing is reached stays as it is
            frames = masked_files(reached, own, parameters)
            at_once = reached.at_once(len(reached.paths))
            change.replace_files(name, list(reached.files), frames, at_once)
            reached.release()
        # each table is timed on its own; its chunks are masked in one go
        seconds = (time.monotonic() - began) / len(own) / n_chunks
        return reached_mask_audit(own, reached, chunks).withColumn("duration_sec", F.lit(seconds))

    names = dict.fromkeys(s.target_table for s in steps)
    parts = in_parallel(partial(rewrite, name) for name in names)
    entries = union_all(parts).withColumns(
        {"batch_id": F.lit(batch_id), "processed_at": now()}
    )
    return conform(entries, AUDIT_SCHEMA)


def drop_previews(store: SnapshotStore, before) -> None:
    """Empty the before/after samples of summaries made before a point in time.

    Samples show personal data, so they are kept for the sign-off only.
    """
    summary = store.read(SUMMARY)
    old = F.col("created_at") < F.lit(before).cast("timestamp")
    # as many batches as have samples to drop
    batches = [r.batch_id for r in summary.where(old).select("batch_id").distinct().collect()]
    empty = F.when(old, F.array().cast(PREVIEW_SCHEMA)).otherwise(F.col("sample_preview"))
    with store.begin() as change:
        kept = summary.where(F.col("batch_id").isin(batches)).withColumn("sample_preview", empty)
        change.replace_partitions(SUMMARY, F.col("batch_id").isin(batches), kept)
