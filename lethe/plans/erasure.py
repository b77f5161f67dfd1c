"""Deletion runs over a snapshot store: ingest, dry run, real run."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lethe.config import DeletionConfig, DeletionRule, KeyPath, small_frame
from lethe.functions import masks
from lethe.operators import reports
from lethe.operators.configtables import replace_scope
from lethe.operators.numbering import assign_chunks
from lethe.operators.parallel import in_parallel
from lethe.operators.positions import Reached, reached_rows
from lethe.operators.purge import by_table, reached_audit, union_all
from lethe.operators.reach import Reacher, prepare_together
from lethe.operators.sizing import Measured, durable, measured, sized_groups
from lethe.operators.tally import Claim, tallied_estimates
from lethe.operators.tasks import (
    COMPLETED,
    FAILED,
    PARTIAL_COMPLETED,
    RUNNABLE,
    TASK_SCHEMA,
    VALIDATED,
    complete_tasks,
    expand_tasks,
    group_scope,
    is_runnable,
    validate_root,
)
from lethe.sources.keyfile import DELETION_FALLBACK, ITEM_SCHEMA, keys_of, new_items
from lethe.sources.snapshots import SnapshotStore, Transaction

ITEMS, TASKS, SUMMARY, AUDIT = (
    "deletion_items", "deletion_tasks", "deletion_summary", "deletion_audit",
)
MESSAGE_LENGTH = 1000  # characters of a failure kept with a task
SUMMARY_SCHEMA = (
    "batch_id string, group_code string, target_table string, execution_order int, "
    "estimated_rows_to_delete bigint, executed_at timestamp, settled_rows bigint"
)
AUDIT_SCHEMA = (
    "batch_id string, group_code string, target_table string, execution_order int, "
    "chunk_no int, deleted_row_count bigint, started_at timestamp, executed_at timestamp"
)


def read_or_empty(store: SnapshotStore, name: str, schema: str) -> DataFrame:
    if store.exists(name):
        return store.read(name)
    return small_frame(store.spark, [], schema)


def conform(frame: DataFrame, schema: str) -> DataFrame:
    """Columns of ``schema``, in its order and types."""
    columns = [part.rsplit(" ", 1) for part in schema.split(", ")]
    return frame.select(*[F.col(n).cast(t).alias(n) for n, t in columns])


def now():
    """The driver's clock as a literal: every row of one step has the same time."""
    return F.lit(datetime.now(timezone.utc)).cast("timestamp")


def ingest(
    store: SnapshotStore, keys: DataFrame, batch_id: str, key_type: str | None = None,
    table: str = ITEMS, fallback: tuple[str, str] = DELETION_FALLBACK,
) -> DataFrame:
    """Add the keys of a file (or any frame) to a batch; returns the added items."""
    existing = read_or_empty(store, table, ITEM_SCHEMA).where(F.col("batch_id") == batch_id)
    items = new_items(keys_of(keys, key_type, fallback), existing, batch_id, now())
    items = durable(conform(items, ITEM_SCHEMA))
    with store.begin() as change:
        change.append(table, items, ("batch_id",))
    return items


def batch_rows(frame: DataFrame, batch_id: str) -> DataFrame:
    return frame.where(F.col("batch_id") == batch_id)


def target_tables(store: SnapshotStore, rules: list) -> dict[str, DataFrame]:
    """Current content of the tables the rules mention."""
    names = {r.target_table for r in rules}
    names |= {h.parent_table for r in rules for h in r.path.hops}
    state = store.tables()
    missing = sorted(names - set(state))
    if missing:
        raise ValueError(f"unknown tables: {', '.join(missing)}")
    return {n: store.frame(state[n]) for n in names}


def replace_batch(
    change, name: str, frame: DataFrame, batch_id: str, group_code: str | None = None
) -> None:
    """Rewrite one batch, or one group of it, of a table partitioned by these.

    Tasks are partitioned by batch and group, so a group's run leaves the others' alone.
    """
    partition_by = ("batch_id", "group_code") if name.endswith("_tasks") else ("batch_id",)
    if name not in change.tables:
        change.append(name, frame, partition_by)
        return
    condition = F.col("batch_id") == batch_id
    if group_code is not None:
        condition = condition & (F.col("group_code") == group_code)
    change.replace_partitions(name, condition, frame)


def merged_summary(
    old: DataFrame, found: DataFrame, tasks: DataFrame, add: bool = False
) -> DataFrame:
    """The batch's summary with new estimates.

    ``found`` replaces what was estimated for keys that have not run, and adds to what
    had been estimated for those that have (``settled_rows``).  With ``add`` it holds
    counts for further keys only and adds to all.
    """
    rule = ["batch_id", "group_code", "target_table", "execution_order"]
    done = F.col("status").isin(COMPLETED, PARTIAL_COMPLETED)
    # both have at most as many rows as there are rules
    ran = tasks.where(done).groupBy("group_code").agg(F.max("processed_at").alias("_ran"))
    was = old.select(
        *rule, F.col("estimated_rows_to_delete").alias("_old"),
        F.col("settled_rows").alias("_settled"), F.col("executed_at").alias("_at"),
    )
    joined = found.join(F.broadcast(was), rule, "left").join(F.broadcast(ran), "group_code", "left")
    known = F.coalesce("_old", F.lit(0))
    settled = F.when(F.col("_ran") > F.col("_at"), known).otherwise(F.coalesce("_settled", F.lit(0)))
    total = F.col("estimated_rows_to_delete") + (known if add else F.col("settled_rows"))
    new = joined.withColumn("settled_rows", settled).withColumn("estimated_rows_to_delete", total)
    return replace_scope(old, durable(conform(new, SUMMARY_SCHEMA)), ["batch_id", "group_code"])


def run_deletion_dry_run(
    store: SnapshotStore, config: DeletionConfig, batch_id: str, key_type: str | None = None,
    group_code: str | None = None, as_of: str | None = None, revalidate: bool = False,
) -> int:
    """Expand, validate and estimate; returns the number of groups that ran."""
    spark = store.spark
    items = batch_rows(read_or_empty(store, ITEMS, ITEM_SCHEMA), batch_id)
    tasks = batch_rows(read_or_empty(store, TASKS, TASK_SCHEMA), batch_id)
    groups = config.groups_frame(spark)
    added = conform(expand_tasks(items, groups, tasks, key_type, group_code), TASK_SCHEMA)
    tasks = durable(conform(tasks, TASK_SCHEMA).unionByName(added))

    wanted = {g.group_code for g in config.active_groups(key_type, group_code)}
    # at most as many rows as there are configured groups
    scope = [r.group_code for r in group_scope(tasks, groups).collect()]
    scope = [code for code in scope if code in wanted]
    if not scope:
        return 0
    rules = [r for code in scope for r in config.rules_of(code)]
    tables = target_tables(store, rules)
    tasks = durable(
        validate_root(tasks, config, tables, scope, as_of, revalidate)
    )

    sized = dry_run_keys(tasks, scope)

    reachers = {code: Reacher.over(sized[code], tables, as_of) for code in scope}
    parts = tallied_estimates(prepared_claims(config, reachers))
    estimates = parts.withColumn("batch_id", F.lit(batch_id)).withColumn("executed_at", now())
    old = batch_rows(read_or_empty(store, SUMMARY, SUMMARY_SCHEMA), batch_id)
    summary = merged_summary(conform(old, SUMMARY_SCHEMA), estimates, tasks)
    with store.begin() as change:
        replace_batch(change, TASKS, tasks, batch_id)
        replace_batch(change, SUMMARY, summary, batch_id)
    return len(scope)


def prepared_claims(config: DeletionConfig, reachers: dict[str, Reacher]) -> list[Claim]:
    """The rules of all groups with the values their keys reach; a common hop is read once."""
    claims = [(r, reacher) for code, reacher in reachers.items() for r in config.rules_of(code)]
    prepare_together([(reacher, r.path) for r, reacher in claims])
    return claims


def dry_run_keys(tasks: DataFrame, scope: list[str]) -> dict[str, Measured]:
    """Validated keys of each group, all in one chunk."""
    keys = tasks.where(F.col("status") == VALIDATED).select(
        "group_code", "key_no", F.lit(1).alias("chunk_no")
    )
    return sized_groups(keys, "group_code", scope)


def chunked_keys(
    tasks: DataFrame, config, scope: list[str], audit: DataFrame, chunk: str
) -> dict[tuple[str, int], Measured]:
    """Runnable keys with their chunk, by group and the order they have reached.

    All groups are numbered at once.  Numbers go on behind those the batch's audit has
    for the group, so later runs of a batch do not use them again.
    """
    runnable = tasks.where(F.col("status").isin(*RUNNABLE) & F.col("group_code").isin(*scope))
    numbered = assign_chunks(runnable, config.groups_frame(tasks.sparkSession))
    # one row per group
    used = audit.groupBy("group_code").agg(F.max(chunk).alias("_used"))
    stage = F.concat_ws("/", F.coalesce("done_order", F.lit(0)), "group_code")
    keys = durable(
        numbered.join(F.broadcast(used), "group_code", "left").select(
            stage.alias("_stage"), "key_no",
            (F.col("chunk_no") + F.coalesce("_used", F.lit(0))).cast("int").alias("chunk_no"),
        )
    )
    # at most as many rows as there are rules
    stages = [r["_stage"] for r in keys.select("_stage").distinct().collect()]
    found = sized_groups(keys, "_stage", stages) if stages else {}
    split = {name: name.split("/", 1) for name in stages}
    return {(code, int(order)): found[name] for name, (order, code) in split.items()}


def run_deletion(
    store: SnapshotStore, config: DeletionConfig, batch_id: str,
    group_code: str | None = None, up_to_order: int | None = None, as_of: str | None = None,
) -> int:
    """Purge what the batch's runnable tasks reach; returns the number of groups.

    Groups run one after another, each on the tables the one before left behind.
    A group's tables, tasks and audit rows change in one commit, so after an
    interruption the same call continues with the groups still open.  A group whose run
    fails leaves its tables as they were and its open tasks FAILED with the message; the
    others run on.
    """
    scope = [g.group_code for g in config.active_groups(group_code=group_code)]
    all_tasks = batch_rows(read_or_empty(store, TASKS, TASK_SCHEMA), batch_id)
    if not scope or all_tasks.isEmpty():
        return 0
    audit = batch_rows(read_or_empty(store, AUDIT, AUDIT_SCHEMA), batch_id)
    stages = chunked_keys(all_tasks, config, scope, audit, "chunk_no")
    done = 0
    for code in scope:
        last = config.root_rule(code).execution_order
        up_to = last if up_to_order is None else min(up_to_order, last)
        # a task partly purged before goes on behind the order it has reached
        orders = sorted(o for c, o in stages if c == code and not o >= up_to > 0)
        try:
            for order in orders:
                _run_stage(store, config, batch_id, code, order, up_to, stages[code, order], as_of)
        except FAILURES as failure:
            record_failure(store, TASKS, batch_id, code, failure)
        else:
            done += bool(orders)
    return done


def _run_stage(
    store: SnapshotStore, config: DeletionConfig, batch_id: str, code: str, order: int,
    up_to: int, keys: Measured, as_of: str | None,
) -> None:
    """Tables, audit and tasks of a group's keys that have reached ``order``, in one commit."""
    last = config.root_rule(code).execution_order
    rules = [r for r in config.rules_of(code, up_to) if r.execution_order > order]
    which = is_runnable(code) & (F.coalesce("done_order", F.lit(0)) == order)
    tasks = batch_rows(store.read(TASKS), batch_id).where(F.col("group_code") == code)
    with store.begin() as change:
        change.note = {"purged_batch": batch_id, "group_code": code}
        writes = []
        if rules:
            reacher = Reacher.over(keys, target_tables(store, rules), as_of)
            entries = _purge_group(change, batch_id, reacher, rules)
            writes.append(partial(change.append, AUDIT, entries, ("batch_id",)))
        tasks = conform(complete_tasks(tasks, which, now(), up_to, last), TASK_SCHEMA)
        writes.append(partial(replace_batch, change, TASKS, tasks, batch_id, code))
        in_parallel(writes)


#: what ends the run of one group only
FAILURES = (PySparkException, Py4JJavaError, ValueError)


def record_failure(
    store: SnapshotStore, table: str, batch_id: str, code: str, failure: Exception
) -> None:
    """Close a group's open tasks as FAILED; nothing else of its run has been committed."""
    tasks = batch_rows(store.read(table), batch_id).where(F.col("group_code") == code)
    message = str(failure).strip()[:MESSAGE_LENGTH]
    new = {"status": F.lit(FAILED), "error_message": F.lit(message), "processed_at": now()}
    which = is_runnable(code)
    failed = tasks.withColumns(
        {name: F.when(which, value).otherwise(F.col(name)) for name, value in new.items()}
    )
    with store.begin() as change:
        change.note = {"failed_batch": batch_id, "group_code": code}
        replace_batch(change, table, conform(failed, TASK_SCHEMA), batch_id, code)


def reopen_failed(store: SnapshotStore, batch_id: str, table: str = TASKS) -> None:
    """Let the next run take failed tasks up again, where they had got to."""
    failed = F.col("status") == FAILED
    status = F.when(F.col("done_order") > 0, F.lit(PARTIAL_COMPLETED)).otherwise(F.lit(VALIDATED))
    tasks = batch_rows(store.read(table), batch_id).withColumns(
        {
            "status": F.when(failed, status).otherwise(F.col("status")),
            "error_message": F.when(~failed, F.col("error_message")),
        }
    )
    with store.begin() as change:
        replace_batch(change, table, conform(tasks, TASK_SCHEMA), batch_id)


def take_requests(
    store: SnapshotStore, config: DeletionConfig, keys: DataFrame, batch_id: str,
    as_of: str | None = None,
) -> int:
    """Add further keys to a batch and validate and estimate these alone.

    Tasks of keys already there are neither looked for again nor rewritten; the counts of
    the new ones are added to the stored estimates.  Items, tasks and estimates are one
    commit, so repeating it adds nothing.  A row that keys of several calls reach counts
    for each of them until the next dry run.  Returns the number of new keys.
    """
    stored = batch_rows(read_or_empty(store, ITEMS, ITEM_SCHEMA), batch_id)
    items = conform(new_items(keys_of(keys), stored, batch_id, now()), ITEM_SCHEMA)
    items = measured(items)
    if not items.rows:
        return 0
    groups = config.groups_frame(store.spark)
    tasks = durable(conform(expand_tasks(items.frame, groups), TASK_SCHEMA))
    scope = [r.group_code for r in group_scope(tasks, groups).collect()]
    estimates = small_frame(store.spark, [], SUMMARY_SCHEMA)
    if scope:
        rules = [r for code in scope for r in config.rules_of(code)]
        tables = target_tables(store, rules)
        tasks = durable(validate_root(tasks, config, tables, scope, as_of))
        sized = dry_run_keys(tasks, scope)
        reachers = {code: Reacher.over(sized[code], tables, as_of) for code in scope}
        estimates = tallied_estimates(prepared_claims(config, reachers))
        estimates = estimates.withColumn("batch_id", F.lit(batch_id)).withColumn("executed_at", now())
    old = conform(batch_rows(read_or_empty(store, SUMMARY, SUMMARY_SCHEMA), batch_id), SUMMARY_SCHEMA)
    ran = batch_rows(read_or_empty(store, TASKS, TASK_SCHEMA), batch_id)
    summary = merged_summary(old, estimates, ran, add=True)
    with store.begin() as change:
        in_parallel(
            [
                partial(change.append, ITEMS, items.frame, ("batch_id",)),
                partial(change.append, TASKS, tasks, ("batch_id", "group_code")),
                partial(replace_batch, change, SUMMARY, summary, batch_id),
            ]
        )
    return items.rows


def _purge_group(
    change: Transaction, batch_id: str, reacher: Reacher, rules: list[DeletionRule]
) -> DataFrame:
    """Write the tables without what the rules reach; returns the audit."""
    started = now()
    reacher.prepare([r.path for r in rules])
    chunks = reacher.keys.select("chunk_no").distinct()

    def rewrite(name: str, members: list[DeletionRule]) -> DataFrame:
        reached = reached_in(change, name, [r.path for r in members], reacher)
        if reached.files:  # if no row is reached, the table stays as it is
            frames = reached.without()
            change.replace_files(name, list(reached.files), frames, reached.at_once())
            reached.release()
        return reached_audit(members, reached, chunks)

    parts = in_parallel(partial(rewrite, n, members) for n, members in by_table(rules).items())
    entries = union_all(parts).withColumns(
        {"batch_id": F.lit(batch_id), "started_at": started, "executed_at": now()}
    )
    return conform(entries, AUDIT_SCHEMA)


def reached_in(
    change: Transaction, name: str, paths: list[KeyPath], reacher: Reacher
) -> Reached:
    """Positions of a stored table's rows that the paths reach."""
    state = change.store.tables(change.number - 1)[name]
    return reached_rows(lambda files: change.store.parts(state, files), paths, reacher)


def certificate(store: SnapshotStore, batch_id: str) -> DataFrame:
    """Certificate of destruction, with whether the purged rows are gone for good.

    A version from before the purge still holds them, so ``older_copies_removed``
    turns true once the store has been expired past it and no adopted folder that
    tables were written from exists any more.  Without a purge it is false.
    """
    audit = batch_rows(store.read(AUDIT), batch_id)
    tasks = batch_rows(store.read(TASKS), batch_id)
    removed = copies_removed(store, "purged_batch", batch_id)
    return reports.certificate(audit, tasks).withColumn("older_copies_removed", F.lit(removed))


def copies_removed(store: SnapshotStore, note: str, batch_id: str) -> bool:
    """Has every copy from before the batch's last commit with this note gone?"""
    commits = store.commits()
    changes = [n for n, body in commits if body.get(note) == batch_id]
    # an expired commit was itself followed by the ones that are left
    return bool(changes) and commits[0][0] >= changes[-1] and not store.left_behind()


def pseudonymise_batch(
    store: SnapshotStore, batch_id: str, salt: str, items: str = ITEMS, tasks: str = TASKS
) -> None:
    """Replace a certified batch's keys by salted hashes.

    The lists of what was erased would otherwise keep the subjects' identifiers.
    Counts and reports of the batch stay as they are.
    """
    hidden = masks.mask_salted_hash("key_no", salt)
    with store.begin() as change:
        for name in (items, tasks):
            rows = batch_rows(store.read(name), batch_id)
            replace_batch(change, name, rows.withColumn("key_no", hidden), batch_id)
