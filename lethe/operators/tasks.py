"""Expansion of keys into tasks, validation and task status."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lethe.config import DeletionConfig, MaskingConfig
from lethe.operators.parallel import in_parallel
from lethe.operators.reach import found_keys
from lethe.operators.sizing import sized_groups

PENDING = "PENDING"
NOT_FOUND = "NOT_FOUND"
VALIDATED = "VALIDATED"
COMPLETED = "COMPLETED"
PARTIAL_COMPLETED = "PARTIAL_COMPLETED"
FAILED = "FAILED"
RUNNABLE = (VALIDATED, PARTIAL_COMPLETED)  # what a run picks up
STATUSES = (PENDING, NOT_FOUND, VALIDATED, COMPLETED, PARTIAL_COMPLETED, FAILED)

TASK_KEY = ["batch_id", "group_code", "key_no"]
TASK_SCHEMA = (
    "batch_id string, key_type string, group_code string, key_no string, status string, "
    "error_message string, processed_at timestamp, created_at timestamp, done_order int"
)


def expand_tasks(
    items: DataFrame, groups: DataFrame, existing: DataFrame | None = None,
    key_type: str | None = None, group_code: str | None = None,
) -> DataFrame:
    """One PENDING task per key and active group of its key type, new ones only."""
    active = groups.where("is_active").select("group_code", "key_type")
    if key_type is not None:
        items = items.where(F.col("key_type") == key_type)
    if group_code is not None:
        active = active.where(F.col("group_code") == group_code)
    # groups are configuration: bounded by MAX_CONFIG_ROWS
    tasks = items.join(F.broadcast(active), "key_type").select(
        "batch_id", "key_type", "group_code", "key_no",
        F.lit(PENDING).alias("status"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit(None).cast("timestamp").alias("processed_at"),
        F.col("created_at"),
        F.lit(0).alias("done_order"),
    )
    if existing is not None:
        tasks = tasks.join(existing.select(*TASK_KEY), TASK_KEY, "left_anti")
    return tasks


def first_rule(rules: DataFrame, *order: Column) -> DataFrame:
    """Top rule per group by the given order (``desc`` for deletion's root)."""
    ranked = Window.partitionBy("group_code").orderBy(*order)
    return rules.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def relabel(
    tasks: DataFrame, found: DataFrame, from_statuses: tuple[str, ...]
) -> DataFrame:
    """VALIDATED or NOT_FOUND for tasks in ``from_statuses``; ``found`` has (group, key)."""
    hits = found.select("group_code", "key_no", F.lit(True).alias("_found"))
    status = F.when(F.col("_found"), F.lit(VALIDATED)).otherwise(F.lit(NOT_FOUND))
    open_task = F.col("status").isin(*from_statuses)
    return (
        tasks.join(hits, ["group_code", "key_no"], "left")
        .withColumn("status", F.when(open_task, status).otherwise(F.col("status")))
        .select(*tasks.columns)
    )


def _found(config, rule_of, tasks, tables, from_statuses, as_of) -> DataFrame | None:
    codes = sorted({r.group_code for r in config.rules})
    rules = {code: rule for code in codes if (rule := rule_of(code)) is not None}
    if not rules:
        return None
    open_tasks = tasks.where(F.col("status").isin(*from_statuses))
    keys = sized_groups(open_tasks.select("group_code", "key_no"), "group_code", list(rules))

    def hits(code: str) -> DataFrame:
        rule = rules[code]
        found = found_keys(rule.path, tables[rule.target_table], keys[code], tables, as_of)
        return found.select(F.lit(code).alias("group_code"), "key_no")

    return reduce(DataFrame.unionByName, in_parallel(partial(hits, code) for code in rules))


def validate_root(
    tasks: DataFrame, config: DeletionConfig, tables: dict[str, DataFrame],
    group_codes: list[str] | None = None, as_of: str | None = None, revalidate: bool = False,
) -> DataFrame:
    """Label PENDING tasks by whether the group's root rule reaches a row.

    ``tasks`` should be durable: they are sized, searched and labelled.
    """
    statuses = (PENDING, NOT_FOUND) if revalidate else (PENDING,)

    def rule_of(code):
        return config.root_rule(code) if group_codes is None or code in group_codes else None

    return _validated(tasks, config, tables, rule_of, statuses, group_codes, as_of)


def validate_first(
    tasks: DataFrame, config: MaskingConfig, tables: dict[str, DataFrame],
    group_codes: list[str] | None = None, as_of: str | None = None,
) -> DataFrame:
    """Label PENDING and NOT_FOUND tasks by the group's lowest-order active rule."""

    def rule_of(code):
        if group_codes is not None and code not in group_codes:
            return None
        rules = config.rules_of(code)
        return rules[0] if rules else None

    return _validated(tasks, config, tables, rule_of, (PENDING, NOT_FOUND), group_codes, as_of)


def _validated(tasks, config, tables, rule_of, statuses, group_codes, as_of):
    found = _found(config, rule_of, tasks, tables, statuses, as_of)
    if found is None:
        return tasks
    if group_codes is None:
        return relabel(tasks, found, statuses)
    chosen = F.col("group_code").isin(*group_codes)
    return relabel(tasks.where(chosen), found, statuses).unionByName(tasks.where(~chosen))


def group_scope(tasks: DataFrame, groups: DataFrame, status: str | None = None) -> DataFrame:
    """Active groups that have tasks (of a status), by code."""
    if status is not None:
        tasks = tasks.where(F.col("status") == status)
    # each task partition contributes a group at most once before the shuffle
    with_tasks = tasks.select("group_code").distinct()
    return (
        groups.where("is_active").join(with_tasks, "group_code", "left_semi").orderBy("group_code")
    )


def is_runnable(group_code: str, done_order: int | None = None) -> Column:
    """Tasks a run picks up: validated ones and those a partial run left open."""
    test = (F.col("group_code") == group_code) & F.col("status").isin(*RUNNABLE)
    return test if done_order is None else test & (F.col("done_order") == done_order)


def complete_tasks(
    tasks: DataFrame, which: Column, processed_at: Column, done_order: int, last_order: int
) -> DataFrame:
    """Close the tasks in ``which``, having applied the rules up to ``done_order``."""
    status = F.lit(COMPLETED if done_order >= last_order else PARTIAL_COMPLETED)
    new = {"processed_at": processed_at, "status": status, "done_order": F.lit(done_order)}
    return tasks.withColumns(
        {name: F.when(which, value).otherwise(F.col(name)) for name, value in new.items()}
    )


def missing_keys(tasks: DataFrame, rules: DataFrame) -> DataFrame:
    """NOT_FOUND tasks with the root table they were looked for in."""
    root = first_rule(rules, F.col("execution_order").desc()).select(
        "group_code", F.col("target_table").alias("root_target_table")
    )
    return (
        tasks.where(F.col("status") == NOT_FOUND)
        .join(F.broadcast(root), "group_code")
        .select("root_target_table", "key_type", "key_no", "status", "created_at")
        .orderBy("root_target_table", "key_no")
    )
