"""Checks to run before (and after) a batch: data and configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.config import DeletionConfig, MaskingConfig, MaskingRule, Relation
from lethe.operators.masking import bind_parameters
from lethe.operators.maskpass import MaskClaim, masked_pairs, per_rule
from lethe.operators.purge import union_all
from lethe.operators.reach import Reacher, guarded_match
from lethe.operators.sizing import VALUE, Measured, keyed_join, measured

SHORT_COLUMN = 20  # declared lengths below this deserve a look for fn_mask_ output


def unique_collisions(
    masked: DataFrame, rules: list[MaskingRule], unique_columns: list[str]
) -> DataFrame:
    """Per declared-unique masked column: values that now occur more than once.

    Checked over the whole table after masking, since a mask may also collide
    with an unmasked row.
    """
    parts = []
    for rule in rules:
        if rule.column_name not in unique_columns:
            continue
        value = F.col(rule.column_name)
        repeated = (
            masked.where(value.isNotNull())
            .groupBy(value.cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("occurrences"))
            .where("occurrences > 1")
        )
        parts.append(
            repeated.select(
                F.lit(rule.group_code).alias("group_code"),
                F.lit(rule.target_table).alias("target_table"),
                F.lit(rule.column_name).alias("column_name"),
                "value",
                "occurrences",
            )
        )
    return union_all(parts)


def column_status(
    config: MaskingConfig, tables: dict[str, DataFrame],
    declared_lengths: dict[tuple[str, str], int] | None = None,
) -> list[tuple[str, str, str, str]]:
    """(group, table, column, status) of every active rule, from the schemas alone."""
    lengths = declared_lengths or {}
    found = []
    for rule in config.rules:
        if not rule.is_active:
            continue
        frame = tables.get(rule.target_table)
        limit = lengths.get((rule.target_table, rule.column_name))
        if frame is None or rule.column_name not in frame.columns:
            status = "ERROR: target column does not exist"
        elif limit is not None and limit < SHORT_COLUMN and "fn_mask_" in rule.mask_expression:
            status = f"WARNING: length {limit} may be too short for masked output"
        else:
            status = "OK"
        found.append((rule.group_code, rule.target_table, rule.column_name, status))
    return found


def mask_lengths(
    claims: list[MaskClaim], limits: dict[str, int], parameters=None
) -> DataFrame:
    """Longest masked value per rule against the declared length of its column."""
    pairs = _pairs(claims, parameters)
    found = per_rule(claims, pairs, {"longest_mask": F.max(F.length("after"))})
    declared = {c: n for c, n in limits.items() if n is not None}
    limit = F.lit(None).cast("int")
    for column, length in declared.items():
        limit = F.when(F.col("column_name") == column, F.lit(length)).otherwise(limit)
    return found.withColumn("declared_length", limit).withColumn(
        "too_long", F.coalesce(F.col("longest_mask") > F.col("declared_length"), F.lit(False))
    )


def unmasked_leaks(claims: list[MaskClaim], parameters=None) -> DataFrame:
    """Per rule: reached values the mask leaves as they are, or whose digits it shows."""

    def digits(text: Column) -> Column:
        return F.regexp_replace(text, "[^0-9]", "")

    same = F.col("before") == F.col("after")
    shown = (digits(F.col("before")) != "") & F.contains(
        digits(F.col("after")), digits(F.col("before"))
    )
    numbers = {
        "checked_values": F.count("before"),
        "unchanged_values": F.count(F.when(same, 1)),
        "digits_shown": F.count(F.when(shown, 1)),
    }
    return per_rule(claims, _pairs(claims, parameters), numbers).na.fill(0, list(numbers))


def _pairs(claims: list[MaskClaim], parameters) -> DataFrame:
    """All reached rows' pairs, one scan per table."""
    return masked_pairs(claims, lambda rule: bind_parameters(rule.mask_expression, parameters))


def referenced_columns(rules: DataFrame, relations: DataFrame) -> DataFrame:
    """Masked columns another table refers to; only a deterministic mask keeps the link."""
    masked = rules.where("is_active").select(
        "group_code",
        F.col("target_table").alias("parent_table"),
        F.col("column_name").alias("parent_col"),
        "mask_expression",
    )
    steady = F.col("mask_expression").contains("fn_mask_salted_hash")
    return masked.join(relations, ["parent_table", "parent_col"]).select(
        "group_code", "parent_table", "parent_col", "child_table", "child_col",
        steady.alias("deterministic"),
    )


def orphans(relation: Relation, tables: dict[str, DataFrame]) -> DataFrame:
    """Child rows whose parent is gone: (relation columns, orphan_rows).

    Children are counted per reference first, so a reference held by a third of
    all rows is compared with its parent once.
    """
    refs = (
        tables[relation.child_table]
        .where(F.col(relation.child_col).isNotNull())
        .groupBy(F.col(relation.child_col).alias("_ref"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    parents = tables[relation.parent_table].select(F.col(relation.parent_col).alias("_ref"))
    return refs.join(parents, "_ref", "left_anti").agg(
        F.lit(relation.child_table).alias("child_table"),
        F.lit(relation.child_col).alias("child_col"),
        F.lit(relation.parent_table).alias("parent_table"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows"),
    )


def cascade_scope(
    config: DeletionConfig, group_code: str, relations: list[Relation], reacher: Reacher
) -> DataFrame:
    """Children, grandchildren, ... of a group's tables that no rule of the group purges.

    With the number of their rows that refer to a row that would go, by a rule or along
    the declared relations: under a cascade they would go along, without one they would
    be orphaned.  A round follows only the references that the round before added, so
    relations may form cycles.
    """
    rules = config.rules_of(group_code)
    reacher.prepare([r.path for r in rules])
    purged: dict[str, list] = {}
    for rule in rules:
        purged.setdefault(rule.target_table, []).append(rule)
    outside = [r for r in relations if r.child_table not in purged]
    # referenced column of a table -> its values in rows that would go
    known: dict[tuple[str, str], Measured] = {}
    new: dict[tuple[str, str], Measured] = {}
    for place in dict.fromkeys((r.parent_table, r.parent_col) for r in outside):
        if place[0] in purged:
            new[place] = known[place] = measured(_doomed_values(purged[place[0]], place[1], reacher))
    while new:
        grown: dict[tuple[str, str], list[DataFrame]] = {}
        for relation in outside:
            added = new.get((relation.parent_table, relation.parent_col))
            if added is None or not added.rows:
                continue
            child = reacher.tables[relation.child_table]
            for place in known.keys() | {(r.parent_table, r.parent_col) for r in outside}:
                if place[0] == relation.child_table:
                    gone = child.select(F.col(relation.child_col).alias("_ref"), F.col(place[1]).alias("_to"))
                    gone = keyed_join(gone, F.col("_ref"), added, "left_semi")
                    found = gone.where("_to is not null").select(F.col("_to").alias(VALUE)).distinct()
                    grown.setdefault(place, []).append(found)
        new = {}
        for place, parts in grown.items():
            fresh = union_all(parts).distinct()
            if place in known:
                fresh = fresh.select(F.col(VALUE).alias("_to"))
                fresh = keyed_join(fresh, F.col("_to"), known[place], "left_anti")
                fresh = fresh.select(F.col("_to").alias(VALUE))
            fresh = measured(fresh)
            if fresh.rows:
                new[place] = fresh
                every = [known[place].frame] if place in known else []
                known[place] = measured(union_all([*every, fresh.frame]))
    parts = []
    for relation in outside:
        doomed = known.get((relation.parent_table, relation.parent_col))
        if doomed is None:
            continue
        child = reacher.tables[relation.child_table].select(F.col(relation.child_col).alias("_ref"))
        # counted per reference first, so a hot one travels as one row
        refs = child.where("_ref is not null").groupBy("_ref").agg(F.count(F.lit(1)).alias("_n"))
        parts.append(
            keyed_join(refs, F.col("_ref"), doomed, "left_semi").agg(
                F.lit(group_code).alias("group_code"),
                F.lit(relation.parent_table).alias("parent_table"),
                F.lit(relation.child_table).alias("child_table"),
                F.lit(relation.child_col).alias("child_col"),
                F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_outside_rules"),
            )
        )
    return union_all(parts)


def _doomed_values(rules: list, column: str, reacher: Reacher) -> DataFrame:
    """Values of a column in the rows of a table that its rules reach."""
    parts = []
    for rule in rules:
        rows = reacher.tables[rule.target_table].select(
            match_of(rule, reacher).alias("_key"), F.col(column).alias("_to")
        )
        rows = keyed_join(rows, F.col("_key"), reacher.values(rule.path), "left_semi")
        parts.append(rows.where("_to is not null").select(F.col("_to").alias(VALUE)))
    return union_all(parts).distinct()


def match_of(rule, reacher: Reacher) -> Column:
    return guarded_match(rule.path, reacher.as_of)


def rule_order_conflicts(config: DeletionConfig) -> list[tuple[str, int, str, int, str]]:
    """(group, order, table, earlier order, hop table): a path needs rows purged before it."""
    found = []
    for group in config.groups:
        rules = config.rules_of(group.group_code)
        for rule in rules:
            for hop in rule.path.hops:
                for earlier in rules:
                    if (
                        earlier.target_table == hop.parent_table
                        and earlier.execution_order < rule.execution_order
                    ):
                        found.append(
                            (
                                group.group_code, rule.execution_order, rule.target_table,
                                earlier.execution_order, hop.parent_table,
                            )
                        )
    return found


def overlapping_groups(groups: DataFrame, rules: DataFrame) -> DataFrame:
    """Tables that several active groups of one key type purge.

    Groups are listed per (key type, table); pairs are never formed.
    """
    active = groups.where("is_active").select("group_code", "key_type")
    return (
        rules.select("group_code", "target_table")
        .join(active, "group_code")
        .groupBy("key_type", "target_table")
        .agg(F.array_join(F.sort_array(F.collect_set("group_code")), ", ").alias("group_codes"),
             F.count_distinct("group_code").alias("group_count"))
        .where("group_count > 1")
        .select("key_type", "target_table", "group_codes", "group_count")
    )
