"""Deletion: estimates, survivors and audit of a group's rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.config import DeletionRule
from lethe.operators.positions import Reached, parts_of_frame, reached_rows
from lethe.operators.reach import Reacher, eligible, guarded_match, match_column
from lethe.operators.sizing import keyed_join, matched_counts
from lethe.operators.tally import tallied_audit, tallied_estimates


def _rule_columns(rule: DeletionRule) -> list[Column]:
    return [
        F.lit(rule.group_code).alias("group_code"),
        F.lit(rule.target_table).alias("target_table"),
        F.lit(rule.execution_order).alias("execution_order"),
    ]


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def doomed_counts(rule: DeletionRule, reacher: Reacher) -> DataFrame:
    """Rows the rule reaches, per chunk: (chunk_no, row_count)."""
    target = eligible(reacher.tables[rule.target_table], rule.path, reacher.as_of)
    values = reacher.values(rule.path)
    return matched_counts(target, match_column(rule.path), values, ["chunk_no"])


def estimate_delete(rules: list[DeletionRule], reacher: Reacher) -> DataFrame:
    """Rows to delete per rule; a rule that reaches nothing counts 0."""
    reacher.prepare([r.path for r in rules])
    return tallied_estimates([(r, reacher) for r in rules])


def survivors(rules: list[DeletionRule], reacher: Reacher) -> DataFrame:
    """A target table without the rows its rules reach.

    An anti join, so rows whose join value is NULL (or whose condition is not
    known to hold) stay, as they would after a SQL DELETE.  If the values are too many
    to be broadcast, the rows to leave out are found by position first, so that only
    join columns are shuffled.
    """
    kept = reacher.tables[rules[0].target_table]
    reacher.prepare([r.path for r in rules])
    parts_of = parts_of_frame(kept)
    if parts_of and not all(reacher.values(r.path).broadcastable() for r in rules):
        reached = reached_rows(parts_of, [r.path for r in rules], reacher)
        if not reached.files:
            return kept
        rest = kept.where(~F.col("_metadata.file_path").isin(list(reached.files)))
        return union_all([rest, *reached.without()])
    for rule in rules:
        match = guarded_match(rule.path, reacher.as_of)
        kept = keyed_join(kept, match, reacher.values(rule.path), "left_anti")
    return kept


def by_table(rules: list[DeletionRule]) -> dict[str, list[DeletionRule]]:
    """Rules per target table, tables in the order of their first rule."""
    grouped: dict[str, list[DeletionRule]] = {}
    for rule in rules:
        grouped.setdefault(rule.target_table, []).append(rule)
    return grouped


def reached_audit(
    rules: list[DeletionRule], reached: Reached, chunks: DataFrame
) -> DataFrame:
    """Deleted rows per chunk and rule on one table, from the positions found before."""
    claims = []
    for rule in rules:
        chunk = F.col(reached.mark(rule.path))
        order = F.lit(rule.execution_order).alias("execution_order")
        claims.append(F.when(chunk.isNotNull(), F.struct(chunk.alias("chunk_no"), order)))
    counted = (
        reached.rows.select(F.array_min(F.array_compact(F.array(*claims))).alias("by"))
        .groupBy("by.execution_order", "by.chunk_no")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    described = F.array(*[F.struct(*_rule_columns(rule)) for rule in rules])
    return (
        chunks.select("chunk_no", F.inline(described))
        .join(counted, ["execution_order", "chunk_no"], "left")
        .select(
            "group_code", "target_table", "execution_order", "chunk_no",
            F.coalesce("row_count", F.lit(0)).alias("deleted_row_count"),
        )
    )


def purge_audit(rules: list[DeletionRule], reacher: Reacher) -> DataFrame:
    """Deleted rows per chunk and rule, zeros included.

    A row several rules reach is deleted once: by the earliest chunk, and in it by
    the lowest order.
    """
    reacher.prepare([r.path for r in rules])
    return tallied_audit([(r, reacher) for r in rules])
