"""Counts of reached rows for many rules at once: one scan per table.

All rules that compare the same column of a table share one probe set: every reached
value once, with the list of (group, rule, chunk) that reach it.  A table is scanned
once, its rows meet the probe sets of all its join columns, and what they carry is
counted.  The list of a value is as long as the configuration makes it, not as the data.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.config import DeletionRule, KeyPath, small_frame
from lethe.operators.probes import probe
from lethe.operators.reach import Reacher, guarded_match
from lethe.operators.sizing import VALUE, Measured, keyed_join

#: a rule with the values its keys reach
Claim = tuple[DeletionRule, Reacher]
_TALLY = "_no int, chunk_no int, row_count bigint"


def _compared(path: KeyPath) -> KeyPath:
    """What two paths must have in common to share a probe set."""
    plain = not path.hops
    return KeyPath(
        path.join_column, path.cast if plain else None, (), path.where, plain and path.ignore_case
    )


def _of_group(by: Column, group: int) -> Column:
    return F.filter(by, lambda x: x["of"] == group)


def _table_tally(numbered: list[tuple[int, Claim]], once: bool) -> DataFrame:
    """(_no, chunk_no, row_count) of one table's rules."""
    groups = {code: i for i, code in enumerate(dict.fromkeys(r.group_code for _, (r, _) in numbered))}
    probes: dict[tuple, list[tuple[int, int, Measured]]] = {}
    matches: dict[tuple, Column] = {}
    for number, (rule, reacher) in numbered:
        values = reacher.values(rule.path)
        kind = values.frame.schema[VALUE].dataType.simpleString()
        key = (_compared(rule.path), reacher.as_of if rule.path.where else None, kind)
        probes.setdefault(key, []).append((number, groups[rule.group_code], values))
        matches.setdefault(key, guarded_match(rule.path, reacher.as_of))
    rule, reacher = numbered[0][1]
    table = reacher.tables[rule.target_table]
    rows = table.select(*[m.alias(f"_match{i}") for i, m in enumerate(matches.values())])
    sets = [probe(members) for members in probes.values()]
    near = [s.in_range(F.col(f"_match{i}"), rows) for i, s in enumerate(sets)]
    rows = rows.where(reduce(or_, near))
    if all(s.broadcastable() for s in sets):
        rows = rows.withColumn("_n", F.lit(1).cast("long"))
    else:
        # a hot value is counted before it travels
        rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    for i, values in enumerate(sets):
        rows = keyed_join(rows, F.col(f"_match{i}"), values, "left").withColumnRenamed("_by", f"_by{i}")
    lists = [F.coalesce(f"_by{i}", F.array().cast(sets[0].frame.schema["_by"].dataType)) for i in range(len(sets))]
    by = F.concat(*lists)
    if once:
        # a row that several rules of a group reach counts for the earliest chunk, then order
        counts: dict[str, int] = {}
        for _, (rule, _) in numbered:
            counts[rule.group_code] = counts.get(rule.group_code, 0) + 1
        several = [groups[code] for code, n in counts.items() if n > 1]
        alone = F.filter(by, lambda x: ~x["of"].isin(several)) if several else by
        firsts = [F.array_min(_of_group(by, group)) for group in several]
        by = F.concat(alone, F.array_compact(F.array(*firsts))) if several else by
    return (
        rows.select("_n", F.explode(by).alias("_by"))
        .groupBy(F.col("_by.no").alias("_no"), F.col("_by.chunk_no").alias("chunk_no"))
        .agg(F.sum("_n").alias("row_count"))
    )


def tally(claims: list[Claim], once: bool = False) -> tuple[DataFrame, DataFrame]:
    """Reached rows per rule and chunk, and the rules: (_no, chunk_no, row_count), (_no, ...).

    ``once``: a row counts once for its group, as a deletion would find it.
    """
    # numbers follow the order of execution, which decides between rules of one chunk
    numbered = list(enumerate(sorted(claims, key=lambda c: c[0].execution_order)))
    tables: dict[str, list[tuple[int, Claim]]] = {}
    for number, claim in numbered:
        tables.setdefault(claim[0].target_table, []).append((number, claim))
    counts = reduce(
        DataFrame.unionByName, [_table_tally(members, once) for members in tables.values()]
    )
    spark = counts.sparkSession
    rows = [(n, r.group_code, r.target_table, r.execution_order) for n, (r, _) in numbered]
    rules = small_frame(
        spark, rows, "_no int, group_code string, target_table string, execution_order int"
    )
    return counts, rules


def tallied_estimates(claims: list[Claim]) -> DataFrame:
    """Rows to delete per rule; a rule that reaches nothing counts 0."""
    counts, rules = tally(claims)
    total = counts.groupBy("_no").agg(F.sum("row_count").alias("_n"))
    # one row per rule on both sides
    return rules.join(F.broadcast(total), "_no", "left").select(
        "group_code", "target_table", "execution_order",
        F.coalesce("_n", F.lit(0)).alias("estimated_rows_to_delete"),
    )


def tallied_audit(claims: list[Claim]) -> DataFrame:
    """Deleted rows per rule and chunk, zeros included; groups as if each ran alone."""
    counts, rules = tally(claims, once=True)
    keys = {rule.group_code: reacher.keys for rule, reacher in claims}
    chunks = reduce(
        DataFrame.unionByName,
        [
            frame.select(F.col("chunk_no").cast("int").alias("chunk_no")).distinct()
            .select(F.lit(code).alias("group_code"), "chunk_no")
            for code, frame in keys.items()
        ],
    )
    return (
        chunks.join(F.broadcast(rules), "group_code")
        .join(counts, ["_no", "chunk_no"], "left")
        .select(
            "group_code", "target_table", "execution_order", "chunk_no",
            F.coalesce("row_count", F.lit(0)).alias("deleted_row_count"),
        )
    )
