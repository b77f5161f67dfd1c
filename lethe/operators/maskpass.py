"""All mask rules of a table tried in one scan: previews, lengths and leaks.

A table is scanned once for all rules and groups: its rows meet the reached values of
every distinct path, and a reached row gives one (before, after) pair per rule.  What is
made of the pairs is aggregated per rule; samples keep the smallest few per task first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from lethe.config import MaskingRule, small_frame
from lethe.operators.reach import Reacher, guarded_match
from lethe.operators.sizing import keyed_join

#: a rule with the values its keys reach
MaskClaim = tuple[MaskingRule, Reacher]
NO, NUMBER, TEXT = "_no", "_number", "_text"
_RULE = "_no int, group_code string, target_table string, column_name string"


def claimed_rules(claims: list[MaskClaim]) -> DataFrame:
    rows = [(n, r.group_code, r.target_table, r.column_name) for n, (r, _) in enumerate(claims)]
    return small_frame(claims[0][1].keys.sparkSession, rows, _RULE)


def _table_pairs(numbered: list[tuple[int, MaskClaim]], masked) -> DataFrame:
    rule, reacher = numbered[0][1]
    table = reacher.tables[rule.target_table]
    marks: dict[tuple, str] = {}
    values = {}
    for _, (rule, reacher) in numbered:
        key = (id(reacher), rule.path)
        if key not in marks:
            marks[key] = f"_match{len(marks)}"
            values[key] = reacher.values(rule.path)
    as_of = {id(reacher): reacher.as_of for _, (_, reacher) in numbered}
    rows = table.withColumns({name: guarded_match(k[1], as_of[k[0]]) for k, name in marks.items()})
    near = [values[k].in_range(F.col(name), rows) for k, name in marks.items()]
    rows = rows.where(reduce(lambda a, b: a | b, near))
    for key, name in marks.items():
        rows = keyed_join(rows, F.col(name), values[key], "left")
        rows = rows.withColumn(f"_hit{name}", F.col("chunk_no").isNotNull()).drop("chunk_no")
    entries = []
    for number, (rule, reacher) in numbered:
        name = marks[(id(reacher), rule.path)]
        whole = isinstance(rows.schema[name].dataType, IntegralType)
        entry = F.struct(
            F.lit(number).alias(NO),
            (F.col(name) if whole else F.lit(None)).cast("long").alias(NUMBER),
            (F.lit(None) if whole else F.col(name)).cast("string").alias(TEXT),
            F.col(rule.column_name).cast("string").alias("before"),
            masked(rule).cast("string").alias("after"),
        )
        # the expression sees reached rows only
        entries.append(F.when(F.col(f"_hit{name}"), entry))
    # SQL functions are resolved in a projection only
    made = rows.select(F.array_compact(F.array(*entries)).alias("_entries"))
    return made.select(F.inline("_entries"))


def masked_pairs(claims: list[MaskClaim], masked) -> DataFrame:
    """(_no, _number, _text, before, after) per rule and reached row, one scan per table.

    ``masked`` gives a rule's expression as a column; ``_number`` or ``_text`` is the
    join value of the row.
    """
    tables: dict[str, list[tuple[int, MaskClaim]]] = {}
    for number, claim in enumerate(claims):
        tables.setdefault(claim[0].target_table, []).append((number, claim))
    return reduce(
        DataFrame.unionByName, [_table_pairs(members, masked) for members in tables.values()]
    )


def smallest_samples(pairs: DataFrame, most: int) -> DataFrame:
    """The first pairs of every rule by join value and text, numbered from 1."""
    order = Window.partitionBy(NO).orderBy(NUMBER, TEXT, "before", "after")
    found = pairs.where(F.col("before").isNotNull())
    found = found.withColumn("sample_index", F.row_number().over(order))
    return found.where(F.col("sample_index") <= most).select(NO, "sample_index", "before", "after")


def per_rule(claims: list[MaskClaim], pairs: DataFrame, numbers: dict[str, Column]) -> DataFrame:
    """Aggregates of each rule's pairs; a rule that reaches nothing has none of them."""
    found = pairs.groupBy(NO).agg(*[c.alias(name) for name, c in numbers.items()])
    # one row per rule on both sides
    return claimed_rules(claims).join(F.broadcast(found), NO, "left").drop(NO)
