"""Masking: estimates, previews, the rewrite and its audit."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.config import KeyPath, MaskingRule
from lethe.operators.maskpass import (
    NO,
    MaskClaim,
    claimed_rules,
    masked_pairs,
    smallest_samples,
)
from lethe.operators.parallel import in_parallel
from lethe.operators.positions import Reached, mark_name, parts_of_frame, reached_rows
from lethe.operators.purge import union_all
from lethe.operators.reach import Reacher, eligible, guarded_match, match_column
from lethe.operators.sizing import keyed_join, matched_counts

PREVIEW_ROWS = 5
PREVIEW_SCHEMA = "array<struct<before:string,after:string>>"
# quoted text, or a parameter; a colon behind a value is a path into a variant
_PARAMETER = re.compile(
    r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|(?<![\w:)\]'"`]):([A-Za-z_]\w*)"""
)


def bind_parameters(expression: str, parameters: dict[str, str] | None) -> Column:
    """Mask expression with ``:name`` replaced by a string literal.

    Secrets such as salts are passed this way, so the expression that is stored
    in summaries does not contain them.
    """

    def literal(found: re.Match) -> str:
        name = found.group(1)
        if name is None:
            return found.group(0)
        if name not in parameters:
            raise ValueError(f"mask parameter :{name} was not given")
        value = parameters[name].replace("\\", "\\\\").replace("'", "\\'")
        return f"'{value}'"

    return F.expr(_PARAMETER.sub(literal, expression) if parameters else expression)


@dataclass(frozen=True)
class MaskStep:
    """Rules of one (table, path, order): they make up one composite update."""

    target_table: str
    path: KeyPath
    execution_order: int
    rules: tuple[MaskingRule, ...]

    @property
    def columns_masked(self) -> str:
        return ", ".join(sorted(r.column_name for r in self.rules))


def mask_steps(rules: list[MaskingRule]) -> list[MaskStep]:
    """Composite updates in the order they apply."""
    grouped: dict[tuple, list[MaskingRule]] = {}
    for rule in rules:
        key = (rule.execution_order, rule.target_table, rule.path)
        grouped.setdefault(key, []).append(rule)
    return [
        MaskStep(table, path, order, tuple(members))
        for (order, table, path), members in sorted(
            grouped.items(), key=lambda kv: (kv[0][0], kv[0][1], kv[0][2].to_json())
        )
    ]


def rule_grouping(rules: DataFrame, max_order: int | None = None) -> DataFrame:
    """The same grouping over a rules table, with the merged SET and column lists."""
    active = rules.where("is_active")
    if max_order is not None:
        active = active.where(F.col("execution_order") <= max_order)
    return active.groupBy("group_code", "target_table", "key_path", "execution_order").agg(
        F.expr(
            "listagg(column_name || ' = (' || mask_expression || ')', ', ') "
            "within group (order by column_name)"
        ).alias("set_clause"),
        F.expr("listagg(column_name, ', ') within group (order by column_name)").alias(
            "columns_masked"
        ),
    )


def estimate_mask(rules: list[MaskingRule], reacher: Reacher) -> DataFrame:
    """Rows to mask per rule; columns that share a path share one count."""
    reacher.prepare([r.path for r in rules])
    parts = []
    for step in mask_steps(rules):
        target = eligible(reacher.tables[step.target_table], step.path, reacher.as_of)
        counted = matched_counts(
            target, match_column(step.path), reacher.values(step.path), ["chunk_no"]
        ).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("estimated_rows_to_mask"))
        described = F.array(
            *[
                F.struct(
                    F.lit(r.group_code).alias("group_code"),
                    F.lit(r.target_table).alias("target_table"),
                    F.lit(r.column_name).alias("column_name"),
                    F.lit(r.execution_order).alias("execution_order"),
                    F.lit(r.mask_expression).alias("mask_expression"),
                )
                for r in step.rules
            ]
        )
        parts.append(counted.select(F.inline(described), "estimated_rows_to_mask"))
    return union_all(parts)


def preview_samples(
    claims: list[MaskClaim], parameters: dict[str, str] | None = None
) -> DataFrame:
    """(group_code, target_table, column_name, sample_index, before, after) of several rules.

    Up to five reached rows with a value per rule, by join value and text, so a preview
    can be repeated.  One scan per table.
    """
    pairs = masked_pairs(claims, lambda rule: bind_parameters(rule.mask_expression, parameters))
    samples = smallest_samples(pairs, PREVIEW_ROWS)
    return samples.join(F.broadcast(claimed_rules(claims)), NO).drop(NO)


def mask_preview(
    rules: list[MaskingRule], reacher: Reacher, parameters: dict[str, str] | None = None
) -> DataFrame:
    """(group_code, target_table, column_name, sample_preview) per rule.

    A rule whose expression cannot be analysed or fails on the data gives a warning and
    an empty preview.  All rules are tried together; only if that fails is each tried on
    its own.
    """
    reacher.prepare([r.path for r in rules])

    def attempt(some: list[MaskingRule]) -> list:
        # at most PREVIEW_ROWS rows a rule come back
        found = preview_samples([(r, reacher) for r in some], parameters)
        return found.orderBy("sample_index").collect()

    def alone(rule: MaskingRule) -> list:
        try:
            return attempt([rule])
        except (PySparkException, Py4JJavaError, ValueError) as failure:
            warnings.warn(
                f"no preview for {rule.target_table}.{rule.column_name}: {failure}", stacklevel=2
            )
            return []

    try:
        found = attempt(rules)
    except (PySparkException, Py4JJavaError, ValueError):
        found = [row for rows in in_parallel(partial(alone, rule) for rule in rules) for row in rows]
    pairs: dict[tuple, list] = {(r.group_code, r.target_table, r.column_name): [] for r in rules}
    for row in found:
        pairs[row["group_code"], row["target_table"], row["column_name"]].append(
            (row["before"], row["after"])
        )
    return reacher.keys.sparkSession.createDataFrame(
        [(*key, samples) for key, samples in pairs.items()],
        "group_code string, target_table string, column_name string, "
        f"sample_preview {PREVIEW_SCHEMA}",
    )


def preview_unpack(summary: DataFrame) -> DataFrame:
    """One row per sample, numbered from 1."""
    kept = [c for c in summary.columns if c != "sample_preview"]
    return summary.select(*kept, F.posexplode("sample_preview").alias("_at", "_pair")).select(
        *kept,
        (F.col("_at") + 1).alias("sample_index"),
        F.col("_pair.before").alias("sample_original_value"),
        F.col("_pair.after").alias("sample_masked_value"),
    )


def mask_apply(
    target: DataFrame, steps: list[MaskStep], reacher: Reacher,
    parameters: dict[str, str] | None = None,
) -> DataFrame:
    """The target with reached rows masked; every other row as it was.

    All hits are marked first, on the unmasked columns, so masking a column that
    is itself a join key hides nothing from later steps.  Each step is one
    projection whose expressions all see the row as the step found it.
    """
    paths = list(dict.fromkeys(s.path for s in steps))
    reacher.prepare(paths)
    parts_of = parts_of_frame(target)
    if parts_of and not all(reacher.values(p).broadcastable() for p in paths):
        # too many values to broadcast: find positions first, so that rows do not move
        reached = reached_rows(parts_of, paths, reacher)
        if not reached.files:
            return target
        rest = target.where(~F.col("_metadata.file_path").isin(list(reached.files)))
        return union_all([rest, *masked_files(reached, steps, parameters)])
    marked = target
    for number, path in enumerate(paths):
        match = guarded_match(path, reacher.as_of)
        marked = keyed_join(marked, match, reacher.values(path), "left")
        marked = marked.withColumn(mark_name(number), F.col("chunk_no").isNotNull())
        marked = marked.drop("chunk_no")
    return _masked(marked, steps, paths, parameters).select(*target.columns)


def masked_files(
    reached: Reached, steps: list[MaskStep], parameters: dict[str, str] | None = None
) -> Iterator[DataFrame]:
    """The files that hold reached rows, masked, slice by slice."""
    marks = {reached.mark(p): F.col(reached.mark(p)).isNotNull() for p in reached.paths}
    for marked in reached.with_marks(marks):
        yield _masked(marked, steps, reached.paths, parameters).drop(*marks)


def _masked(
    marked: DataFrame, steps: list[MaskStep], paths: list[KeyPath],
    parameters: dict[str, str] | None,
) -> DataFrame:
    """Steps applied in turn to rows that carry a mark per path."""
    types = {f.name: f.dataType for f in marked.schema.fields}
    for step in steps:
        hit = F.col(mark_name(paths.index(step.path)))
        masks = {
            r.column_name: F.when(
                hit,
                bind_parameters(r.mask_expression, parameters).cast(types[r.column_name]),
            ).otherwise(F.col(r.column_name))
            for r in step.rules
        }
        marked = marked.withColumns(masks)
    return marked


def reached_mask_audit(
    steps: list[MaskStep], reached: Reached, chunks: DataFrame
) -> DataFrame:
    """Masked rows per chunk and step of one table, from the positions found before."""
    marks = F.array(
        *[F.struct(F.lit(i).alias("step"), F.col(reached.mark(s.path)).alias("chunk_number"))
          for i, s in enumerate(steps)]
    )
    counted = (
        reached.rows.select(F.inline(marks))
        .groupBy("step", "chunk_number")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    described = F.array(
        *[F.struct(F.lit(i).alias("step"), F.lit(s.rules[0].group_code).alias("group_code"),
                   F.lit(s.target_table).alias("target_table"),
                   F.lit(s.columns_masked).alias("columns_masked"),
                   F.lit(s.execution_order).alias("execution_order"))
          for i, s in enumerate(steps)]
    )
    return (
        chunks.select("chunk_number", F.inline(described))
        .join(counted, ["step", "chunk_number"], "left")
        .select(
            "group_code", "target_table", "columns_masked", "execution_order",
            F.coalesce("row_count", F.lit(0)).alias("masked_row_count"), "chunk_number",
        )
    )


def mask_audit(steps: list[MaskStep], reacher: Reacher) -> DataFrame:
    """Masked rows per chunk and step, zeros included."""
    reacher.prepare([s.path for s in steps])
    chunks = reacher.keys.select(F.col("chunk_no").alias("chunk_number")).distinct()
    parts = []
    for step in steps:
        target = eligible(reacher.tables[step.target_table], step.path, reacher.as_of)
        counts = matched_counts(
            target, match_column(step.path), reacher.values(step.path), ["chunk_no"]
        ).withColumnRenamed("chunk_no", "chunk_number")
        parts.append(
            chunks.join(counts, "chunk_number", "left").select(
                F.lit(step.rules[0].group_code).alias("group_code"),
                F.lit(step.target_table).alias("target_table"),
                F.lit(step.columns_masked).alias("columns_masked"),
                F.lit(step.execution_order).alias("execution_order"),
                F.coalesce("row_count", F.lit(0)).alias("masked_row_count"),
                "chunk_number",
            )
        )
    return union_all(parts)
