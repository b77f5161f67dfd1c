"""Groups, rules and key paths: the configuration a run is driven by.

Configuration is written by people (tens to thousands of rows) and therefore
held on the driver.  Keys, tasks, hits and target rows never are.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from datetime import date
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: more configuration rows than this is a mistake, not a configuration
MAX_CONFIG_ROWS = 100_000

GROUP_SCHEMA = (
    "group_code string, key_type string, description string, chunk_size int, "
    "throttle_sec decimal(4,2), is_active boolean"
)
DELETION_RULE_SCHEMA = (
    "group_code string, target_table string, execution_order int, key_path string"
)
MASKING_RULE_SCHEMA = (
    "group_code string, target_table string, column_name string, mask_expression string, "
    "key_path string, execution_order int, is_active boolean, rule_no int"
)
RELATION_SCHEMA = (
    "child_table string, child_col string, parent_table string, parent_col string, "
    "on_delete_cascade boolean"
)


@dataclass(frozen=True)
class Hop:
    """``child_col IN (SELECT parent_col FROM parent_table WHERE ...)``."""

    child_col: str
    parent_table: str
    parent_col: str
    where: str | None = None


@dataclass(frozen=True)
class KeyPath:
    """How a business key reaches the rows of a target table.

    ``column`` is compared with the keys; it belongs to the parent of the last
    hop, or to the target itself when there is no hop.  ``cast`` names the type
    the *keys* are converted to, so the table column stays untouched and its
    file statistics usable.  ``where`` is a further condition on target rows and
    may mention ``{as_of}``.
    """

    column: str
    cast: str | None = None
    hops: tuple[Hop, ...] = ()
    where: str | None = None
    ignore_case: bool = False

    @property
    def join_column(self) -> str:
        """Column of the target table that is compared with reached values."""
        return self.hops[0].child_col if self.hops else self.column

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> KeyPath:
        raw = json.loads(text)
        raw["hops"] = tuple(Hop(**hop) for hop in raw["hops"])
        return KeyPath(**raw)


def bind_as_of(condition: str, as_of: str | None) -> str:
    """Put the run's reference date into a condition, as a date literal."""
    if "{as_of}" not in condition:
        return condition
    if as_of is None:
        raise ValueError(f"condition needs an as_of date: {condition}")
    return condition.replace("{as_of}", f"DATE'{date.fromisoformat(as_of)}'")


@dataclass(frozen=True)
class Group:
    group_code: str
    key_type: str
    description: str = ""
    chunk_size: int = 500
    throttle_sec: Decimal = Decimal("0.05")
    is_active: bool = True


@dataclass(frozen=True)
class DeletionRule:
    group_code: str
    target_table: str
    execution_order: int  # 1 = deepest child, highest = root
    path: KeyPath


@dataclass(frozen=True)
class MaskingRule:
    group_code: str
    target_table: str
    column_name: str
    mask_expression: str  # Spark SQL over the row's own columns
    path: KeyPath
    execution_order: int = 1
    is_active: bool = True


@dataclass(frozen=True)
class Relation:
    """A declared foreign key, used by the checks."""

    child_table: str
    child_col: str
    parent_table: str
    parent_col: str
    on_delete_cascade: bool = False


def _unique(values: list, what: str) -> None:
    seen = set()
    for value in values:
        if value in seen:
            raise ValueError(f"duplicate {what}: {value}")
        seen.add(value)


def _bounded_rows(frame: DataFrame, order_by: list[str]) -> list:
    rows = frame.orderBy(*order_by).limit(MAX_CONFIG_ROWS + 1).collect()
    if len(rows) > MAX_CONFIG_ROWS:
        raise ValueError(f"more than {MAX_CONFIG_ROWS} configuration rows")
    return rows


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of a few rows held in the plan itself, without a Python data source."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    columns = zip(*rows, strict=True) if rows else [()] * len(arrow)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow))


def groups_frame(spark: SparkSession, groups: list[Group]) -> DataFrame:
    return small_frame(spark, [tuple(asdict(g).values()) for g in groups], GROUP_SCHEMA)


def relations_frame(spark: SparkSession, relations: list[Relation]) -> DataFrame:
    return small_frame(spark, [tuple(asdict(r).values()) for r in relations], RELATION_SCHEMA)


@dataclass
class _Config:
    groups: list[Group]
    rules: list = field(default_factory=list)

    def __post_init__(self) -> None:
        _unique([g.group_code for g in self.groups], "group")
        codes = {g.group_code for g in self.groups}
        for rule in self.rules:
            if rule.group_code not in codes:
                raise ValueError(f"rule of unknown group {rule.group_code}")
        with_rules = {r.group_code for r in self.rules}
        for group in self.groups:
            if group.chunk_size < 1:
                raise ValueError(f"chunk_size of {group.group_code} must be positive")
            if group.is_active and group.group_code not in with_rules:
                raise ValueError(f"active group {group.group_code} has no rules")

    def group(self, code: str) -> Group:
        return next(g for g in self.groups if g.group_code == code)

    def active_groups(
        self, key_type: str | None = None, group_code: str | None = None
    ) -> list[Group]:
        return sorted(
            (
                g
                for g in self.groups
                if g.is_active
                and (key_type is None or g.key_type == key_type)
                and (group_code is None or g.group_code == group_code)
            ),
            key=lambda g: g.group_code,
        )

    def groups_frame(self, spark: SparkSession) -> DataFrame:
        return groups_frame(spark, self.groups)


@dataclass
class DeletionConfig(_Config):
    def __post_init__(self) -> None:
        super().__post_init__()
        _unique([(r.group_code, r.execution_order) for r in self.rules], "rule order")

    def rules_of(self, group_code: str, up_to_order: int | None = None) -> list[DeletionRule]:
        return sorted(
            (
                r
                for r in self.rules
                if r.group_code == group_code
                and (up_to_order is None or r.execution_order <= up_to_order)
            ),
            key=lambda r: r.execution_order,
        )

    def root_rule(self, group_code: str) -> DeletionRule:
        return self.rules_of(group_code)[-1]

    def rules_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (r.group_code, r.target_table, r.execution_order, r.path.to_json())
            for r in self.rules
        ]
        return small_frame(spark, rows, DELETION_RULE_SCHEMA)

    @staticmethod
    def from_frames(groups: DataFrame, rules: DataFrame) -> DeletionConfig:
        return DeletionConfig(
            _groups_of(groups),
            [
                DeletionRule(
                    r.group_code, r.target_table, r.execution_order,
                    KeyPath.from_json(r.key_path),
                )
                for r in _bounded_rows(rules, ["group_code", "execution_order"])
            ],
        )


@dataclass
class MaskingConfig(_Config):
    def __post_init__(self) -> None:
        super().__post_init__()
        _unique([(r.group_code, r.target_table, r.column_name) for r in self.rules], "rule")

    def rules_of(self, group_code: str, max_order: int | None = None) -> list[MaskingRule]:
        """Active rules, by order and then by position in the configuration."""
        return sorted(
            (
                r
                for r in self.rules
                if r.group_code == group_code
                and r.is_active
                and (max_order is None or r.execution_order <= max_order)
            ),
            key=lambda r: r.execution_order,
        )

    def rules_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (
                r.group_code, r.target_table, r.column_name, r.mask_expression,
                r.path.to_json(), r.execution_order, r.is_active, number,
            )
            for number, r in enumerate(self.rules, start=1)
        ]
        return small_frame(spark, rows, MASKING_RULE_SCHEMA)

    @staticmethod
    def from_frames(groups: DataFrame, rules: DataFrame) -> MaskingConfig:
        return MaskingConfig(
            _groups_of(groups),
            [
                MaskingRule(
                    r.group_code, r.target_table, r.column_name, r.mask_expression,
                    KeyPath.from_json(r.key_path), r.execution_order, r.is_active,
                )
                for r in _bounded_rows(rules, ["rule_no"])
            ],
        )


def _groups_of(frame: DataFrame) -> list[Group]:
    columns = [name.split()[0] for name in GROUP_SCHEMA.split(", ")]
    picked = frame.select(*[F.col(c) for c in columns])
    return [Group(*row) for row in _bounded_rows(picked, ["group_code"])]
