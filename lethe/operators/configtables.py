"""Operators over configuration and state tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(
    old: DataFrame, new: DataFrame, key: list[str], update: list[str] | None = None
) -> DataFrame:
    """Insert new keys, overwrite ``update`` columns (default: all) of known ones."""
    update = [c for c in old.columns if c not in key] if update is None else update
    was, now = old.alias("was"), new.alias("now")
    both = was.join(now, key, "full_outer")
    known = F.col(f"was.{key[0]}").isNotNull()
    given = F.col(f"now.{key[0]}").isNotNull()

    def pick(column: str) -> Column:
        if column in key:
            return F.coalesce(f"was.{column}", f"now.{column}").alias(column)
        take_new = given if column in update else given & ~known
        return F.when(take_new, F.col(f"now.{column}")).otherwise(
            F.col(f"was.{column}")
        ).alias(column)

    return both.select(*[pick(c) for c in old.columns])


def insert_missing(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not there yet, each key once."""
    return new.dropDuplicates(key).join(existing.select(*key), key, "left_anti")


def replace_scope(old: DataFrame, new: DataFrame, scope: list[str]) -> DataFrame:
    """``old`` without the (batch, group) scopes present in ``new``, plus ``new``."""
    return old.join(new.select(*scope).distinct(), scope, "left_anti").unionByName(new)


def config_overview(groups: DataFrame, rules: DataFrame) -> DataFrame:
    """Groups with their number of rules."""
    counted = rules.groupBy("group_code").agg(F.count(F.lit(1)).alias("total_rules"))
    return (
        groups.join(counted, "group_code", "left")
        .select(
            "group_code", "key_type", "chunk_size", "throttle_sec", "is_active",
            F.coalesce("total_rules", F.lit(0)).alias("total_rules"), "description",
        )
        .orderBy("group_code")
    )


def config_rule_order(groups: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules of every group, bottom-up."""
    return (
        rules.join(groups.select("group_code", "key_type"), "group_code")
        .select("group_code", "key_type", "execution_order", "target_table", "key_path")
        .orderBy("group_code", "execution_order")
    )


def active_rules(groups: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules in force: of active groups and, where rules have a switch, switched on."""
    if "is_active" in rules.columns:
        rules = rules.where("is_active")
    return rules.join(groups.where("is_active").select("group_code"), "group_code", "left_semi")


def deactivate_conflicts(groups: DataFrame, key_type: str, keep: str) -> DataFrame:
    """Switch off the other groups of a key type before a run."""
    conflicting = (F.col("key_type") == key_type) & (F.col("group_code") != keep)
    return groups.withColumn(
        "is_active", F.when(conflicting, F.lit(False)).otherwise(F.col("is_active"))
    )
