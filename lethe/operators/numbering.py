"""Exact running numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lethe.operators.sizing import durable


def number_rows(
    rows: DataFrame, within: list[str], order: list[str], name: str = "position"
) -> DataFrame:
    """Add a 1-based position by ``order`` inside each ``within`` group.

    Rows are range-partitioned on (``within``, ``order``), so one large group is
    cut into many slices; each slice is numbered on its own and shifted by the
    number of rows in the slices before it.
    """
    sliced = durable(
        rows.repartitionByRange(*within, *order).withColumn("_slice", F.spark_partition_id())
    )
    # one row per slice and group in it: at most slices + groups rows
    sizes = sliced.groupBy(*within, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*within).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        *within, "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")
    )
    in_slice = Window.partitionBy(*within, "_slice").orderBy(*order)
    return (
        sliced.withColumn("_rank", F.row_number().over(in_slice))
        .join(offsets, [*within, "_slice"])
        .withColumn(name, F.col("_before") + F.col("_rank"))
        .drop("_slice", "_rank", "_before")
    )


def assign_chunks(tasks: DataFrame, groups: DataFrame) -> DataFrame:
    """Add ``chunk_no``: keys in key order, ``chunk_size`` of the group per chunk."""
    sized = tasks.join(F.broadcast(groups.select("group_code", "chunk_size")), "group_code")
    numbered = number_rows(sized, ["batch_id", "group_code"], ["key_no"])
    chunk = F.floor((F.col("position") - 1) / F.col("chunk_size")).cast("int") + 1
    return numbered.withColumn("chunk_no", chunk).drop("position", "chunk_size")
