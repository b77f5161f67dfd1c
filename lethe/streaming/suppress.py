"""Keeping arriving rows of already erased subjects out, or masking them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lethe.operators.sizing import Measured, keyed_join


def suppress_rows(batch: DataFrame, match: Column, erased: Measured) -> DataFrame:
    """Rows whose subject has not been erased."""
    return keyed_join(batch, match, erased, "left_anti")


def mask_rows(
    batch: DataFrame, match: Column, erased: Measured, masks: dict[str, Column]
) -> DataFrame:
    """All rows; those of erased subjects with ``masks`` applied."""
    flagged = replace(
        erased, frame=erased.frame.withColumn("_erased", F.lit(True)),
        bytes=erased.bytes + erased.rows,
    )
    joined = keyed_join(batch, match, flagged, "left")
    masked = {
        name: F.when(F.col("_erased"), mask.cast(batch.schema[name].dataType)).otherwise(
            F.col(name)
        )
        for name, mask in masks.items()
    }
    return joined.withColumns(masked).select(*batch.columns)


def start_suppression(
    events: DataFrame, match: Column, erased: Callable[[], Measured], out: str,
    checkpoint: str, masks: dict[str, Column] | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Write the stream without (or with masked) rows of erased subjects.

    ``erased`` is asked for each micro-batch, so new erasures take effect at
    once.  A micro-batch owns its output directory and a repeat overwrites it.
    ``trigger`` holds the arguments of the stream's trigger; the default takes what
    is there and ends.
    """

    def take(batch: DataFrame, epoch: int) -> None:
        known = erased()
        if masks is None:
            kept = suppress_rows(batch, match, known)
        else:
            kept = mask_rows(batch, match, known, masks)
        kept.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    return (
        events.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_output(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.option("basePath", out).parquet(f"{out}/epoch=*").drop("epoch")
