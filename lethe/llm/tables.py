"""Small intermediate results as Parquet in the shared folder.

Unlike a checkpoint, a table is read back in as many tasks as its size asks for, a
column at a time, and its size is known to the planner.  Meant for ids only; the
folders stay in ``spark.checkpoint.dir`` until their owner removes them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lethe.operators.sizing import Measured, value_range
from lethe.session import shared_folder


ROWS = 100_000  # a task writes at least so many, where their number is known before


def written(frame: DataFrame, rows: int | None = None) -> DataFrame:
    """``frame``, of at most ``rows`` rows, behind a written table, without its lineage."""
    spark = frame.sparkSession
    if rows is not None:
        frame = frame.coalesce(rows // ROWS + 2)
    folder = f"{shared_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def written_values(frame: DataFrame) -> Measured:
    """A frame of whole numbers behind a written table, measured on the way."""
    seen = Observation()
    count = F.count(F.lit(1)).alias("rows")
    table = written(frame.observe(seen, count, *value_range(frame)))
    found = seen.get
    rows = found["rows"] or 0
    width = 16 * len(frame.columns)
    return Measured(table, rows, rows * width, found.get("low"), found.get("high"))
