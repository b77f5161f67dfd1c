"""Size-checked joins between target rows and reached values.

The side holding reached values is materialised and measured.  Within a fixed
limit it is broadcast, so target rows stay where they are and a hot key costs
nothing.  Beyond the limit both sides are shuffled, and target rows of hot (or
NULL) join values are spread over several sub-keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

VALUE = "_value"  # column name of the reached join value
_MATCH = "_match"
_SPREAD = "_spread"
_numbers = count()


@dataclass(frozen=True)
class Limits:
    """What may be broadcast.  Both bounds are checked against measured sizes."""

    rows: int = 1_000_000
    bytes: int = 64 * 1024 * 1024
    hot_values: int = 100  # at most this many join values are treated as hot
    hot_tracked: int = 10_000  # counters of the heavy-hitter sketch

    @staticmethod
    def of(spark: SparkSession) -> Limits:
        default = Limits()
        return Limits(
            int(spark.conf.get("lethe.broadcast.rows", str(default.rows))),
            int(spark.conf.get("lethe.broadcast.bytes", str(default.bytes))),
        )


@dataclass(frozen=True)
class Measured:
    """A durable frame with its exact row count and payload size."""

    frame: DataFrame
    rows: int
    bytes: int
    low: int | str | None = None  # smallest and largest value, where known
    high: int | str | None = None

    def in_range(self, match: Column, rows: DataFrame) -> Column:
        """Can a row of ``rows`` match at all?  Lets the scan skip files and row groups.

        Values of another type are ordered otherwise, so there is no range for them.
        """
        same = VALUE in self.frame.columns and (
            rows.select(match.alias(VALUE)).schema[VALUE].dataType
            == self.frame.schema[VALUE].dataType
        )
        if self.low is None or self.high is None or not same:
            return match.isNotNull()
        return match.between(self.low, self.high)

    def broadcastable(self, limits: Limits | None = None) -> bool:
        limits = limits or Limits.of(self.frame.sparkSession)
        return self.rows <= limits.rows and self.bytes <= limits.bytes

    def build_side(self, frame: DataFrame | None = None) -> DataFrame:
        """The frame (or one derived from it) as build side of a shuffled join.

        Values are unique, so they spread evenly and a partition's share is
        known: if it is small, hashing it spares sorting the target rows.
        """
        frame = self.frame if frame is None else frame
        share = self.bytes / shuffle_partitions(self.frame.sparkSession)
        small = share <= Limits.of(self.frame.sparkSession).bytes
        return frame.hint("shuffle_hash") if small else frame


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _size_columns(frame: DataFrame) -> list[Column]:
    width = sum(
        (
            F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8
            for c in frame.columns
        ),
        F.lit(0),
    )
    return [F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")]


def value_range(frame: DataFrame) -> list[Column]:
    """Bounds of the value column, if its type has plain literals."""
    kind = frame.schema[VALUE].dataType if VALUE in frame.columns else None
    if not isinstance(kind, (IntegralType, StringType)):
        return []
    return [F.min(VALUE).alias("low"), F.max(VALUE).alias("high")]


def measured(frame: DataFrame) -> Measured:
    """Write ``frame`` to the checkpoint folder, counting it on the way."""
    seen = Observation(f"lethe-{next(_numbers)}")
    written = frame.observe(seen, *_size_columns(frame), *value_range(frame)).checkpoint()
    found = seen.get
    return Measured(
        written, found["rows"] or 0, found["bytes"] or 0, found.get("low"), found.get("high")
    )


def sized(frame: DataFrame) -> Measured:
    """Count a frame that is cheap to read again, as a durable one is."""
    size = frame.agg(*_size_columns(frame)).first()
    return Measured(frame, size["rows"], size["bytes"] or 0)


def sized_groups(frame: DataFrame, by: str, values: list) -> dict[str | int, Measured]:
    """``sized`` for the rows of each of a few configured groups, in one pass."""
    counts = [*_size_columns(frame.drop(by)), *value_range(frame)]
    rows = frame.where(F.col(by).isin(*values)).groupBy(by).agg(*counts).collect()
    sizes = {r[by]: tuple(r)[1:] for r in rows}
    return {
        v: Measured(frame.where(F.col(by) == v).drop(by), *sizes.get(v, (0, 0))) for v in values
    }


def durable(frame: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint."""
    return frame.checkpoint()


def hot_values(rows: DataFrame, match: Column) -> list:
    """Join values that hold a large share of ``rows``, most frequent first.

    One pass over one column with a bounded, mergeable sketch.  What it finds
    only steers the distribution of rows and never changes a result.
    """
    limits = Limits.of(rows.sparkSession)
    kind = rows.select(match.alias("m")).schema["m"].dataType
    if not isinstance(kind, (IntegralType, StringType)):
        return []  # keys are text or whole numbers; anything else is left to AQE
    found = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.call_function(
            "approx_top_k", match, F.lit(limits.hot_values), F.lit(limits.hot_tracked)
        ).alias("top"),
    ).first()
    share = found["n"] / shuffle_partitions(rows.sparkSession) / 2
    return [t["item"] for t in found["top"] if t["item"] is not None and t["count"] > share]


def _row_position(rows: DataFrame) -> Column:
    """A number that differs between equal rows and is the same on every retry."""
    position = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    try:
        rows.select(position)
        return position
    except AnalysisException:
        return F.xxhash64(*[F.col(c) for c in rows.columns if c != _MATCH])


def keyed_join(rows: DataFrame, match: Column, values: Measured, how: str) -> DataFrame:
    """Join ``rows`` with reached values on ``match = _value``.

    ``values`` holds every value once, so no row is multiplied.  ``how`` is
    ``inner``, ``left``, ``left_semi`` or ``left_anti``.  The value column is
    dropped; what else ``values`` carries is kept for ``inner`` and ``left``.
    """
    left = rows.withColumn(_MATCH, match)
    if how in ("inner", "left_semi"):
        left = left.where(values.in_range(F.col(_MATCH), left))
    if values.broadcastable():
        joined = left.join(F.broadcast(values.frame), F.col(_MATCH) == F.col(VALUE), how)
        return joined.drop(_MATCH, VALUE)

    hot = hot_values(left, F.col(_MATCH))
    fan = shuffle_partitions(rows.sparkSession)
    spread = F.pmod(_row_position(left), F.lit(fan)).cast("int")
    copy = F.lit(0)
    to_spread = F.col(_MATCH).isNull()
    if hot:
        to_spread = to_spread | F.col(_MATCH).isin(hot)
        every = F.sequence(F.lit(0), F.lit(fan - 1))
        copy = F.explode(F.when(F.col(VALUE).isin(hot), every).otherwise(F.array(F.lit(0))))
    left = left.withColumn(_SPREAD, F.when(to_spread, spread).otherwise(F.lit(0)))
    right = values.build_side(values.frame.withColumn("_copy", copy))
    joined = left.join(
        right, (F.col(_MATCH) == F.col(VALUE)) & (F.col(_SPREAD) == F.col("_copy")), how
    )
    return joined.drop(_MATCH, VALUE, _SPREAD, "_copy")


def matched_counts(
    rows: DataFrame, match: Column, values: Measured, by: list[str]
) -> DataFrame:
    """Number of ``rows`` per carried column(s) of the value they match.

    Only the join column is read.  In a shuffled join, rows are first counted
    per join value on the map side, so a hot value travels as a few counts.
    """
    narrow = rows.select(match.alias(_MATCH))
    narrow = narrow.where(values.in_range(F.col(_MATCH), narrow))
    if values.broadcastable():
        joined = narrow.join(F.broadcast(values.frame), F.col(_MATCH) == F.col(VALUE))
        return joined.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))
    counted = narrow.groupBy(_MATCH).agg(F.count(F.lit(1)).alias("_n"))
    joined = counted.join(values.build_side(), F.col(_MATCH) == F.col(VALUE))
    return joined.groupBy(*by).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"))


def present_values(rows: DataFrame, match: Column, values: Measured) -> DataFrame:
    """The reached values that occur in ``rows``, each once."""
    narrow = rows.select(match.alias(VALUE))
    narrow = narrow.where(values.in_range(F.col(VALUE), narrow))
    if values.broadcastable():
        wanted = F.broadcast(values.frame.select(VALUE))
        return narrow.join(wanted, VALUE, "left_semi").distinct()
    wanted = values.build_side(values.frame.select(VALUE))
    return narrow.distinct().join(wanted, VALUE, "left_semi")
