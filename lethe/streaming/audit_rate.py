"""Audit rows per tumbling minute, as a batch or as a stream.

The stream writes each micro-batch's own counts as a part, ``epoch=N``.  Parts are folded:
as soon as ``fan`` parts in a row are done they become one, ``span=A-B``, and ``fan`` of
those become a longer one, so a reader opens a number of parts that grows with the
logarithm of the micro-batches and every count is written again as often as that only.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

FAN = 16
_PART = re.compile(r"epoch=(\d+)|span=(\d+)-(\d+)")
_RATES = "minute_start timestamp, group_code string, audit_rows bigint, rows_deleted bigint"
Span = tuple[int, int]


def audit_rate(audit: DataFrame, width: str = "1 minute") -> DataFrame:
    return (
        audit.groupBy(F.window("executed_at", width).alias("_w"), "group_code")
        .agg(
            F.count(F.lit(1)).alias("audit_rows"),
            F.sum("deleted_row_count").alias("rows_deleted"),
        )
        .select(
            F.col("_w.start").alias("minute_start"), "group_code", "audit_rows", "rows_deleted"
        )
    )


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy("minute_start", "group_code").agg(
        F.sum("audit_rows").alias("audit_rows"), F.sum("rows_deleted").alias("rows_deleted")
    )


class RateParts:
    """The parts below one folder, each named by the micro-batches it holds."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def folder(self, span: Span) -> str:
        first, last = span
        return f"{self.out}/epoch={first}" if first == last else f"{self.out}/span={first}-{last}"

    def _whole(self, span: Span) -> bool:
        return self._fs.exists(self._path(f"{self.folder(span)}/_SUCCESS"))

    def spans(self) -> list[Span]:
        """Parts that were written to their end."""
        if not self._fs.exists(self._path(self.out)):
            return []
        found = []
        for status in self._fs.listStatus(self._path(self.out)):
            named = _PART.fullmatch(status.getPath().getName())
            if named:
                epoch, first, last = named.groups()
                found.append((int(epoch),) * 2 if epoch else (int(first), int(last)))
        return sorted(s for s in found if self._whole(s))

    def cover(self, below: int | None = None) -> list[Span]:
        """The longest parts, no micro-batch in two of them; ``below``: of those before it."""
        chosen: list[Span] = []
        # spans nest, so what begins behind the last one chosen is not part of it
        for first, last in sorted(self.spans(), key=lambda s: (s[0], -s[1])):
            inside = below is None or last < below
            if inside and (not chosen or first > chosen[-1][1]):
                chosen.append((first, last))
        return chosen

    def holds(self, epoch: int) -> bool:
        """Was this micro-batch folded?"""
        return any(first <= epoch <= last for first, last in self.spans() if first != last)

    def read(self, spans: list[Span]) -> DataFrame:
        return _added(self.spark.read.parquet(*map(self.folder, spans)))

    def fold(self, epoch: int, fan: int = FAN) -> None:
        """Fold what is due before ``epoch``, and drop parts folded at an earlier time.

        Everything before the micro-batch at work is committed and does not change any
        more.  A fold that was interrupted lacks its mark: it is not read and is done
        again with the micro-batch.  Its parts stay until the next fold, for readers
        that have listed them.
        """
        length, spans = fan, self.spans()
        due = []
        while epoch and epoch % length == 0:
            due.append((epoch - length, epoch - 1))
            length *= fan
        if not due:
            return
        folded = [s for s in spans if any(_holds(t, s) for t in spans) and s not in due]
        for span in due:
            members = [s for s in self.cover(below=epoch) if _holds(span, s)]
            if members and span not in spans:
                self.read(members).write.mode("overwrite").parquet(self.folder(span))
        for span in folded:
            self._fs.delete(self._path(self.folder(span)), True)


def _holds(outer: Span, inner: Span) -> bool:
    return outer != inner and outer[0] <= inner[0] and inner[1] <= outer[1]


def start_audit_rate(
    audit: DataFrame, out: str, checkpoint: str, trigger: dict | None = None, fan: int = FAN
) -> StreamingQuery:
    """Write each micro-batch's own counts per window; reading adds them up.

    No window is ever closed, so a late audit row is one more part of its window.  A
    micro-batch that is repeated replaces its counts; one that was folded already is
    committed, so a repeat of it (from an older copy of the checkpoint) adds nothing.
    A new checkpoint counts micro-batches from 0 again and needs a new ``out``.
    """
    if fan < 2:
        raise ValueError("fan must be at least 2")

    def take(batch: DataFrame, epoch: int) -> None:
        parts = RateParts(batch.sparkSession, out)
        if parts.holds(epoch):
            return
        audit_rate(batch).write.mode("overwrite").parquet(parts.folder((epoch, epoch)))
        parts.fold(epoch, fan)

    return (
        audit.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_rates(spark: SparkSession, out: str) -> DataFrame:
    """All counts so far; none before the first micro-batch."""
    parts = RateParts(spark, out)
    spans = parts.cover()
    return parts.read(spans) if spans else spark.createDataFrame([], _RATES)
