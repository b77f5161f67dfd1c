"""Rows of files by position: which ones are reached, and files without or with them changed.

A narrow scan over the join columns finds the rows that key paths reach, as (file, row
index) with the lowest chunk of every path.  Everything else follows from these
positions: the files that have to be written anew, the counts of the audit, and the rows
to leave out or to change.  Files without a hit are not read again, and rows of the
others do not move: positions are packed into words of 64 rows and broadcast, for as many
files at a time as the measured bound allows.  Words are keyed by the number of their file
and are counted, if there are more rows than words may be: neighbouring rows share one.
Frames whose words fit the bound together may be written side by side.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.config import KeyPath, small_frame
from lethe.operators.reach import Reacher, guarded_match
from lethe.operators.sizing import Limits, durable, keyed_join
from lethe.session import shared_folder

FILE, AT = "_file", "_at"
_WORD, _SLICE, _NUMBER = "_word", "_slice", "_file_number"
_WIDTH = 48  # bytes of a word's row without its sets
_FILE_SHIFT = 40  # a word's place: the number of its file, then the word's in 40 bits

PartsOf = Callable[[list[str] | None], list[DataFrame]]


def located(part: DataFrame) -> DataFrame:
    """``part`` with the file and the row index of every row."""
    return part.select(
        "*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(AT)
    )


def parts_of_frame(frame: DataFrame) -> PartsOf | None:
    """Reads the same files again, all or some; None for a frame that is not plain files."""
    try:
        located(frame)
    except AnalysisException:
        return None
    path = F.col("_metadata.file_path")
    return lambda files: [frame if files is None else frame.where(path.isin(files))]


def mark_name(number: int) -> str:
    return f"_hit{number}"


def _place() -> Column:
    """A row's word among those of numbered files."""
    shifted = F.shiftleft(F.col(_NUMBER), _FILE_SHIFT)
    return shifted + F.floor(F.col(AT) / 64)


@dataclass
class Reached:
    """Rows that paths reach: (_file, _at, _hit0, _hit1, ...) with the chunk per path."""

    rows: DataFrame  # durable
    paths: list[KeyPath]
    files: dict[str, int]  # reached rows of every file that has some
    parts_of: PartsOf
    _folders: list[str] = field(default_factory=list)

    def mark(self, path: KeyPath) -> str:
        return mark_name(self.paths.index(path))

    @cached_property
    def _words_of(self) -> dict[str, int]:
        """Words of every file, or its reached rows if those are few: it has no more words."""
        if sum(self.files.values()) <= Limits.of(self.rows.sparkSession).rows:
            return self.files
        words = self.rows.select(FILE, F.floor(F.col(AT) / 64).alias(_WORD)).distinct()
        # one row per file hit
        return {r[FILE]: r["count"] for r in words.groupBy(FILE).count().collect()}

    def _most(self, marks: int) -> int:
        """Words that may be broadcast together."""
        limits = Limits.of(self.rows.sparkSession)
        return min(limits.rows, limits.bytes // (_WIDTH + 8 * marks))

    def _slices(self, marks: int = 1) -> list[list[str]]:
        """Files in lists whose positions may be broadcast together.

        One file alone is always taken: its words are a 64th of its rows at most.
        """
        rows, most = Limits.of(self.rows.sparkSession).rows, self._most(marks)
        slices: list[list[str]] = []
        used = words = 0
        for name, hits in sorted(self.files.items()):
            if not slices or used + hits > rows or words + self._words_of[name] > most:
                slices.append([])
                used = words = 0
            slices[-1].append(name)
            used += hits
            words += self._words_of[name]
        return slices

    def at_once(self, marks: int = 1) -> int:
        """Frames of ``with_marks`` whose words may be broadcast side by side."""
        largest = max((sum(self._words_of[n] for n in s) for s in self._slices(marks)), default=0)
        return max(1, self._most(marks) // max(1, largest))

    def _rows_of_slices(self, slices: list[list[str]]) -> list[DataFrame]:
        if len(slices) < 2:
            return [self.rows] * len(slices)
        # every slice reads its own rows only
        spark = self.rows.sparkSession
        numbers = [(name, i) for i, names in enumerate(slices) for name in names]
        of_file = small_frame(spark, numbers, f"{FILE} string, {_SLICE} int")
        folder = f"{shared_folder(spark).rstrip('/')}/lethe-positions-{uuid.uuid4().hex}"
        self._folders.append(folder)
        numbered = self.rows.join(F.broadcast(of_file), FILE)
        numbered.repartition(_SLICE).write.partitionBy(_SLICE).parquet(folder)
        plain = self.rows.schema
        return [
            spark.read.schema(plain).parquet(f"{folder}/{_SLICE}={i}") for i in range(len(slices))
        ]

    def _words(self, rows: DataFrame, numbers: DataFrame, marks: dict[str, Column]) -> DataFrame:
        """(_word, one set of 64 bits per mark), the word with the number of its file."""
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col(AT) % 64).cast("int"))
        bits = [F.bit_or(F.when(hit, bit)).alias(name) for name, hit in marks.items()]
        return rows.join(numbers, FILE).groupBy(_place().alias(_WORD)).agg(*bits)

    def with_marks(self, marks: dict[str, Column]) -> Iterator[DataFrame]:
        """All rows of the files hit, slice by slice, with a boolean column per mark.

        ``marks`` are conditions on the reached rows' columns.
        """
        slices = self._slices(len(marks))
        spark = self.rows.sparkSession
        for files, rows in zip(slices, self._rows_of_slices(slices), strict=True):
            pairs = [(name, i) for i, name in enumerate(files)]
            numbers = F.broadcast(small_frame(spark, pairs, f"{FILE} string, {_NUMBER} bigint"))
            words = F.broadcast(self._words(rows, numbers, marks))
            for part in self.parts_of(files):
                row = located(part).join(numbers, FILE, "left").withColumn(_WORD, _place())
                joined = row.join(words, _WORD, "left")
                flags = {
                    name: F.coalesce(F.getbit(F.col(name), (F.col(AT) % 64).cast("int")), F.lit(0)) == 1
                    for name in marks
                }
                yield joined.withColumns(flags).drop(FILE, AT, _WORD, _NUMBER)

    def without(self) -> Iterator[DataFrame]:
        """The rows of the files hit that no path reaches, slice by slice."""
        for frame in self.with_marks({"_doomed": F.lit(True)}):
            yield frame.where(~F.col("_doomed")).drop("_doomed")

    def release(self) -> None:
        """Remove the tables written for the slices."""
        spark = self.rows.sparkSession
        for name in self._folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self._folders.clear()


def reached_rows(parts_of: PartsOf, paths: list[KeyPath], reacher: Reacher) -> Reached:
    """One scan of the join columns for all paths to a table."""
    paths = list(dict.fromkeys(paths))
    reacher.prepare(paths)
    found = []
    for part in parts_of(None):
        matches = [guarded_match(p, reacher.as_of).alias(f"_match{i}") for i, p in enumerate(paths)]
        columns = [m for m in part.columns if m.startswith("_match")]
        narrow = located(part.drop(*columns)).select(FILE, AT, *matches)
        values = [reacher.values(p) for p in paths]
        if len(paths) == 1:
            narrow = keyed_join(narrow, F.col("_match0"), values[0], "inner")
            narrow = narrow.withColumnRenamed("chunk_no", mark_name(0))
        else:
            near = [v.in_range(F.col(f"_match{i}"), narrow) for i, v in enumerate(values)]
            narrow = narrow.where(reduce(or_, near))
            for i, value in enumerate(values):
                narrow = keyed_join(narrow, F.col(f"_match{i}"), value, "left")
                narrow = narrow.withColumnRenamed("chunk_no", mark_name(i))
            marks = [F.col(mark_name(i)) for i in range(len(paths))]
            narrow = narrow.where(F.coalesce(*marks).isNotNull())
        found.append(narrow.select(FILE, AT, *[mark_name(i) for i in range(len(paths))]))
    rows = durable(reduce(DataFrame.unionByName, found))
    # at most one row per file of the table, which the driver lists anyway
    files = {r[FILE]: r["n"] for r in rows.groupBy(FILE).agg(F.count(F.lit(1)).alias("n")).collect()}
    return Reached(rows, paths, files, parts_of)
