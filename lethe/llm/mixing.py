"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target: its weight's share of the budget, at most a number of
epochs of its own size.  As many complete epochs as fit are taken from all its
documents.  For the rest, each document draws an exponential key whose rate is its
quality weight; documents are put in ascending order of keys within their source, sizes
are summed along it, and those within the remaining budget are taken once more.  That
is weighted sampling without replacement, and the draw depends on the id alone.

Texts are read once; only ids, sizes and keys move.  Prefix sums run over slices of a
range partitioning, so a source that holds most rows is many slices.  Everything is
column expressions, joins and windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lethe.operators.numbering import number_rows
from lethe.operators.sizing import durable, keyed_join, measured

_DIGITS = 13  # hexadecimal digits of a draw: 52 bits


@dataclass(frozen=True)
class MixParameters:
    weights: tuple[int, ...] = (5, 2, 1)  # of the sources in their order, repeating
    percent: int = 150  # of all sizes that the mix takes
    epochs: int = 2  # times a source is taken at most
    seed: int = 12
    least_weight: float = 0.05  # of a document; a weight of zero would never be drawn


def word_array(text: Column) -> Column:
    """Words between white space; null without text."""
    return F.array_remove(F.split(text, "[ \\t-\\r]+"), "")


def text_weight(words: Column, least: float) -> Column:
    """Share of plain words: letters, with at most one mark behind them.  No words: 1."""
    plain = F.size(F.filter(words, lambda w: w.rlike("^\\p{L}+[.,;:!?]?$")))
    share = plain / F.size(words)
    return F.when(F.size(words) > 0, F.greatest(share, F.lit(least))).otherwise(F.lit(1.0))


def exponential_key(doc_id: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight, with u in (0, 1) drawn from the id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    number = F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long")
    return -F.ln((number + F.lit(0.5)) / F.lit(float(1 << 4 * _DIGITS))) / weight


def sources_with_targets(totals: DataFrame, p: MixParameters) -> DataFrame:
    """``totals`` (source, source_size) with the ``target`` of each source.

    Sharing anew what is above a source's limit ends at the level at which sources get
    either their limit or the level times their weight.  A round looks at all sources at
    once and yields three sums.
    """
    ordered = number_rows(
        totals.withColumn("_last", F.col("source").isNull()), [], ["_last", "source"], "_place"
    )
    weights = F.array(*[F.lit(w) for w in p.weights])
    sources = durable(
        ordered.select(
            "source",
            "source_size",
            (F.col("source_size") * p.epochs).alias("_limit"),
            F.get(weights, ((F.col("_place") - 1) % len(p.weights)).cast("int")).alias("_weight"),
        )
    )
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    budget = total * min(p.percent, 100 * p.epochs) / 100
    level, full = 0.0, -1
    while True:
        above = F.col("_limit") < F.lit(level) * F.col("_weight")
        found = sources.agg(
            F.count(F.when(above, 1)).alias("full"),
            F.coalesce(F.sum(F.when(above, F.col("_limit"))), F.lit(0)).alias("given"),
            F.sum(F.when(~above, F.col("_weight"))).alias("open"),
        ).first()
        if found["full"] == full or not found["open"]:
            break
        full = found["full"]
        level = (budget - found["given"]) / found["open"]
    target = F.least(F.col("_limit").cast("double"), F.lit(level) * F.col("_weight"))
    return sources.select("source", "source_size", target.alias("target"))


def running_sizes(rows: DataFrame, within: str, order: list[str], size: str) -> DataFrame:
    """Add ``_before``: the sum of ``size`` over the rows ahead in the same group."""
    sliced = durable(
        rows.repartitionByRange(within, *order).withColumn("_slice", F.spark_partition_id())
    )
    # one row per slice and group in it: at most slices + groups rows
    sums = sliced.groupBy(within, "_slice").agg(F.sum(size).alias("_sum"))
    earlier = Window.partitionBy(within).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        within, "_slice", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_ahead")
    )
    in_slice = Window.partitionBy(within, "_slice").orderBy(*order)
    upto = F.sum(size).over(in_slice.rowsBetween(Window.unboundedPreceding, -1))
    return (
        sliced.withColumn("_inside", F.coalesce(upto, F.lit(0)))
        .join(offsets, [within, "_slice"])
        .withColumn("_before", F.col("_ahead") + F.col("_inside"))
        .drop("_slice", "_ahead", "_inside")
    )


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", size: Column | None = None, weight: Column | None = None,
                parameters: MixParameters = MixParameters()) -> DataFrame:
    """(doc_id, source, size, weight, source_size, target, epochs, taken) of every row of ``docs``.

    ``size`` (default: words of the text) and ``weight`` (default: ``text_weight``) are
    columns of ``docs``.  A document at the end of a source's budget is taken if that
    brings the source nearer to its target, so a source ends within half of that
    document's size.  Null and empty texts have size 0 and are taken 0 times their
    words.  A null source is a source of its own, the last one.  Rows of one id and rows
    without id are documents each for itself; equal draws go by size, and rows that tie
    there too cannot be told apart in the result.  Sources without words have target 0;
    no rows give no rows; other columns are not read.
    """
    p = parameters
    read = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        (F.lit(0) if size is None else size).cast("long").alias("size"),
        (F.lit(1.0) if weight is None else weight).cast("double").alias("weight"),
        F.col(text_col).cast("string").alias("text"),
    )
    if size is None or weight is None:
        made = F.transform(
            F.array(word_array(F.coalesce("text", F.lit("")))),
            lambda words: F.struct(
                F.size(words).cast("long").alias("size"),
                text_weight(words, p.least_weight).alias("weight"),
            ),
        )
        read = read.withColumn("_made", F.get(made, F.lit(0)))
        if size is None:
            read = read.withColumn("size", F.col("_made.size"))
        if weight is None:
            read = read.withColumn("weight", F.col("_made.weight"))
    rows = durable(
        read.select(
            "doc_id",
            "source",
            F.greatest(F.coalesce("size", F.lit(0)), F.lit(0)).alias("size"),
            F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(p.least_weight)).alias("weight"),
        )
        .withColumn("key", exponential_key(F.col("doc_id"), F.col("weight"), p.seed))
        # a name for every source, a null one too; null ids tie apart by size only
        .withColumn("of", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    )
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = sources_with_targets(totals, p).select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("_value"),
        "source_size",
        "target",
    )
    placed = running_sizes(rows, "of", ["key", "doc_id", "size"], "size")
    joined = keyed_join(placed, F.col("of"), measured(targets), "inner")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    epochs = F.least(F.coalesce(whole, F.lit(0)), F.lit(p.epochs)).cast("long")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    again = F.col("_before") * 2 + F.col("size") <= rest * 2
    return joined.withColumn("epochs", epochs).select(
        "doc_id",
        "source",
        "size",
        "weight",
        "source_size",
        "target",
        "epochs",
        (F.col("size") * (F.col("epochs") + F.when(again, 1).otherwise(0))).alias("taken"),
    )
