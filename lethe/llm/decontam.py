"""Benchmark items inside documents: MinHash containment search by size class.

A set of n five-word shingles belongs to the class of its size, c = ceil(log2 n),
and is sketched with 2**(c + 1) buckets: the smallest hash of every bucket.  With
buckets in proportion to the set, an item's shingle that a document holds is the
minimum of its bucket about four times out of five however long the document is,
so the share of an item's registers found in the document's sketch estimates
containment.  Items are sketched once per class that can contain them.  A sketch of
few registers may miss all of them, so the shingles of short items are looked up among
all shingles of the documents instead.  Pairs with enough equal registers or shingles
are verified by exact containment of shingle texts.

Everything is column expressions and joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lethe.operators.sizing import Measured, durable, keyed_join, measured

SHINGLE = 5
_CLASSES = 40  # sets of up to 2**40 shingles


@dataclass(frozen=True)
class ContainmentParameters:
    percent: int = 75  # of an item's distinct shingles that a document has to hold
    # registers that must agree, as a share of those expected at that containment
    share_of_expected: float = 0.25
    surviving: float = 0.78  # of contained shingles that are the minimum of their bucket
    # distinct shingles up to which an item is looked up whole; the sketch misses a
    # longer one that a document just holds less than once in a million
    whole: int = 32


def word_array(text: Column) -> Column:
    """Lower-case words between white space; null without text."""
    return F.array_remove(F.split(F.lower(text), "[ \\t-\\r]+"), "")


def _with_words(text: Column, build) -> Column:
    """``build`` of the word array, which is computed once per row."""
    return F.flatten(F.transform(F.array(word_array(text)), build))


def _each_shingle(words: Column, make) -> Column:
    n = F.size(words)
    return (
        F.when(
            n >= SHINGLE,
            F.transform(
                F.sequence(F.lit(1), n - (SHINGLE - 1)), lambda i: make(F.slice(words, i, SHINGLE))
            ),
        )
        .when(n > 0, F.array(make(words)))
        .otherwise(F.array_repeat(make(words), 0))
    )


def shingle_hashes(text: Column) -> Column:
    """Ascending distinct hashes of the shingles of a text."""
    build = lambda words: F.array_distinct(F.sort_array(_each_shingle(words, F.xxhash64)))
    return _with_words(text, build)


def shingle_texts(text: Column) -> Column:
    """Distinct shingles of a text, as text."""
    join = lambda words: F.array_join(words, " ")
    return _with_words(text, lambda words: F.array_distinct(_each_shingle(words, join)))


def size_class(n: Column) -> Column:
    return F.ceil(F.log2(F.greatest(n, F.lit(1)).cast("double"))).cast("int")


def bucket_minima(hashes: Column, width: Column) -> Column:
    """First hash of every bucket of 2**(width + 1); ``hashes`` ascend."""
    shift = F.lit(63) - width
    return F.flatten(
        F.transform(
            F.array(hashes),
            lambda sorted_hashes: F.filter(
                sorted_hashes,
                lambda x, i: (i == 0)
                | (
                    F.call_function("shiftright", x, shift)
                    != F.call_function("shiftright", F.get(sorted_hashes, i - 1), shift)
                ),
            ),
        )
    )


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                    parameters: ContainmentParameters = ContainmentParameters()) -> DataFrame:
    """(doc_id, item_id, item_shingles, matched, containment) per document and item it holds.

    A document holds an item if it has at least 75 % of the item's distinct
    shingles.  Texts of fewer than five words are one shingle as a whole, so such an
    item is found in documents of just these words.  Null or empty texts hold
    nothing and are held by nothing; rows without id are not searched and not
    searched for.  Repeated rows of one id are one result, with the best of its
    texts.  No items, no documents: no rows.  Other columns are not read.
    """
    p = parameters
    texts = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    wanted = durable(
        items.where(F.col(item_col).isNotNull() & F.col(item_text_col).isNotNull())
        .select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("t"))
        .select("item_id", shingle_hashes(F.col("t")).alias("hashes"), shingle_texts(F.col("t")).alias("shingles"))
        .where(F.size("hashes") > 0)
    )
    candidates = measured(
        _candidates(texts, wanted, p).select(F.col("doc_id").alias("_value"), "items")
    )
    found = keyed_join(texts, F.col("doc_id"), candidates, "inner")
    rows = found.select(
        "doc_id", shingle_texts(F.col("text")).alias("held"), F.explode("items").alias("item_id")
    )
    texts_of_items = measured(
        wanted.groupBy(F.col("item_id").alias("_value")).agg(F.collect_set("shingles").alias("sets"))
    )
    compared = keyed_join(
        rows.withColumn("of", F.col("item_id")), F.col("of"), texts_of_items, "inner"
    ).select("doc_id", "item_id", "held", F.explode("sets").alias("shingles"))
    counted = compared.select(
        "doc_id",
        "item_id",
        F.size("shingles").alias("item_shingles"),
        F.size(F.array_intersect("shingles", "held")).alias("matched"),
    ).where(F.col("matched") * 100 >= F.col("item_shingles") * p.percent)
    best = F.max_by(
        F.struct("item_shingles", "matched"),
        F.struct(F.col("matched") / F.col("item_shingles"), "matched"),
    )
    return (
        counted.groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.item_shingles").cast("long").alias("item_shingles"),
            F.col("best.matched").cast("long").alias("matched"),
            (F.col("best.matched") / F.col("best.item_shingles")).alias("containment"),
        )
    )


def _candidates(texts: DataFrame, wanted: DataFrame, p: ContainmentParameters) -> DataFrame:
    """(doc_id, items): documents with the items whose shingles or sketches agree enough."""
    n = F.size("hashes")
    short = n <= p.whole
    sizes = F.sequence(F.lit(0), F.lit(_CLASSES))
    fits = F.pow(F.lit(2.0), F.col("width")) * 100 >= n * p.percent
    per_class = (
        wanted.where(~short)
        .withColumn("width", F.explode(sizes))
        .where(fits)
        .withColumn("minima", bucket_minima(F.col("hashes"), F.col("width")))
    )
    expected = F.size("minima") * F.lit(p.percent / 100 * p.surviving * p.share_of_expected)
    registers = per_class.select(
        "width",
        "item_id",
        F.greatest(F.floor(expected), F.lit(1)).alias("needed"),
        F.explode("minima").alias("register"),
    )
    whole = F.lit(-1)  # stands for the width where all shingles are registers
    shingles = wanted.where(short).select(
        whole.alias("width"),
        "item_id",
        F.ceil(n * p.percent / 100).alias("needed"),
        F.explode("hashes").alias("register"),
    )
    key = F.xxhash64
    of_items: Measured = measured(
        registers.unionByName(shingles)
        .groupBy(key("width", "register").alias("_value"))
        .agg(F.collect_set(F.struct("item_id", "needed")).alias("of"))
    )
    kinds = {r["short"] for r in wanted.select(short.alias("short")).distinct().collect()}
    width = F.col("width")
    keys = {
        True: F.transform("hashes", lambda x: key(whole, x)),
        False: F.transform(bucket_minima(F.col("hashes"), width), lambda x: key(width, x)),
    }
    asked = [keys[kind] for kind in sorted(kinds or {False})]
    sketched = (
        texts.select("doc_id", shingle_hashes(F.col("text")).alias("hashes"))
        .select("doc_id", "hashes", size_class(n).alias("width"))
        .select("doc_id", F.explode(F.concat(*asked)).alias("key"))
    )
    hits = keyed_join(sketched, F.col("key"), of_items, "inner")
    agreed = (
        hits.select("doc_id", F.explode("of").alias("of"))
        .groupBy("doc_id", "of.item_id", "of.needed")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n >= needed")
    )
    return agreed.groupBy("doc_id").agg(F.collect_set("item_id").alias("items"))
