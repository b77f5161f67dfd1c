"""From raw documents to packed sequences: filter, deduplicate, decontaminate, pack.

Every stage takes and (but for the last) returns the columns of ``documents``; what it
decides about a row goes by ``doc_id``.  Rows without id cannot be named and so are
never removed.  Rows that repeat an id go only if the stage rejects all of them.  Further
columns are kept whatever their names.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.llm.decontam import contained_items
from lethe.llm.hyperminhash import near_duplicates
from lethe.llm.packing import pack, token_pieces
from lethe.llm.quality import quality_scores
from lethe.llm.words import bounded_batches
from lethe.operators.sizing import keyed_join, measured
from lethe.session import prepare, shared_folder


def _ready(spark: SparkSession) -> None:
    prepare(spark)
    bounded_batches(spark)


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` without the rows of the ids in ``rejected`` (unique)."""
    ids = rejected.select(F.col("doc_id").cast("long").alias("_value"))
    # by position, as a column of documents may be named like one of the join's own
    own = docs.toDF(*(f"column{i}" for i in range(len(docs.columns))))
    match = F.col(own.columns[docs.columns.index("doc_id")]).cast("long")
    return keyed_join(own, match, measured(ids), "left_anti").toDF(*docs.columns)


def _rejected(decided: DataFrame) -> DataFrame:
    known = decided.where(F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg(F.max("kept").alias("kept")).where(~F.col("kept"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    _ready(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _without(docs, _rejected(quality_scores(docs, labels)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates."""
    _ready(spark)
    return _without(docs, _rejected(near_duplicates(docs)))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    _ready(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, contained_items(docs, items).select("doc_id").distinct())


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in sequences of 4096 tokens."""
    _ready(spark)
    return pack(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Training, near duplicates and packing are not SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again by the next."""
    _ready(spark)
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
