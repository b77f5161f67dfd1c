from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank, short, long, tied and repeated rows, and clashing extra columns."""
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 3), (4, "One two", "en", "b", 7),
        (5, "one TWO", None, "b", 7), (6, long, "de", None, -5), (7, long + " end", "de", "c", 9),
        (8, "a b c d e f g h", "en", "a", 1), (8, "a b c d e f g h", "en", "a", 1), (None, "a b c d e f g h", "en", "a", 1),
        (None, None, None, None, None), (9, "<|endoftext|> ▁x  é\r\nß\x00 日本", "en", "a", 20),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    for name in ("_value", "band", "rep", "node", "component", "row", "known", "words", "label", "y", "u", "path", "filled"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame
