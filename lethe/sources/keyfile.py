"""Key files: read, find the columns, clean, deduplicate, store."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.operators.configtables import insert_missing

ITEM_KEY = ["batch_id", "key_type", "key_no"]
ITEM_SCHEMA = "batch_id string, key_type string, key_no string, created_at timestamp"

# Cell texts that tabular readers take for a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

DELETION_FALLBACK = ("order_no", "ORDER_NO")  # (column, key type)
MASKING_FALLBACK = ("customer_id", "CUSTOMER_ID")


def read_keys_csv(spark: SparkSession, path: str) -> DataFrame:
    """A key file, directory or glob of files, every column as text."""
    if "." in path.rsplit("/", 1)[-1] and not path.lower().endswith((".csv", ".csv.gz")):
        raise ValueError(f"unsupported key file format: {path} (use .csv)")
    try:
        frame = (
            spark.read.option("header", True)
            .option("multiLine", False)
            .option("ignoreLeadingWhiteSpace", False)
            .csv(path)
        )
    except AnalysisException as failure:
        raise ValueError(f"key file not found: {path}") from failure
    if not frame.columns or frame.isEmpty():
        raise ValueError(f"key file is empty: {path}")
    return frame


def detect_columns(
    frame: DataFrame, key_type: str | None = None,
    fallback: tuple[str, str] = DELETION_FALLBACK,
) -> DataFrame:
    """(key_type, key_no), taken from the columns the file happens to have."""
    by_name = {c.strip().lower(): c for c in frame.columns}

    def cell(name: str):
        return F.col(f"`{name}`").cast("string")

    key_column = by_name.get("key_no") or by_name.get("key_val")
    if "key_type" in by_name and key_column:
        return frame.select(
            cell(by_name["key_type"]).alias("key_type"), cell(key_column).alias("key_no")
        )
    column, default_type = fallback
    key_column = by_name.get("key_no") or by_name.get(column) or frame.columns[0]
    return frame.select(
        F.lit(key_type or default_type).alias("key_type"), cell(key_column).alias("key_no")
    )


def clean_keys(frame: DataFrame, na_tokens: tuple[str, ...] = NA_TOKENS) -> DataFrame:
    """Drop missing cells, trim Unicode white space, drop what is then empty."""
    cells = [F.col("key_type"), F.col("key_no")]
    present = F.lit(True)
    for c in cells:
        present = present & c.isNotNull() & ~c.isin(*na_tokens)

    def trimmed(c):
        return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")

    return (
        frame.where(present)
        .withColumns({"key_type": trimmed(cells[0]), "key_no": trimmed(cells[1])})
        .where("key_type <> '' AND key_no <> ''")
    )


def dedup_keys(frame: DataFrame) -> DataFrame:
    return frame.dropDuplicates(["key_type", "key_no"])


def duplicate_count(frame: DataFrame) -> DataFrame:
    """(total_keys, unique_keys, duplicates) of the cleaned file."""
    per_key = frame.groupBy("key_type", "key_no").agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    unique = F.count(F.lit(1))
    return per_key.agg(
        total.alias("total_keys"), unique.alias("unique_keys"),
        (total - unique).alias("duplicates"),
    )


def keys_of(
    frame: DataFrame, key_type: str | None = None,
    fallback: tuple[str, str] = DELETION_FALLBACK,
) -> DataFrame:
    """Unique (key_type, key_no) of any frame that looks like a key file."""
    return dedup_keys(clean_keys(detect_columns(frame, key_type, fallback)))


def new_items(
    keys: DataFrame, existing: DataFrame | None, batch_id: str, created_at=None
) -> DataFrame:
    """Items of the batch that are not stored yet, so ingesting again adds nothing."""
    items = keys.select(
        F.lit(batch_id).alias("batch_id"), "key_type", "key_no",
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
    )
    return items if existing is None else insert_missing(existing, items, ITEM_KEY)


def keys_breakdown(frame: DataFrame) -> DataFrame:
    """Keys per (batch and) key type."""
    by = [c for c in ("batch_id", "key_type") if c in frame.columns]
    return frame.groupBy(*by).agg(F.count(F.lit(1)).alias("key_count"))
